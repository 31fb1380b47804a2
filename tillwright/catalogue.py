"""Every query by name, over the landing rows derived from a benchmark directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.numbers import exact_sum, rounded
from tillwright.loads import LOADS
from tillwright.operators import checks, rules, search_index
from tillwright.operators.search import search
from tillwright.plans import insights, metrics, pipeline, semantic
from tillwright.plans.mart import Mart
from tillwright.session import new_path, stage
from tillwright.sources import driver_tables
from tillwright.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUESTIONS = {q: text for q, text, _, _ in fv.QUESTIONS}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    return Mart(lambda entity: driver_tables.landing(spark, sf_dir, entity))


def _on_mart(report: Callable[[Mart], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(mart(spark, sf_dir))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _landing_row_counts(m: Mart) -> DataFrame:
    return _union([m.landing(e).agg(F.lit(e).alias("entity"), F.count("*").alias("row_count")) for e in fv.ENTITIES])


def _rejected_records(m: Mart) -> DataFrame:
    return m.rejected_records.drop("record_data", "rejected_at")


def _rejected_by_rule(m: Mart) -> DataFrame:
    number = F.lit(None).cast("int")
    for r in rules.RULES:
        same = (F.col("source_table") == f"clean_{r.entity}") & (F.col("affected_field") == r.field)
        number = F.when(same & (F.col("issue_type") == r.issue), r.number).otherwise(number)
    group = ["source_table", "affected_field", "issue_type"]
    counts = m.rejected_records.groupBy(*group).agg(F.count("*").alias("rejected_count"))
    return counts.select(number.alias("rule"), *group, "rejected_count")


def _rejected_record_data(m: Mart) -> DataFrame:
    """Fields read back from the quarantined JSON, one row per quarantined record."""

    def entity(e: str) -> DataFrame:
        rows = m.rejected_records.where(F.col("source_table") == f"clean_{e}")
        flags = reduce(
            lambda a, b: a + b,
            [F.when(F.get_json_object("record_data", f"$.{r.flag}") == "true", 1).otherwise(0) for r in rules.rules_for(e)],
        ).cast("bigint")
        read = rows.select(
            "source_table",
            F.get_json_object("record_data", f"$.{rules.RECORD_KEY[e]}").alias("json_key"),
            F.get_json_object("record_data", "$._source_file").alias("json_file"),
            F.get_json_object("record_data", f"$.{rules.ANY_FAILURE}").alias("json_failed"),
            flags.alias("n_flags"),
            "affected_field",
            F.array_min(F.array_compact(F.array(*[
                F.when(F.get_json_object("record_data", f"$.{r.flag}") == "true", r.field) for r in rules.rules_for(e)
            ]))).alias("first_field"),
        )
        return read.where("affected_field = first_field").drop("affected_field", "first_field")

    return _union([entity(e) for e in fv.ENTITIES])


def _generated_rejects(m: Mart) -> DataFrame:
    rows = rules.violations(
        m.harmonized("transactions"), "clean_transactions", "order_id",
        [("_fail_negative_sales", "sales", "out_of_range")],
    )
    return rows.drop("record_data", "rejected_at")


def _check_not_null(m: Mart) -> DataFrame:
    def tested(table: str, df: DataFrame, column: str) -> DataFrame:
        failing = checks.not_null(df, column)
        return failing.select(F.lit(f"{table}.{column}").alias("tested"), F.col("order_id").alias("record_key"))

    return _union([
        tested("clean_orders", m.clean("orders"), "order_purchase_date"),
        tested("clean_returns", m.clean("returns"), "return_date"),
        tested("fact_sales", m.sales(vendor=["vendor_sk"]), "vendor_sk"),
        tested("fact_returns", m.returns(customer=["customer_sk"]), "customer_sk"),
    ])


def _check_unique(m: Mart) -> DataFrame:
    def tested(table: str, df: DataFrame, column: str) -> DataFrame:
        repeated = checks.unique(df, column).withColumnRenamed(column, "value")
        return repeated.select(F.lit(f"{table}.{column}").alias("tested"), "value", "n_records")

    return _union([
        tested("clean_customers", m.clean("customers"), "customer_id"),
        tested("fact_sales", m.sales(), "order_id"),
        tested("dim_customers", m.dim_customers, "customer_sk"),
    ])


def _check_accepted_values(m: Mart) -> DataFrame:
    def tested(entity: str, column: str, allowed: tuple[str, ...]) -> DataFrame:
        rows = checks.accepted_values(m.harmonized(entity), column, allowed)
        return rows.select(F.lit(column).alias("tested"), F.col("value_field").alias("value"), "n_records")

    return _union([
        tested("customers", "segment", fv.SEGMENTS),
        tested("customers", "region", fv.REGIONS),
        tested("orders", "ship_mode", fv.SHIP_MODES),
        tested("orders", "order_status", fv.ORDER_STATUSES),
        tested("returns", "return_status", fv.RETURN_STATUSES),
    ])


def _check_in_range(m: Mart) -> DataFrame:
    def tested(name: str, entity: str, column: str, **bounds) -> DataFrame:
        rows = checks.in_range(m.harmonized(entity), column, **bounds)
        return rows.select(F.lit(name).alias("tested"), F.col(column).cast("double").alias("value"))

    return _union([
        tested("discount", "transactions", "discount", min_value=0, max_value=1),
        tested("quantity", "transactions", "quantity", min_value=1),
        tested("sales", "transactions", "sales", min_value=0),
        tested("refund_amount", "returns", "refund_amount", min_value=0),
        tested("quantity_exclusive", "transactions", "quantity", min_value=1, max_value=50, inclusive=False),
    ])


def _dq_rejection_rates(m: Mart) -> DataFrame:
    """Counts and rates, with the keys of the sample records, read back from their texts."""
    rows = insights.with_rejection_rates(insights.rejection_groups(m.hold_rejects().rejected_records), m.pipeline_audit_log)

    def key(sample: Column) -> Column:
        found = F.lit(None).cast("string")
        for entity, name in rules.RECORD_KEY.items():
            found = F.when(F.col("entity") == entity, F.get_json_object(sample, f"$.{name}")).otherwise(found)
        return F.coalesce(found, F.lit(""))

    keys = F.array_join(F.transform(F.split("sample_records", r" \| (?=\{)"), key), ",").alias("sample_keys")
    return rows.select(
        "entity", "affected_field", "issue_type", "rejected_count", "total_entity_records", "rejection_rate_pct", keys
    )


def _dq_prompts(m: Mart) -> DataFrame:
    report = insights.dq_audit_report(m)
    return report.select("entity", "affected_field", F.substring_index("prompt", " Samples: ", 1).alias("prompt"))


def _dq_audit_report(m: Mart) -> DataFrame:
    """The whole report, sample texts and prompts included; its samples are texts that SQL does not write alike."""
    return insights.dq_audit_report(m).drop("generated_at")


def _bridge(m: Mart) -> DataFrame:
    weight = F.col("allocation_weight").cast("decimal(18,6)").cast("double")
    return m.bridge_return_products.withColumn("allocation_weight", weight)


def _fraud_thresholds(m: Mart) -> DataFrame:
    history = stage(metrics.mv_customer_return_history(m), "customer_return_history")
    found = insights.anomaly_thresholds(history)
    names = {
        "p75_returns": "total_returns", "p75_refund": "total_refund_value", "p75_avg_refund": "avg_refund_per_return",
    }
    row = [F.lit(found[c]).cast("decimal(18,6)").cast("double").alias(name) for name, c in names.items()]
    return history.sparkSession.range(1).select(*row)


def _fraud_scores(m: Mart) -> DataFrame:
    scores = [f"score_{rule}" for rule in fv.ANOMALY_POINTS]
    return insights.scored_customers(m).select("customer_id", *scores, "anomaly_score", "rules_violated")


def _kpi_by_region(m: Mart) -> DataFrame:
    return insights.kpi_by_region(metrics.mv_monthly_revenue_by_region(m))


def _kpi_top(m: Mart) -> DataFrame:
    top = insights.top_return_costs(metrics.mv_product_return_impact(m))
    return top.select("product_id", "product_name", "region", "total_return_cost")


def _indexed(filters: dict[str, str] | None) -> Callable[[SparkSession, str], DataFrame]:
    """A search in stored postings of the documents, which were indexed with a few others first and then renewed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, new_path(spark, "warehouse"))
        documents = stage(insights.rag_documents(mart(spark, sf_dir)), "rag_documents")
        other = F.when(F.col("doc_type") == "vendor", F.lit("Slow moving pen")).otherwise(F.col("doc_text"))
        before = documents.where("not doc_id like '%1'").withColumn("doc_text", other)
        search_index.build(tables, before, pipeline.DOCUMENT_FILTERS)
        search_index.refresh(tables, documents, pipeline.DOCUMENT_FILTERS)
        return search_index.search(tables, QUESTIONS, filters)

    return query


def _document_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table after two refreshes: vendors are new in the second, texts of one region read otherwise."""
    tables = Tables(spark, new_path(spark, "warehouse"))
    documents = stage(insights.rag_documents(mart(spark, sf_dir)), "rag_documents")
    text = F.when(F.col("region") == "West", F.upper("doc_text")).otherwise(F.col("doc_text"))
    first = documents.where("doc_type <> 'vendor'").withColumn("doc_text", text)
    gone = first.where("doc_type = 'product'").withColumn("doc_id", F.concat(F.lit("gone_"), "doc_id"))
    pipeline.put_documents(tables, first.unionByName(gone), datetime(2024, 1, 1))
    for day in (2, 3):
        pipeline.put_documents(tables, documents, datetime(2024, 1, day))
    return tables.read("rag_documents")


def _search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(driver_tables.table(spark, sf_dir, "documents"), QUESTIONS, key="doc_id", text="text")


def _semantic_star(m: Mart) -> DataFrame:
    attributes = {
        "dim_customers": ["segment"], "dim_products": ["brand"], "dim_vendors": ["vendor_name"], "dim_dates": ["quarter"],
    }
    rows = semantic.star(m, "fact_sales", attributes)
    return rows.groupBy("segment", "brand", "vendor_name", "quarter").agg(
        F.count("*").alias("lines"), rounded(exact_sum(F.col("sales"))).alias("total_sales")
    )


def _entity_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for entity in fv.ENTITIES:
        found[f"bronze_{entity}"] = _on_mart(lambda m, e=entity: m.bronze(e))
        found[f"harmonize_{entity}"] = _on_mart(lambda m, e=entity: m.harmonized(e))
        found[f"clean_{entity}"] = _on_mart(lambda m, e=entity: m.clean(e))
    return found


def _table(name: str) -> Query:
    return _on_mart(lambda m: getattr(m, name))


QUERIES: dict[str, Query] = {
    "landing_row_counts": _on_mart(_landing_row_counts),
    **_entity_queries(),
    "rejected_records": _on_mart(_rejected_records),
    "rejected_by_rule": _on_mart(_rejected_by_rule),
    "rejected_record_data": _on_mart(_rejected_record_data),
    "generate_rejected_rows": _on_mart(_generated_rejects),
    "audit_log": _table("pipeline_audit_log"),
    "check_audit_balanced": _on_mart(lambda m: checks.audit_balanced(m.pipeline_audit_log)),
    "check_bridge_allocation": _on_mart(lambda m: checks.allocation_sums(m.bridge_return_products)),
    "check_not_null": _on_mart(_check_not_null),
    "check_unique": _on_mart(_check_unique),
    "check_accepted_values": _on_mart(_check_accepted_values),
    "check_in_range": _on_mart(_check_in_range),
    "column_tests": _on_mart(lambda m: checks.column_tests(m.relation)),
    "dq_rejection_rates": _on_mart(_dq_rejection_rates),
    "dq_audit_report": _on_mart(_dq_audit_report),
    "dq_prompts": _on_mart(_dq_prompts),
    "dim_customers": _table("dim_customers"),
    "dim_products": _table("dim_products"),
    "dim_vendors": _table("dim_vendors"),
    "dim_dates": _table("dim_dates"),
    "fact_sales": _table("fact_sales"),
    "fact_returns": _table("fact_returns"),
    "bridge_return_products": _on_mart(_bridge),
    **{name: _on_mart(report) for name, report in metrics.METRICS.items()},
    "fraud_thresholds": _on_mart(_fraud_thresholds),
    "fraud_scores": _on_mart(_fraud_scores),
    "flagged_return_customers": _on_mart(
        lambda m: insights.flagged_return_customers(m).drop("generated_at")
    ),
    "kpi_totals": _on_mart(lambda m: insights.kpi_totals(_kpi_by_region(m)).drop("by_region")),
    "kpi_by_region": _on_mart(_kpi_by_region),
    "kpi_top5_return_cost": _on_mart(_kpi_top),
    "kpi_documents": _on_mart(insights.kpi_documents),
    "ai_business_insights": _on_mart(lambda m: insights.ai_business_insights(m).drop("generated_at")),
    "rag_documents": _on_mart(insights.rag_documents),
    "rag_context": _on_mart(lambda m: insights.rag_context(insights.rag_documents(m))),
    "rag_query_history": _on_mart(lambda m: insights.rag_query_history(m).drop("generated_at")),
    "search_topk": _indexed(None),
    "search_topk_filtered": _indexed({"doc_type": "vendor"}),
    "document_refresh": _document_refresh,
    "search_documents": _search_documents,
    "q_revenue_by_region": _on_mart(semantic.revenue_by_region),
    "q_vendor_return_rate": _on_mart(semantic.vendors_by_return_rate),
    "q_top5_products_west": _on_mart(semantic.top_products),
    "q_top_refund_customers": _on_mart(semantic.customers_by_refund),
    "q_margin_by_segment": _on_mart(semantic.margin_by_segment),
    "semantic_star": _on_mart(_semantic_star),
    "semantic_join_cardinality": _on_mart(semantic.join_cardinality),
    **LOADS,
}
