"""Anomaly scores, KPI documents, retrieved context and prompts for a batch text-completion model."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.completion import Model, complete
from tillwright.functions.keys import fill
from tillwright.functions.numbers import exact_sum, money_text, percentage, rounded, rounded_ratio
from tillwright.operators.first_rows import first_rows
from tillwright.operators.quantiles import positions
from tillwright.plans import metrics
from tillwright.plans.mart import Mart
from tillwright.session import stage, stage_all

COMPANY = "the company"

# Texts may be empty, but each one after the first brings a separator, so this many always fill the context.
CONTEXT_DOCUMENTS = fv.CONTEXT_CHARS // len(fv.CONTEXT_SEPARATOR) + 1


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _money(column: str, name: str | None = None) -> Column:
    """Two-digit decimal, which JSON shows without an exponent."""
    return F.col(column).cast("decimal(38,2)").alias(name or column)


# Return anomalies


def anomaly_thresholds(history: DataFrame) -> dict[str, float | None]:
    """Exact third quartiles over all customers; the one of the return count is at least 3."""
    measures = ("total_returns", "total_refund_value", "avg_refund_per_return")
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("grp"), F.col(m).cast("double").alias("v")) for m in measures])
    )
    found = positions(history.select(pairs.alias("p")).select("p.*"), fv.ANOMALY_QUANTILE)
    quartile = {m: found[m].interpolated if m in found else None for m in measures}
    if quartile["total_returns"] is not None:
        quartile["total_returns"] = max(quartile["total_returns"], float(fv.ANOMALY_MIN_RETURNS))
    return quartile


def anomaly_scores(history: DataFrame, thresholds: dict[str, float | None]) -> DataFrame:
    """Points per rule and their sum; a comparison with NULL gives no points."""

    def above(measure: str) -> Column:
        return F.col(measure) > F.lit(thresholds[measure]).cast("double")

    fires = {
        "high_return_count": above("total_returns"),
        "high_total_refund": above("total_refund_value"),
        "high_avg_refund": above("avg_refund_per_return"),
        "high_approval_rate": (F.col("approval_rate_pct") > fv.HIGH_APPROVAL_PCT)
        & (F.col("total_returns") >= fv.HIGH_APPROVAL_MIN_RETURNS),
        "multiple_reasons": F.col("distinct_reason_count") >= fv.MULTIPLE_REASONS,
    }
    points = {
        f"score_{rule}": F.when(test, fv.ANOMALY_POINTS[rule]).otherwise(0) for rule, test in fires.items()
    }
    labels = [
        F.when(F.col(f"score_{rule}") > 0, f"{rule} ({weight})") for rule, weight in fv.ANOMALY_POINTS.items()
    ]
    return (
        history.withColumns(points)
        .withColumn("anomaly_score", reduce(add, [F.col(name) for name in points]))
        .withColumn("rules_violated", F.array_join(F.array_compact(F.array(*labels)), ", "))
    )


def scored_customers(mart: Mart) -> DataFrame:
    history = stage(metrics.mv_customer_return_history(mart), "customer_return_history")
    return anomaly_scores(history, anomaly_thresholds(history))


def flagged_return_customers(mart: Mart, model: Model | None = None, company: str = COMPANY) -> DataFrame:
    flagged = scored_customers(mart).where(F.col("anomaly_score") >= fv.ANOMALY_FLAG_SCORE)
    prompt = fill(
        fv.INVESTIGATION_PROMPT,
        {
            "company": F.lit(company),
            **{c: F.col(c) for c in ("customer_name", "customer_id", "segment", "region", "rules_violated")},
            **{c: money_text(F.col(c)) for c in ("total_refund_value", "avg_refund_per_return", "approval_rate_pct")},
            **{c: _text(c) for c in ("total_returns", "anomaly_score")},
            "return_reasons": F.coalesce("return_reasons", F.lit("N/A")),
        },
    )
    return (
        flagged.withColumn("prompt", prompt)
        .withColumn("investigation_brief", complete(F.col("prompt"), model))
        .select(
            "customer_id", "customer_name", "segment", "region", "total_returns", "total_refund_value",
            "avg_refund_per_return", F.col("approval_rate_pct").alias("approval_rate"), "distinct_reason_count",
            "return_reasons", "anomaly_score", "rules_violated", "prompt", "investigation_brief",
            F.current_timestamp().alias("generated_at"),
        )
    )


# KPI documents


def kpi_by_region(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("region").agg(
        rounded(exact_sum(F.col("total_revenue"))).alias("revenue"),
        rounded(exact_sum(F.col("total_profit"))).alias("profit"),
        F.sum("total_quantity").alias("units"),
        F.sum("order_count").alias("orders"),
    )


def kpi_totals(by_region: DataFrame) -> DataFrame:
    """Grand totals of the monthly report, through its at most five regions."""
    return by_region.agg(
        rounded(exact_sum(F.col("revenue"))).alias("grand_total_revenue"),
        rounded(exact_sum(F.col("profit"))).alias("grand_total_profit"),
        F.sum("units").alias("grand_total_units"),
        F.sum("orders").alias("grand_total_orders"),
        F.sort_array(F.collect_list(F.struct("region", _money("revenue"), _money("profit")))).alias("by_region"),
    )


def _revenue_document(mart: Mart) -> DataFrame:
    totals = kpi_totals(kpi_by_region(metrics.mv_monthly_revenue_by_region(mart)))
    document = F.struct(
        _money("grand_total_revenue"), _money("grand_total_profit"), "grand_total_units", "by_region"
    )
    return totals.select(F.lit("revenue_performance").alias("insight_type"), F.to_json(document).alias("kpi_data"))


def _vendor_documents(rates: DataFrame) -> DataFrame:
    """One document per vendor, whatever their number."""
    vendor = F.struct(
        F.col("vendor_name").alias("vendor"), _money("total_sales"), _money("return_rate_pct", "return_rate"),
        _money("total_refunded"),
    )
    return rates.select(F.lit("vendor_return_rate").alias("insight_type"), F.to_json(vendor).alias("kpi_data"))


def top_return_costs(impact: DataFrame, k: int = fv.TOP_COST_ROWS) -> DataFrame:
    order = [F.col("total_return_cost").desc_nulls_last(), "product_id", "region"]
    return impact.orderBy(*order).limit(k)


def _inventory_document(impact: DataFrame) -> DataFrame:
    cost = F.col("total_return_cost")
    row = F.struct(
        cost.isNull().alias("last"), (-cost).alias("rank"), "product_id", "region", "product_name", _money("total_return_cost")
    )
    in_order = F.array_sort(F.collect_list(row))
    listed = F.transform(
        in_order,
        lambda r: F.struct(r["product_name"].alias("product"), r["region"].alias("region"), r["total_return_cost"].alias("cost")),
    )
    dearest = top_return_costs(impact).agg(listed.alias("top"))
    totals = impact.agg(
        rounded(exact_sum(cost)).alias("total_return_cost"),
        rounded_ratio(exact_sum(F.col("avg_return_cost")), F.count("avg_return_cost")).alias("avg_return_cost"),
    ).withColumn("top_5", dearest.scalar())
    return totals.select(
        F.lit("slow_moving_inventory").alias("insight_type"),
        F.to_json(F.struct(_money("total_return_cost"), _money("avg_return_cost"), "top_5")).alias("kpi_data"),
    )


def kpi_documents(mart: Mart) -> DataFrame:
    mart.hold("transactions", "orders", "returns")
    reports = stage_all({
        "return_rate_by_vendor": metrics.mv_return_rate_by_vendor(mart),
        "product_return_impact": metrics.mv_product_return_impact(mart),
    })
    documents = [
        _revenue_document(mart),
        _vendor_documents(reports["return_rate_by_vendor"]),
        _inventory_document(reports["product_return_impact"]),
    ]
    return reduce(DataFrame.unionByName, documents)


def ai_business_insights(mart: Mart, model: Model | None = None, company: str = COMPANY) -> DataFrame:
    prompt = fill(
        fv.INSIGHT_PROMPT,
        {"company": F.lit(company), "insight_type": F.col("insight_type"), "kpi_data": F.col("kpi_data")},
    )
    return (
        kpi_documents(mart)
        .withColumn("prompt", prompt)
        .withColumn("executive_summary", complete(F.col("prompt"), model))
        .select("insight_type", "prompt", "executive_summary", "kpi_data", F.current_timestamp().alias("generated_at"))
    )


# Data quality report


def rejection_groups(rejected: DataFrame) -> DataFrame:
    """Counts and the first three records per table, field and issue."""
    group = ["source_table", "affected_field", "issue_type"]
    counts = rejected.groupBy(*group).agg(F.count("*").alias("rejected_count"))
    samples = (
        first_rows(rejected.select(*group, "record_key", "record_data"), group, ["record_key", "record_data"], fv.SAMPLE_RECORDS)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "record_data"))).alias("firsts"))
        .select(*group, F.array_join("firsts.record_data", fv.SAMPLE_SEPARATOR).alias("sample_records"))
    )
    entity = F.replace(F.col("source_table"), F.lit("clean_"), F.lit(""))
    return counts.join(samples, group).select(
        entity.alias("entity"), "affected_field", "issue_type", "rejected_count", "sample_records"
    )


def with_rejection_rates(groups: DataFrame, audit: DataFrame) -> DataFrame:
    totals = audit.select("entity", F.col("bronze_count").alias("total_entity_records"))
    return groups.join(totals, "entity", "left").withColumn(
        "rejection_rate_pct", percentage(F.col("rejected_count"), F.col("total_entity_records"))
    )


def dq_audit_report(mart: Mart, model: Model | None = None, company: str = COMPANY) -> DataFrame:
    rows = with_rejection_rates(rejection_groups(mart.hold_rejects().rejected_records), mart.pipeline_audit_log)
    prompt = fill(
        fv.QUALITY_PROMPT,
        {
            "company": F.lit(company),
            **{c: F.col(c) for c in ("entity", "affected_field", "issue_type")},
            "rejected_count": _text("rejected_count"),
            "total_entity_records": F.coalesce(_text("total_entity_records"), F.lit("unknown")),
            "rejection_rate_pct": F.coalesce(money_text(F.col("rejection_rate_pct")), F.lit("N/A")),
            "sample_records": F.coalesce("sample_records", F.lit("none")),
        },
    )
    return (
        rows.withColumn("prompt", prompt)
        .withColumn("ai_explanation", complete(F.col("prompt"), model))
        .select(
            "entity", "affected_field", "issue_type", "rejected_count", "total_entity_records",
            "rejection_rate_pct", "sample_records", "prompt", "ai_explanation",
            F.current_timestamp().alias("generated_at"),
        )
    )


# Documents and retrieval


def _document(rows: DataFrame, kind: str, doc_id: list[str], text: Column) -> DataFrame:
    def attribute(name: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None).cast("string")).alias(name)

    parts = [F.lit(kind if kind != "product_region" else "prodregion"), *[F.col(c) for c in doc_id]]
    joined = [p for part in parts for p in (F.lit("_"), part)][1:]
    return rows.select(
        F.concat(*joined).alias("doc_id"),
        F.lit(kind).alias("doc_type"),
        text.alias("doc_text"),
        attribute("product_id"),
        attribute("vendor_id"),
        attribute("region"),
    )


def product_documents(products: DataFrame) -> DataFrame:
    values = {
        "product_name": F.col("product_name"),
        **{c: F.coalesce(c, F.lit("Unknown")) for c in ("brand", "category")},
    }
    return _document(products, "product", ["product_id"], fill(fv.PRODUCT_DOC, values))


def product_region_documents(slow_moving: DataFrame) -> DataFrame:
    values = {
        **{c: F.col(c) for c in ("product_name", "region")},
        **{c: money_text(F.col(c)) for c in ("total_sales", "total_profit")},
        "total_quantity": _text("total_quantity"),
        "tag": F.when(F.col("is_slow_moving"), fv.SLOW_MOVING_TAG).otherwise(""),
    }
    return _document(slow_moving, "product_region", ["product_id", "region"], fill(fv.PRODUCT_REGION_DOC, values))


def vendor_documents(rates: DataFrame) -> DataFrame:
    values = {
        "vendor_name": F.col("vendor_name"),
        **{c: money_text(F.col(c)) for c in ("total_sales", "return_rate_pct", "total_refunded")},
        **{c: _text(c) for c in ("total_orders", "return_order_count")},
    }
    return _document(rates, "vendor", ["vendor_id"], fill(fv.VENDOR_DOC, values))


def rag_documents(mart: Mart) -> DataFrame:
    """The document table with its filter attributes."""
    return (
        product_documents(mart.dim_products)
        .unionByName(product_region_documents(metrics.mv_slow_moving_products(mart)))
        .unionByName(vendor_documents(metrics.mv_return_rate_by_vendor(mart)))
    )


def rag_context(documents: DataFrame) -> DataFrame:
    """Per question, its documents in order of their id, cut to the context size; documents are read once."""
    asked = [
        F.when(
            (F.col("doc_type") == kind) & (F.lit(True) if word is None else F.col("doc_text").ilike(f"%{word}%")), qid
        )
        for qid, _, kind, word in fv.QUESTIONS
    ]
    matches = documents.select(
        "doc_id", "doc_text", F.col("doc_text").isNull().alias("_empty"),
        F.explode(F.array_compact(F.array(*asked))).alias("qid"),
    )
    context = (
        first_rows(matches, ["qid"], ["_empty", "doc_id"], CONTEXT_DOCUMENTS)
        .groupBy("qid")
        .agg(
            F.expr(f"left(listagg(doc_text, '{fv.CONTEXT_SEPARATOR}') within group (order by doc_id), {fv.CONTEXT_CHARS})")
            .alias("documents"),
            F.least(F.count("*"), F.lit(fv.CONTEXT_MAX_COUNT)).alias("retrieved_count"),
        )
    )
    questions = documents.sparkSession.createDataFrame([q[:2] for q in fv.QUESTIONS], "qid int, question string")
    return questions.join(context, "qid", "left").select(
        "qid", "question", "documents", F.coalesce("retrieved_count", F.lit(0)).alias("retrieved_count")
    )


def rag_query_history(mart: Mart, model: Model | None = None, documents: DataFrame | None = None) -> DataFrame:
    """Answers to the standing questions from the given document table, or from one derived now."""
    prompt = fill(
        fv.ANSWER_PROMPT,
        {"question": F.col("question"), "documents": F.coalesce("documents", F.lit(fv.NO_DOCUMENTS))},
    )
    return (
        rag_context(rag_documents(mart) if documents is None else documents)
        .withColumn("prompt", prompt)
        .withColumn("answer", complete(F.col("prompt"), model))
        .orderBy("qid")
        .select(
            "question", "prompt", "answer", F.coalesce("documents", F.lit("")).alias("retrieved_documents"),
            "retrieved_count", F.lit(0.0).alias("top_distance"), F.current_timestamp().alias("generated_at"),
        )
    )
