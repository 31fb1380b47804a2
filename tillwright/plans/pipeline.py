"""Building the warehouse: every table in full, or only what newly landed rows add."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.completion import Model
from tillwright.operators import checks, facts, search_index
from tillwright.plans import changes, insights, metrics
from tillwright.plans.mart import Mart
from tillwright.session import scratch, stage, together
from tillwright.sources import files
from tillwright.sources.ingest import MODES, forget_loads, ingest, landing_name
from tillwright.sources.landing import extract
from tillwright.sources.tables import Tables, newer, number_of_parts, part_of, watermark

DIMENSIONS = ("dim_customers", "dim_products", "dim_vendors", "dim_dates")
STORED_REPORTS = ("mv_revenue_by_region", "mv_return_rate_by_vendor", "mv_slow_moving_products")
VIEWS = tuple(name for name in metrics.METRICS if name not in STORED_REPORTS)

TABLES = (
    *[landing_name(e) for e in fv.ENTITIES],
    *[f"raw_{e}" for e in fv.ENTITIES],
    *[f"clean_{e}" for e in fv.ENTITIES],
    "rejected_records",
    *DIMENSIONS,
    "fact_sales",
    "fact_returns",
    "bridge_return_products",
)

# Columns that a search may be narrowed by.
DOCUMENT_FILTERS = ("doc_type", "product_id", "vendor_id", "region")

TEXTS = ("flagged_return_customers", "ai_business_insights", "dq_audit_report", "rag_documents", "rag_query_history")


def drop_outputs(tables: Tables) -> None:
    """Remove all tables and views of a warehouse, and what it knows of loaded files."""
    forget_loads(tables)
    for name in (*TABLES, *STORED_REPORTS, *TEXTS, "column_tests", changes.MARKS, changes.PENDING, *search_index.TABLES):
        tables.drop(name)
    for name in (*VIEWS, "pipeline_audit_log"):
        tables.spark.catalog.dropTempView(name)


def mart(tables: Tables, replaced: Mapping[str, DataFrame] | None = None, without: tuple[str, ...] = ()) -> Mart:
    """The stored warehouse, with some relations given anew and some left to be derived."""
    stored = {**tables.stored([n for n in TABLES if n not in without]), **(replaced or {})}
    return Mart(stored=stored)


def run(
    spark: SparkSession,
    source_root: str,
    tables: Tables,
    mode: str = "full",
    load_time: datetime | None = None,
    repair_late: bool = False,
    model: Model | None = None,
) -> DataFrame:
    """Land files, refresh every layer, and hand out the load report."""
    report = stage(ingest(spark, source_root, tables, mode, load_time), "load_report")
    transform(tables, mode, repair_late, model)
    return report


def transform(tables: Tables, mode: str = "full", repair_late: bool = False, model: Model | None = None) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    transform_tables(tables, mode, repair_late)
    refresh_reports(tables, model)


def transform_tables(tables: Tables, mode: str = "incremental", repair_late: bool = False) -> None:
    """Silver and gold without the reports."""
    refresh_silver(tables, mode)
    refresh_gold(tables, mode, repair_late)


def refresh_silver(tables: Tables, mode: str) -> None:
    """Bronze, clean and quarantine; in incremental mode each target takes rows newer than its newest.

    Rows are chosen before they are parsed: the mark is a filter on the stored files.
    """
    put = tables.replace if mode == "full" else tables.append_newer
    together([
        lambda e=entity: put(f"raw_{e}", extract(tables.read(landing_name(e)), e)) for entity in fv.ENTITIES
    ])
    marks = {e: None if mode == "full" else watermark(tables.read(f"clean_{e}")) for e in fv.ENTITIES}
    write = tables.replace if mode == "full" else tables.append
    fresh = newer_layer(tables, marks)
    together([lambda e=entity: write(f"clean_{e}", fresh.clean_anew(e)) for entity in fv.ENTITIES])
    if mode == "full" or tables.read("rejected_records") is None:
        tables.replace("rejected_records", newer_layer(tables, {}).rejected_records)
    else:
        tables.append("rejected_records", newer_layer(tables, reject_marks(tables)).rejected_records)


def newer_layer(tables: Tables, marks: Mapping[str, datetime | None]) -> Mart:
    """Bronze rows newer than the mark of their entity, to be parsed; without a mark all of them."""
    bronze = tables.stored([f"raw_{e}" for e in fv.ENTITIES])
    return Mart(stored={f"raw_{e}": newer(bronze[f"raw_{e}"], marks.get(e)) for e in fv.ENTITIES})


def reject_marks(tables: Tables) -> dict[str, datetime]:
    """Each entity has a mark of its own in the quarantine, so a slow source is not cut off by a faster one."""
    marks = tables.read("rejected_records").groupBy("source_table").agg(F.max("_load_timestamp").alias("mark")).collect()
    return {r["source_table"].removeprefix("clean_"): r["mark"] for r in marks}


def refresh_gold(tables: Tables, mode: str, repair_late: bool = False) -> None:
    """Dimensions are rebuilt; in incremental mode facts are appended to and the bridge follows for their orders.

    Facts follow the newest order and the newest return event: a line that lands after its order, or an
    order that lands after its return, does not change facts already written. ``repair_late`` adds every line
    that the sales lack, whichever run it landed in, and renews the returns that read otherwise by now; it looks
    at orders that anything was landed for since the last build or repair.
    """
    with scratch(tables.spark):
        _write_gold(tables, mode, repair_late)


def _write_gold(tables: Tables, mode: str, repair_late: bool) -> None:
    fresh = mart(tables, without=(*changes.FACTS, *DIMENSIONS))
    dimensions = {name: getattr(fresh, name) for name in DIMENSIONS}
    together([lambda n=name, rows=rows: tables.replace(n, rows) for name, rows in dimensions.items()])
    marks = None if mode == "full" or tables.read("fact_sales") is None else changes.read_marks(tables)
    if marks is None:
        _build_facts(tables)
        return
    whole, now = mart(tables, without=changes.FACTS), changes.seen_by_now(tables, marks.parts)
    if repair_late:
        of_sales, of_returns = (stage(ids, "changed_orders") for ids in changes.repaired(tables, marks))
        pending = changes.note(tables, of_sales.unionByName(of_returns))
        lacking = changes.marked_sales(whole, changes.missing_sales(tables, whole, of_sales, marks))
        tables.append_parts("fact_sales", lacking, changes.KEY, marks.parts, facts.with_keys)
        changes.renew_returns(tables, whole, of_returns, marks)
    else:
        pending = changes.note(tables, changes.appended(tables))
        for fact, entity, made in (
            ("fact_sales", "orders", changes.new_sales), ("fact_returns", "returns", changes.new_returns),
        ):
            new = newer(tables.read(f"clean_{entity}"), watermark(tables.read(fact)))
            tables.append_parts(fact, made(whole, new), changes.KEY, marks.parts, facts.with_keys, changes.many(new))
    changes.renew_bridge(tables, whole, pending, marks)
    if repair_late:
        changes.write_marks(tables, now)
    changes.forget(tables)


def _build_facts(tables: Tables) -> None:
    """All facts and the bridge from the clean tables; until the marks are written, runs build them again."""
    tables.drop(changes.MARKS)
    now, whole = changes.seen_by_now(tables), mart(tables, without=changes.FACTS)
    keyed = {"key": changes.KEY, "parts": now.parts, "lying": True}
    mark = changes.marking(whole, whole.clean("orders"), whole.clean("transactions"))
    built = {"fact_sales": whole.slim_sales(mark), "fact_returns": whole.slim_returns(mark)}
    together([lambda n=n, rows=rows: tables.replace(n, rows, **keyed, finish=facts.with_keys) for n, rows in built.items()])
    bridge = mart(tables, without=("bridge_return_products",)).slim_bridge()
    tables.replace("bridge_return_products", bridge, **keyed, finish=facts.bridge_keys)
    changes.write_marks(tables, now)
    changes.forget(tables)


def refresh_reports(tables: Tables, model: Model | None = None) -> None:
    """Column tests, stored reports and texts; the other reports and the audit become views."""
    with scratch(tables.spark):
        _write_reports(tables, model)
    create_views(tables)


def create_views(tables: Tables) -> None:
    """The reports that are not stored, and the audit, as views of the session; they go on reading what they stage."""
    whole = mart(tables)
    for name in VIEWS:
        metrics.METRICS[name](whole).createOrReplaceTempView(name)
    whole.pipeline_audit_log.createOrReplaceTempView("pipeline_audit_log")


def _write_reports(tables: Tables, model: Model | None) -> None:
    whole = mart(tables)
    tables.replace("column_tests", checks.column_tests(whole.relation))
    together([lambda n=name: tables.replace(n, metrics.METRICS[n](whole)) for name in STORED_REPORTS])
    texts = {
        "flagged_return_customers": insights.flagged_return_customers,
        "ai_business_insights": insights.ai_business_insights,
        "dq_audit_report": insights.dq_audit_report,
    }
    together([
        *[lambda n=name, text=text: tables.replace(n, text(whole, model)) for name, text in texts.items()],
        lambda: _write_documents(tables, whole, None),
    ])
    tables.replace("rag_query_history", insights.rag_query_history(whole, model, tables.read("rag_documents")))


def refresh_documents(tables: Tables, whole: Mart, moment: datetime | None = None) -> None:
    """Renew the document table and its search index; a document whose text did not change keeps its time."""
    with scratch(tables.spark):
        _write_documents(tables, whole, moment)


def _write_documents(tables: Tables, whole: Mart, moment: datetime | None) -> None:
    put_documents(tables, insights.rag_documents(whole), moment)


def put_documents(tables: Tables, documents: DataFrame, moment: datetime | None = None) -> None:
    """Documents are compared by a digest of what they hold; only parts with a change are written anew."""
    name, key = "rag_documents", "doc_id"
    documents = stage(documents, name)
    now = files.timestamp(moment or files.now())
    before, parts = tables.read(name), tables.parts(name)
    if before is None or parts is None:
        tables.replace(name, documents.withColumn("updated_at", now), key, number_of_parts(documents.count()))
        search_index.build(tables, documents, DOCUMENT_FILTERS)
        return
    own = F.xxhash64(*[F.col(c) for c in documents.columns if c != key])
    digests = [rows.select(key, F.unhex(F.sha2("doc_text", 256)).alias("text"), own.alias("rest")) for rows in (before, documents)]
    changed = stage(_differing(*digests, key), "changed_documents")
    if not changed.isEmpty():
        touched = changes.changed_parts(changed, key, parts)
        known = tables.read(name, touched).select(key, "updated_at").join(changed.where("new_text"), key, "left_anti")
        fresh = documents.where(part_of(F.col(key), parts).isin(touched)).join(known, key, "left")
        tables.replace_parts(name, fresh.withColumn("updated_at", F.coalesce("updated_at", now)), key, parts, touched)
    search_index.refresh(tables, documents, DOCUMENT_FILTERS)


def _differing(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, new_text) of the documents that are new, gone or read otherwise, or whose attributes do."""
    old = before.select(F.col(key).alias("old_key"), F.col("text").alias("old_text"), F.col("rest").alias("old_rest"))
    both = after.join(old, F.col(key) == F.col("old_key"), "full")
    same_text = F.col("text").eqNullSafe(F.col("old_text")) & F.col(key).isNotNull() & F.col("old_key").isNotNull()
    same = same_text & F.col("rest").eqNullSafe(F.col("old_rest"))
    return both.where(~same).select(F.coalesce(key, "old_key").alias(key), (~same_text).alias("new_text"))
