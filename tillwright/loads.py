"""Queries that load: files in and out of landing, incremental appends, late data, and streams.

Each writes files or landing rows derived from the benchmark tables to a new folder, loads them the way a
warehouse is loaded, and hands out what the warehouse holds at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.operators import rules
from tillwright.plans import pipeline
from tillwright.session import new_path
from tillwright.sources import driver_tables, files, ingest
from tillwright.sources.landing import extract
from tillwright.sources.tables import Tables
from tillwright.streaming import streams

# Bronze columns of each CSV file, in file order; the fourth region labels state and city the other way round.
CSV_FILES = {
    "customers": {
        "Region1/customers_1.csv": ("customer_id", "customer_email", "customer_name", "segment", "city", "state", "region"),
        "Region2/customers_2.csv": ("customerid", "customer_email", "customer_name", "segment", "city", "state", "region"),
        "Region3/customers_3.csv": ("cust_id", "customer_email", "customer_name", "segment", "city", "state", "region"),
        "Region4/customers_4.csv": ("customer_id", "customer_email", "customer_name", "segment", "state", "city", "region"),
        "Region5/customers_5.csv": ("customer_id", "customer_name", "segment", "city", "state", "region"),
        "Region6/customers_6.csv": ("customer_identifier", "full_name", "email_address", "customer_segment", "city", "state", "region"),
    },
    "orders": {
        f"Region{1 + 2 * i}/orders_{1 + i}.csv": tuple(fv.BRONZE_KEYS["orders"]) for i in range(3)
    },
    "transactions": {
        f"Region{2 + 2 * i}/transactions_{1 + i}.csv": (
            f"order_id{v}", f"product_id{v}", "vendor_id", "sales", "quantity", "discount", "profit", "payment_type",
        )
        for i, v in enumerate(("", "_v1", "_v2"))
    },
    "vendors": {"vendors.csv": ("vendor_id", "vendor_name")},
}
JSON_FILES = {"returns": ("Region6/returns_1.json", "returns_2.json"), "products": ("products.json",)}

# Spark writes a file as a folder of parts; JSON arrays are written as text.
PART = r"/part-[^/]*$"
PART_ROUTES = {
    **files.ROUTES,
    "returns": r".*returns.*[.]json/part-.*[.]txt",
    "products": r".*products[.]json/part-.*[.]txt",
    "vendors": r".*vendors[.]csv/part-.*[.]csv",
}

Query = Callable[[SparkSession, str], DataFrame]


def _write_csv(rows: DataFrame, root: str, entity: str, names: Sequence[str]) -> None:
    for name in names:
        columns = [F.col(c).alias(fv.BRONZE_KEYS[entity][c]) for c in CSV_FILES[entity][name]]
        of_file = rows.where(F.col("_source_file") == name).select(*columns)
        of_file.write.option("header", "true").csv(f"{root}/{name}")


def _write_json(landed: DataFrame, root: str, names: Sequence[str], pretty: bool = False) -> None:
    """One array per part, each object with only the keys that have a value, on one line or, if pretty, on many."""

    def as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            lines = []
            for line in batch["value"]:
                lines.append(lead + line)
                lead = ","
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    for name in names:
        present = F.map_filter("raw_data", lambda key, value: value.isNotNull())
        text = F.to_json(present, {"pretty": str(pretty).lower()})
        objects = landed.where(F.col("_source_file") == name).select(text.alias("value"))
        objects.mapInPandas(as_array, "value string").write.text(f"{root}/{name}")


def _write_files(spark: SparkSession, sf_dir: str, root: str, entities: Sequence[str], only: Sequence[str] = ()) -> None:
    for entity in entities:
        names = [n for n in CSV_FILES.get(entity, JSON_FILES.get(entity)) if not only or n in only]
        if entity in CSV_FILES:
            _write_csv(driver_tables.raw(spark, sf_dir, entity), root, entity, names)
        else:
            _write_json(driver_tables.landing(spark, sf_dir, entity), root, names)


def _whole_file(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, PART, ""))


def _ingested(entity: str) -> Query:
    """Files of one entity, landed and extracted; the load time is the run's own and left out."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
        _write_files(spark, sf_dir, root, [entity])
        ingest.ingest(spark, root, tables, routes=PART_ROUTES)
        bronze = extract(tables.read(ingest.landing_name(entity)), entity).drop("_load_timestamp")
        return _whole_file(bronze, "_source_file")

    return query


def _json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns as arrays over many lines, landed at a given time and extracted."""
    root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
    _write_json(driver_tables.landing(spark, sf_dir, "returns"), root, JSON_FILES["returns"], pretty=True)
    ingest.ingest(spark, root, tables, load_time=datetime(2024, 1, 1), routes=PART_ROUTES)
    return _whole_file(extract(tables.read(ingest.landing_name("returns")), "returns"), "_source_file")


def _ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
    _write_files(spark, sf_dir, root, ["customers", "orders", "returns", "vendors"])
    report = ingest.ingest(spark, root, tables, routes=PART_ROUTES)
    by_file = _whole_file(report, "source_file").groupBy("entity", "source_file", "status", "message")
    return by_file.agg(F.sum("row_count").alias("row_count"))


def _new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops and three incremental loads; no file lands twice."""
    root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
    drops = (("Region1/orders_1.csv", "Region3/orders_2.csv"), ("Region5/orders_3.csv",), ())
    for drop in drops:
        if drop:
            _write_files(spark, sf_dir, root, ["orders"], drop)
        ingest.ingest(spark, root, tables, mode="incremental", routes=PART_ROUTES)
    landed = _whole_file(tables.read("landing_orders"), "_source_file")
    return landed.groupBy("_source_file").agg(F.count("*").alias("row_count"))


# Incremental loads of landing rows

LATE_FILE = "Region4/transactions_2.csv"
LATE_ORDERS = "Region1/orders_1.csv"


def _land(spark: SparkSession, sf_dir: str, tables: Tables, entity: str, keep=None, moment: datetime | None = None) -> None:
    rows = driver_tables.landing(spark, sf_dir, entity)
    rows = rows if keep is None else rows.where(keep)
    if moment is not None:
        rows = rows.withColumn("_load_timestamp", files.timestamp(moment))
    tables.append(ingest.landing_name(entity), rows)


def _incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops of all six entities by load time; every layer takes only what is newer, and an extra run adds nothing."""
    tables = Tables(spark, new_path(spark, "warehouse"))
    minute = F.minute("_load_timestamp")
    for drop in (minute == 0, minute == 1, minute >= 2, None):
        for entity in fv.ENTITIES if drop is not None else ():
            _land(spark, sf_dir, tables, entity, drop)
        pipeline.refresh_silver(tables, "incremental")
    rejected = tables.read("rejected_records")
    parts = [rejected.select("source_table", "record_key", "affected_field", "_source_file")]
    for entity, key in rules.RECORD_KEY.items():
        parts.append(tables.read(f"clean_{entity}").select(
            F.lit(f"clean_{entity}").alias("source_table"), F.col(key).alias("record_key"),
            F.lit(None).cast("string").alias("affected_field"), "_source_file",
        ))
    return reduce(DataFrame.unionByName, parts)


def _late_lines(repair: bool, table: str = "fact_sales") -> Query:
    """Lines and return events of one file land after their orders' facts were written.

    A plain run leaves the lines out; a repairing run adds them, also after plain runs and when it is repeated.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, new_path(spark, "warehouse"))
        late_order = F.col("_source_file") == LATE_ORDERS
        late_line = F.col("_source_file") == LATE_FILE
        for entity in ("customers", "returns", "products", "vendors"):
            _land(spark, sf_dir, tables, entity)
        _land(spark, sf_dir, tables, "orders", ~late_order)
        _land(spark, sf_dir, tables, "transactions", ~late_line)
        pipeline.transform_tables(tables)
        _land(spark, sf_dir, tables, "orders", late_order, datetime(2024, 1, 2))
        _land(spark, sf_dir, tables, "transactions", late_line, datetime(2024, 1, 2))
        for _ in range(2):
            pipeline.transform_tables(tables)
        for _ in range(2 if repair else 0):
            pipeline.transform_tables(tables, repair_late=True)
        return tables.read(table)

    return query


def _full_refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts after two full refreshes: the second replaces, it does not add."""
    tables = Tables(spark, new_path(spark, "warehouse"))
    for entity in fv.ENTITIES:
        _land(spark, sf_dir, tables, entity)
    for _ in range(2):
        pipeline.refresh_silver(tables, "full")
        pipeline.refresh_gold(tables, "full")
    names = [*[f"clean_{e}" for e in fv.ENTITIES], "rejected_records", *pipeline.DIMENSIONS, "fact_sales", "fact_returns", "bridge_return_products"]
    counts = [tables.read(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in names]
    found = counts[0]
    for count in counts[1:]:
        found = found.unionByName(count)
    return found


def _stored_view(name: str) -> Query:
    """A report that is a view, read by its name from the session of a built warehouse."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, new_path(spark, "warehouse"))
        for entity in fv.ENTITIES:
            _land(spark, sf_dir, tables, entity)
        pipeline.transform_tables(tables, "full")
        pipeline.create_views(tables)
        return spark.table(name)

    return query


# Streams


def _streamed_orders(spark: SparkSession, sf_dir: str) -> tuple[Tables, dict[str, int]]:
    """Three drops of files with a run after each, and a last run that finds nothing."""
    root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
    checkpoint = new_path(spark, "stream")
    rows = {}
    for drop in (*CSV_FILES["orders"], None):
        if drop is not None:
            _write_files(spark, sf_dir, root, ["orders"], [drop])
        rows = streams.run_once(spark, root, tables, checkpoint, gold=False)
    return tables, rows


def _stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _streamed_orders(spark, sf_dir)
    landed = _whole_file(tables.read("landing_orders"), "_source_file")
    return landed.groupBy("_source_file").agg(F.count("*").alias("row_count"))


def _stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = _streamed_orders(spark, sf_dir)
    return _whole_file(tables.read("clean_orders").drop("_load_timestamp"), "_source_file")


def _reset_and_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are streamed, the warehouse is reset, and the same files are streamed again."""
    root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
    checkpoint = new_path(spark, "stream")
    _write_files(spark, sf_dir, root, ["orders"])
    streams.run_once(spark, root, tables, checkpoint, gold=False)
    streams.reset(tables, checkpoint)
    streams.run_once(spark, root, tables, checkpoint, gold=False)
    return _whole_file(tables.read("clean_orders").drop("_load_timestamp"), "_source_file")


def _stream_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the last run read, beside the rows that are there."""
    tables, last = _streamed_orders(spark, sf_dir)
    return tables.read("raw_orders").agg(
        F.lit("orders").alias("entity"), F.count("*").alias("bronze_count"), F.lit(last["orders"]).cast("bigint").alias("rows_in_last_run")
    )


def _streamed_gold(late_gold: bool) -> Query:
    """All six entities as two drops of files; the second brings orders and lines of the first one's counterparts.

    With ``late_gold`` the calls that read rows leave gold out, as if they had broken off, and a last call, which
    finds nothing new, makes up for it.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, tables = new_path(spark, "files"), Tables(spark, new_path(spark, "warehouse"))
        checkpoint = new_path(spark, "stream")
        second = {"orders": [LATE_ORDERS], "transactions": [LATE_FILE]}
        names = {**{e: list(f) for e, f in CSV_FILES.items()}, **{e: list(f) for e, f in JSON_FILES.items()}}

        def run(gold: bool) -> None:
            streams.run_once(
                spark, root, tables, checkpoint, gold, repair_late=True, routes=PART_ROUTES, reports=False
            )

        for entity in fv.ENTITIES:
            _write_files(spark, sf_dir, root, [entity], [n for n in names[entity] if n not in second.get(entity, ())])
        run(not late_gold)
        for entity, late in second.items():
            _write_files(spark, sf_dir, root, [entity], late)
        run(not late_gold)
        if late_gold:
            run(True)
        shown = {
            "fact_sales": ("customer_sk", "product_sk", "sales"),
            "fact_returns": ("customer_sk", "return_reason", "refund_amount"),
            "bridge_return_products": ("product_sk", "product_id", "allocated_refund"),
        }
        parts = [
            tables.read(name).select(
                F.lit(name).alias("table_name"), "order_id", F.col(a).alias("first_key"), F.col(b).alias("second_key"),
                F.col(amount).alias("amount"),
            )
            for name, (a, b, amount) in shown.items()
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    return query


LOADS: dict[str, Query] = {
    "ingest_csv_customers": _ingested("customers"),
    "ingest_csv_transactions": _ingested("transactions"),
    "ingest_json_returns": _ingested("returns"),
    "ingest_json_array": _json_array,
    "ingest_report": _ingest_report,
    "ingest_new_files_only": _new_files_only,
    "incremental_append": _incremental_append,
    "incremental_facts_late_data": _late_lines(repair=False),
    "incremental_facts_repaired": _late_lines(repair=True),
    "incremental_returns_late_data": _late_lines(repair=False, table="fact_returns"),
    "incremental_returns_repaired": _late_lines(repair=True, table="fact_returns"),
    "full_refresh_idempotent": _full_refresh_twice,
    "stored_view_segments": _stored_view("mv_segment_profitability"),
    "stored_view_audit": _stored_view("pipeline_audit_log"),
    "stream_ingest_available_now": _stream_landing,
    "stream_equals_batch": _stream_equals_batch,
    "stream_skip_empty": _stream_skip_empty,
    "reset_and_reload": _reset_and_reload,
    "stream_to_gold": _streamed_gold(late_gold=False),
    "stream_retry_gold": _streamed_gold(late_gold=True),
}
