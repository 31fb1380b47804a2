"""Facts are shuffled with flags in the place of their surrogate keys, which they get when they are written."""

from __future__ import annotations

from datetime import date
from hashlib import md5

from pyspark.sql import functions as F

from tillwright.operators import facts
from tillwright.plans import changes, metrics
from tillwright.plans.mart import Mart
from tillwright.sources.tables import Tables, part_of


def _key(value: object) -> str:
    return md5(str(value).encode()).hexdigest()


def _sales(spark):
    orders = spark.createDataFrame([("O1", "C1", None), ("O2", "C9", "V1")], "order_id string, customer_id string, vendor_id string")
    orders = orders.selectExpr(
        "*", "'a' as ship_mode", "'b' as order_status", "timestamp_ntz'2020-01-02 03:04:05' as order_purchase_date",
        "'f' as _source_file", "timestamp_ntz'2024-01-01' as _load_timestamp",
    )
    lines = spark.createDataFrame(
        [("O1", "P1", "V2"), ("O1", "P9", None), ("O2", "P1", "V2")], "order_id string, product_id string, vendor_id string"
    ).selectExpr(
        "*", "1.0D as sales", "1L as quantity", "0.0D as discount", "0.0D as profit", "'c' as payment_type",
        "'f' as _source_file", "timestamp_ntz'2024-01-01' as _load_timestamp",
    )
    dimensions = {n: spark.createDataFrame([(k,)], f"{n}_id string") for n, k in (("customer", "C1"), ("product", "P1"), ("vendor", "V1"))}
    return orders, lines, dimensions


def test_keys_are_made_after_the_shuffle(spark, tmp_path):
    orders, lines, dimensions = _sales(spark)
    slim = facts.slim_sales(orders, lines, facts.known_in(dimensions))
    assert not [c for c in slim.columns if c.endswith("_sk") and not c.startswith(facts.HAS)]
    tables = Tables(spark, str(tmp_path / "w"))
    tables.replace("fact_sales", slim, "order_id", 8, facts.with_keys)
    rows = tables.read("fact_sales").select(*facts.FACT_SALES).collect()
    found = {(r["order_id"], r["product_id"]): (r["customer_sk"], r["product_sk"], r["vendor_sk"], r["order_date_sk"]) for r in rows}
    day = _key(date(2020, 1, 2))
    assert found == {
        ("O1", "P1"): (_key("C1"), _key("P1"), None, day),
        ("O1", "P9"): (_key("C1"), None, None, day),
        ("O2", "P1"): (None, _key("P1"), _key("V1"), day),
    }


def test_keys_that_a_dimension_lacks_give_the_same_flags(spark):
    orders, lines, dimensions = _sales(spark)
    rows = {"customer": orders, "product": lines, "vendor": orders.select("vendor_id").union(lines.select("vendor_id"))}
    lacking = {n: facts.unknown(rows[n], dimensions[n], f"{n}_id") for n in rows}
    assert {n: [r[0] for r in ids.collect()] for n, ids in lacking.items()} == {"customer": ["C9"], "product": ["P9"], "vendor": ["V2"]}
    marks = [facts.with_keys(facts.slim_sales(orders, lines, m)) for m in (facts.known_in(dimensions), facts.known_but(lacking))]
    first, second = (sorted(map(str, m.collect())) for m in marks)
    assert first == second


def test_bridge_keeps_the_largest_date_key(spark):
    """Of two returns of an order the larger key is that of the earlier day."""
    days = sorted((date(2020, 1, d) for d in range(1, 29)), key=_key)
    late = min(days[:-1], key=lambda d: (d < days[-1], d))
    returned = spark.createDataFrame(
        [("O1", _key(d), d, 5.0) for d in (days[-1], late)],
        "order_id string, return_date_sk string, return_date_key date, refund_amount double",
    ).selectExpr("*", "'r' as return_reason", "'s' as return_status", "timestamp_ntz'2024-01-01' as _load_timestamp")
    lines = spark.createDataFrame(
        [("O1", _key("P1"), "P1", 3.0), ("O1", None, "P2", 1.0), ("O1", None, "P3", 1.0), ("O2", _key("P1"), "P1", 1.0)],
        "order_id string, product_sk string, product_id string, sales double",
    )
    slim = facts.slim_bridge(returned, lines)
    rows = facts.bridge_keys(slim).orderBy("product_id").collect()
    assert [(r["product_sk"], r["product_id"], r["line_sales"]) for r in rows] == [(_key("P1"), "P1", 3.0), (None, "P3", 2.0)]
    assert {(r["return_date_sk"], r["return_date_key"]) for r in rows} == {(_key(days[-1]), max(days[-1], late))}
    again = facts.bridge_keys(facts.slim_bridge_rows(facts.bridge_keys(slim))).orderBy("product_id").collect()
    assert again == rows


def test_lacking_rows_are_those_of_except_all(spark):
    columns = "order_id string, a string, b double"
    now = spark.createDataFrame([("O1", "x", 1.0), ("O1", "x", 1.0), ("O1", "x", 1.0), ("O1", None, None), ("O2", None, 2.0)], columns)
    stored = spark.createDataFrame([("O1", "x", 1.0), ("O1", None, None), ("O3", "y", 1.0)], columns)
    found, wanted = changes._lacking(now, stored), now.exceptAll(stored)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert found.count() == 3


def test_tables_are_written_small(spark, tmp_path):
    Tables(spark, str(tmp_path / "w")).replace("t", spark.range(5))
    assert [f for f in (tmp_path / "w" / "t").iterdir() if f.name.endswith(".zstd.parquet")]


def _scans(rows, column):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "FileScan" in x and f"{column}#" in x]


def test_the_bridge_reads_lines_once(spark, tmp_path):
    """Order totals are taken from the sums per product and not from the lines anew."""
    returned = spark.createDataFrame([("O1", 6.0)], "order_id string, refund_amount double").selectExpr(
        "*", "'d' as return_date_sk", "date'2020-01-01' as return_date_key", "'r' as return_reason", "'s' as return_status",
        "timestamp_ntz'2024-01-01' as _load_timestamp",
    )
    spark.createDataFrame(
        [("O1", "k", "P1", 1.0), ("O1", "k", "P1", 1.0), ("O1", None, "P2", 4.0), ("O2", "k", "P1", 1.0)],
        "order_id string, product_sk string, product_id string, sales double",
    ).write.parquet(str(tmp_path / "lines"))
    bridge = facts.slim_bridge(returned, spark.read.parquet(str(tmp_path / "lines")))
    assert len(_scans(bridge, "sales")) == 1
    assert sorted((r["product_id"], r["total_order_sales"], r["allocated_refund"]) for r in bridge.collect()) == [
        ("P1", 6.0, 2.0), ("P2", 6.0, 4.0),
    ]


def test_refunds_per_product_make_no_keys(spark):
    """Without stored facts products are told by their ids, and hashes are neither shuffled nor grouped by."""
    orders, lines, _ = _sales(spark)
    returned = spark.createDataFrame([("O1", 9.0)], "order_id string, refund_amount double").selectExpr(
        "*", "'r' as return_reason", "'s' as return_status", "date'2020-01-05' as return_date", "'f' as _source_file",
        "timestamp_ntz'2024-01-01' as _load_timestamp",
    )
    customers = spark.createDataFrame([("C1", "n", None, "s", "c", "t", "East")], "customer_id string, customer_name string, "
        "customer_email string, segment string, city string, state string, region string")  # fmt: skip
    lineage = ("'f' as _source_file", "timestamp_ntz'2024-01-01' as _load_timestamp")
    products = spark.createDataFrame([("P1",)], "product_id string").selectExpr(
        "*", *[f"'{c}' as {c}" for c in ("product_name", "brand", "category", "sub_category", "upc")], *lineage
    )
    clean = {"orders": orders, "transactions": lines, "returns": returned, "customers": customers.selectExpr("*", *lineage), "products": products}
    mart = Mart(stored={f"clean_{e}": rows for e, rows in clean.items()})
    impact = metrics.mv_product_return_impact(mart)
    assert "md5(" not in impact._jdf.queryExecution().executedPlan().toString()
    # P9 is unknown, so that half of the refund is no product's
    assert [(r["product_id"], r["product_name"], r["region"], r["total_return_cost"]) for r in impact.collect()] == [
        ("P1", "product_name", "East", 4.5)
    ]


def test_rows_joined_by_the_key_are_not_shuffled_to_their_parts(spark, tmp_path):
    tables, before = Tables(spark, str(tmp_path / "w")), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(0, 2000, 1, 6).selectExpr("concat('O', id) as order_id")
        rows = ids.join(ids.withColumn("n", F.length("order_id")), "order_id")
        plan = tables._rows_by_part(rows, "order_id", 8, lying=True)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "REBALANCE" not in plan
        # a task would have rows of 64 parts
        assert "REBALANCE" in tables._rows_by_part(rows, "order_id", 256, lying=True)._jdf.queryExecution().executedPlan().toString()
        tables.replace("t", rows, "order_id", 8, lying=True)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert tables.parts("t") == 8
    files = [f for f in (tmp_path / "w" / "t").rglob("*.zstd.parquet") if "empty_of_" not in str(f)]
    assert len(files) <= 8 and tables.read("t").count() == 2000
    part = spark.range(1).select(part_of(F.lit("O7"), 8)).first()[0]
    assert tables.read("t", [part]).where("order_id = 'O7'").count() == 1


def test_parts_by_another_hash_are_not_taken_for_parts(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "w"))
    spark.range(3).write.parquet(f"{tables.path('t')}/hash_part=1_of_8")
    assert tables.parts("t") is None
