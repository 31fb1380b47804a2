"""Gold follows the orders that a run changed, and nothing else is read or written."""

from __future__ import annotations

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.plans import changes, pipeline
from tillwright.session import new_path, stage
from tillwright.sources.ingest import landing_name
from tillwright.sources.landing import LANDING_SCHEMA
from tillwright.sources.tables import PART, Tables, part_of

FACTS = ("fact_sales", "fact_returns", "bridge_return_products")


def land(tables, hour, **entities):
    for entity in fv.ENTITIES:
        rows = [(row, f"{entity}.csv", datetime(2024, 1, 1, hour)) for row in entities.get(entity, [])]
        tables.append(landing_name(entity), tables.spark.createDataFrame(rows, LANDING_SCHEMA))


def order(i, customer="A", **more):
    return {"order_id": f"O{i}", "customer_id": customer, "vendor_id": "V1", "ship_mode": "1st", "order_status": "shipped",
            "order_purchase_date": "2018-01-05"} | more


def line(i, product="P1", sales="5"):
    return {"Order_id": f"O{i}", "Product_id": product, "vendor_id": "V1", "Sales": sales, "Quantity": "1", "discount": "0"}


def returned(i, amount="2"):
    return {"OrderId": f"O{i}", "reason": "Late", "status": "Pending", "amount": amount, "ReturnDate": "2018-01-09"}


def customer(name):
    return {"customer_id": name, "customer_name": name, "segment": "HO", "region": "East"}


@pytest.fixture(scope="module")
def built(spark):
    tables = Tables(spark, new_path(spark, "warehouse"))
    land(
        tables, 1, customers=[customer("A")], products=[{"product_id": "P1"}, {"product_id": "P2"}], vendors=[{"vendor_id": "V1"}],
        orders=[order(i) for i in range(40)], transactions=[line(i) for i in range(40)], returns=[returned(i) for i in range(0, 50, 2)],
    )
    pipeline.transform_tables(tables)
    return tables


@pytest.fixture
def tables(spark, built):
    own = Tables(spark, new_path(spark, "warehouse"))
    shutil.copytree(built.root, own.root)
    return own


def rows(tables, name):
    return sorted(map(str, tables.read(name).drop("_load_timestamp").collect()))


def check_as_built_anew(tables):
    """What the tables hold is what a full build of the same clean rows gives."""
    found = {name: rows(tables, name) for name in FACTS}
    pipeline.refresh_gold(tables, "full")
    assert found == {name: rows(tables, name) for name in FACTS}


def files_of(tables, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(tables.path(name)).rglob("*.parquet")}


def test_a_repair_gives_what_a_full_build_gives(tables):
    late = [order(44), order(46, "B"), order(99)]
    land(tables, 2, orders=late, transactions=[line(2, "P2", "15"), line(2), line(44)], returns=[returned(3)])
    pipeline.transform_tables(tables)
    land(tables, 3, customers=[customer("B")], transactions=[line(5, "P2"), line(44, "P2")], returns=[returned(44, "1"), returned(2)])
    pipeline.transform_tables(tables, repair_late=True)
    sales = tables.read("fact_sales").groupBy("order_id").count().where("order_id in ('O2', 'O5', 'O44')").collect()
    assert dict(sales) == {"O2": 3, "O5": 2, "O44": 2}
    # the customer of an order with a return was found only now
    assert tables.read("fact_returns").where("order_id = 'O46'").first()["customer_sk"] is not None
    for _ in range(2):
        pipeline.transform_tables(tables, repair_late=True)
    check_as_built_anew(tables)


def test_plain_runs_leave_late_lines_to_a_later_repair(tables):
    land(tables, 2, transactions=[line(4, "P2")], orders=[order(60)], returns=[returned(4, "3")])
    for _ in range(2):
        pipeline.transform_tables(tables)
    assert tables.read("fact_sales").where("order_id = 'O4'").count() == 1
    assert tables.read("bridge_return_products").where("order_id = 'O4'").first()["refund_amount"] == 5
    pipeline.transform_tables(tables, repair_late=True)
    assert tables.read("fact_sales").where("order_id = 'O4'").count() == 2
    check_as_built_anew(tables)


@pytest.mark.parametrize("repair", [False, True])
def test_parts_without_changed_orders_keep_their_files(tables, repair):
    before = {name: files_of(tables, name) for name in FACTS}
    land(tables, 2, orders=[order(70)], transactions=[line(70)], returns=[returned(70)])
    pipeline.transform_tables(tables, repair_late=repair)
    parts = changes.read_marks(tables).parts
    own = f"{PART}={tables.spark.range(1).select(part_of(F.lit('O70'), parts)).first()[0]}"
    for name in FACTS:
        after = files_of(tables, name)
        changed = {p for p in before[name].keys() | after.keys() if before[name].get(p) != after.get(p)}
        assert changed and all(f"/{own}/" in p for p in changed)


def test_a_repair_reads_changed_parts_only(tables):
    land(tables, 2, transactions=[line(7)])
    pipeline.refresh_silver(tables, "incremental")
    marks = changes.read_marks(tables)
    orders, of_returns = (stage(ids, "ids") for ids in changes.repaired(tables, marks))
    assert [tuple(r) for r in orders.collect()] == [("O7",)] and of_returns.isEmpty()
    whole = pipeline.mart(tables, without=changes.FACTS)
    plan = changes.missing_sales(tables, whole, orders, marks)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and "hash_part#" in x]
    assert scans and not any("PartitionFilters: []" in x for x in scans)
    marked = changes.repaired(tables, marks)[0]._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in marked.splitlines() if "FileScan" in x and "GreaterThan(_load_timestamp" in x]) == 2


@pytest.mark.parametrize("repair_again", [False, True])
@pytest.mark.parametrize("broken", ["renew_bridge", "renew_returns"])
def test_a_run_that_broke_off_is_made_up_for(tables, monkeypatch, broken, repair_again):
    def failing(*_):
        raise RuntimeError("lost")

    land(tables, 2, orders=[order(80)], transactions=[line(80), line(6, "P2")], returns=[returned(80)])
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(changes, broken, failing)
        pipeline.transform_tables(tables, repair_late=True)
    assert tables.read(changes.PENDING).count() > 0
    pipeline.transform_tables(tables, repair_late=repair_again)
    assert tables.read(changes.PENDING) is None
    check_as_built_anew(tables)


def test_without_marks_the_facts_are_built_whole(tables):
    land(tables, 2, transactions=[line(6, "P2")])
    tables.drop(changes.MARKS)
    pipeline.transform_tables(tables)
    check_as_built_anew(tables)


# Tables


def number(tables, name, parts=None):
    return sorted(r[0] for r in tables.read(name, parts).collect())


def test_replace_keeps_the_old_rows_until_the_new_ones_are_written(spark):
    tables = Tables(spark, new_path(spark, "warehouse"))
    tables.replace("t", spark.range(3))
    with pytest.raises(Exception, match="no such row"):
        tables.replace("t", spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no such row"))).alias("id")))
    assert number(tables, "t") == [0, 1, 2]
    tables.replace("t", tables.read("t").where("id > 0"))
    assert number(tables, "t") == [1, 2]
    # a run that broke off between the two renames
    Path(tables.path("t")).rename(tables.path("t") + ".old")
    assert number(tables, "t") == [1, 2]
    Path(tables.path("t")).rename(tables.path("t") + ".old")
    tables.replace("t", spark.range(7, 9))
    assert number(tables, "t") == [7, 8]
    assert not Path(tables.path("t") + ".old").exists()


def test_parts_are_replaced_one_by_one(spark):
    tables = Tables(spark, new_path(spark, "warehouse"))
    tables.replace("t", spark.range(100), "id", 4)
    of = {r["id"]: r["p"] for r in spark.range(100).select("id", part_of(F.col("id"), 4).alias("p")).collect()}
    names = [f"{i}_of_4" for i in range(4)]
    assert set(of.values()) == set(names) and tables.parts("t") == 4
    fresh = spark.range(100).where(part_of(F.col("id"), 4) == names[1]).where("id < 50")
    tables.replace_parts("t", fresh, "id", 4, names[1:3])  # part 2 has no rows now
    expected = [i for i in range(100) if of[i] in (names[0], names[3]) or of[i] == names[1] and i < 50]
    assert number(tables, "t") == expected
    assert number(tables, "t", names[1:2]) == [i for i in expected if of[i] == names[1]]
    # a run that broke off while a part was set aside: the next one puts it back
    aside = Path(tables.path("t") + f".old-parts/{PART}={names[0]}")
    aside.parent.mkdir(exist_ok=True)
    Path(tables.path("t") + f"/{PART}={names[0]}").rename(aside)
    tables.replace_parts("t", fresh, "id", 4, names[1:2])
    assert number(tables, "t") == expected
    tables.replace_parts("t", spark.range(0), "id", 4, names)
    assert number(tables, "t") == [] and tables.read("t").columns == ["id"] and tables.parts("t") == 4
    tables.replace_parts("t", spark.range(100).where(part_of(F.col("id"), 4) != names[2]).where(F.col("id").isin(*expected)), "id", 4, names)
    tables.append_parts("t", spark.range(100, 103), "id", 4)
    assert number(tables, "t") == [*expected, 100, 101, 102]


def test_bridge_rows_of_new_orders_are_added(tables):
    """Rows of other orders in the same part are neither read whole nor written again."""
    before = files_of(tables, "bridge_return_products")
    land(tables, 2, orders=[order(i) for i in range(100, 140)], transactions=[line(i) for i in range(100, 140)], returns=[returned(100)])
    pipeline.transform_tables(tables)
    after = files_of(tables, "bridge_return_products")
    assert before.items() < after.items()
    check_as_built_anew(tables)


def test_bridge_rows_added_by_a_run_that_broke_off_are_not_doubled(tables, monkeypatch):
    def failing(*_):
        raise RuntimeError("lost")

    land(tables, 2, orders=[order(100)], transactions=[line(100)], returns=[returned(100)])
    with monkeypatch.context() as patch:
        patch.setattr(changes, "forget", failing)
        with pytest.raises(RuntimeError):
            pipeline.transform_tables(tables)
    pipeline.transform_tables(tables)
    assert tables.read("bridge_return_products").where("order_id = 'O100'").count() == 1
    check_as_built_anew(tables)
