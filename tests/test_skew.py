"""One order, product, vendor or customer holds a large part of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillwright.operators import facts
from tillwright.plans import metrics
from tillwright.plans.mart import Mart


@pytest.fixture
def tiny_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_order_is_split(spark, tiny_partitions):
    """A third of the lines belong to one order; its rows are spread over several tasks and none is lost."""
    orders = spark.range(2000).selectExpr(
        "concat('O', id) as order_id", "concat('C', id % 50) as customer_id", "'V' as vendor_id",
        "cast('2020-01-01' as timestamp_ntz) as order_purchase_date",
    )
    lines = spark.range(0, 90_000, 1, 12).selectExpr(
        "if(id % 3 = 0, 'O1', concat('O', id % 2000)) as order_id", "md5(cast(id as string)) as product_id",
        "cast(id as double) as sales", "'V' as vendor_id",
    )
    joined = facts.sales_lines(orders, lines).select("order_id", "customer_id", "product_id", "sales")
    rows = joined.collect()
    assert len(rows) == 90_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_bridge_of_a_hot_order(spark, tiny_partitions):
    returns = spark.createDataFrame([("O1", 100.0), ("O2", 10.0)], "order_id string, refund_amount double").selectExpr(
        "*", "'d' as return_date_sk", "date'2020-01-01' as return_date_key", "'r' as return_reason",
        "'Approved' as return_status", "cast('2024-01-01' as timestamp_ntz) as _load_timestamp",
    )
    lines = spark.range(0, 40_000, 1, 8).selectExpr(
        "if(id % 4 = 0, 'O2', 'O1') as order_id", "md5(cast(id as string)) as product_sk", "cast(id as string) as product_id",
        "1.0D as sales",
    )
    found = facts.bridge(returns, lines)
    totals = found.groupBy("order_id").agg(F.count("*"), F.sum("allocation_weight"), F.first("total_order_sales")).orderBy("order_id")
    assert [tuple(r)[:2] for r in totals.collect()] == [("O1", 30_000), ("O2", 10_000)]
    assert [round(r[2], 6) for r in totals.collect()] == [1.0, 1.0]


class Crowded:
    """Returned orders of 1,000 vendors and 1,000 products, two of them of the same vendors, beside ordinary ones."""

    def __init__(self, spark, size=1000):
        self.size = size
        orders = "case when id < {0} then 'hot' when id < 2 * {0} then 'twin' when id % 2 = 0 then 'small' else 'other' end as order_id"
        self.bridge_return_products = spark.range(2 * size + 2).selectExpr(
            orders.format(size), f"concat('P', id % {size}) as product_id", "0.25D as allocated_refund"
        )
        self.lines = spark.range(2 * size + 3).selectExpr(orders.format(size), f"concat('V', id % {size}) as vendor_id")

    def sales(self, measures):
        return self.lines.select("order_id", *measures)

    def returns(self):
        return self.bridge_return_products.select("order_id")


def test_vendors_and_products_of_crowded_orders(spark, tiny_partitions):
    crowded = Crowded(spark)
    found = metrics.vendor_product_returns(crowded)
    counts = found.groupBy("return_count", "total_allocated_refund").count().collect()
    # 'small' has the product P0 and the vendors V0 and V2, 'other' has P1 and V1
    assert {(r[0], float(r[1])): r[2] for r in counts} == {(2, 0.5): 1000 * 1000 - 3, (3, 0.75): 3}
    three = {tuple(r) for r in found.where("return_count = 3").select("vendor_id", "product_id").collect()}
    assert three == {("V0", "P0"), ("V2", "P0"), ("V1", "P1")}


def test_pairs_are_made_once_for_a_set_of_vendors(spark, tiny_partitions):
    """A thousand orders of the same fifty vendors make the pairs of one."""
    class Alike:
        bridge_return_products = spark.range(1000).selectExpr(
            "concat('O', id) as order_id", "concat('P', id % 4) as product_id", "1.0D as allocated_refund"
        )

        def sales(self, measures):
            return spark.range(50_000).selectExpr("concat('O', id % 1000) as order_id", "concat('V', id div 1000) as vendor_id")

        def returns(self):
            return self.bridge_return_products.select("order_id")

    found = metrics.vendor_product_returns(Alike())
    assert {tuple(r) for r in found.select("return_count", "total_allocated_refund").distinct().collect()} == {(250, 250)}
    assert found.count() == 50 * 4


def test_copies_of_one_customer(spark):
    """A third of the records are one customer's; among the newest of them one with an email wins."""
    rows = spark.range(0, 20_000, 1, 8).selectExpr(
        "map('customer_id', if(id % 3 = 0, 'hot', concat('C', id)), 'customer_name', concat('n', id), 'segment', 'HO',"
        " 'region', 'W', 'customer_email', if(id % 8 = 3, concat('e', id), null)) as raw_data",
        "'Region1/customers_1.csv' as _source_file",
        "cast('2024-01-01' as timestamp_ntz) + make_dt_interval(0, 0, 0, id % 100) as _load_timestamp",
    )
    dim = Mart(lambda entity: rows).dim_customers
    (hot,) = dim.where("customer_id = 'hot'").collect()
    number = int(hot["customer_name"][1:])
    assert number % 3 == 0 and number % 100 == 99 and number % 8 == 3 and hot["customer_email"] == f"e{number}"
    assert dim.count() == 1 + 20_000 - 6_667


def test_sales_and_returns_of_vendors_and_products_are_queries_of_their_own(spark):
    """The report itself joins sums that are stored, so that what each query shuffled is gone by then."""
    class Tiny:
        lines = spark.createDataFrame(
            [("O1", "V1", "P1", "West", 2.0, 1, 0.5), ("O1", "V1", "P2", "West", 4.0, 2, 1.0), ("O2", "V1", "P1", "East", 8.0, 3, 2.0)],
            "order_id string, vendor_id string, product_id string, region string, sales double, quantity bigint, profit double",
        )
        bridge_return_products = spark.createDataFrame([("O2", "P1", 1.5)], "order_id string, product_id string, allocated_refund double")
        dim_vendors = spark.createDataFrame([("V1", "Vend")], "vendor_id string, vendor_name string")
        dim_products = spark.createDataFrame([("P1", "Pen", "B"), ("P2", "Ink", "B")], "product_id string, product_name string, brand string")

        def hold(self, *entities):
            return self

        def sales(self, customer=(), measures=()):
            return self.lines.select("order_id", *customer, *measures)

        def returns(self):
            return self.bridge_return_products.select("order_id")

    found = metrics.mv_vendor_product_performance(Tiny())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "order_id" not in plan and "allocated_refund#" not in plan.replace("total_allocated_refund#", "")
    columns = ("product_id", "region", "order_count", "total_sales", "total_quantity", "total_profit", "return_count", "total_allocated_refund")
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == [
        ("P1", "East", 1, 8.0, 3, 2.0, 1, 1.5), ("P1", "West", 1, 2.0, 1, 0.5, 1, 1.5), ("P2", "West", 1, 4.0, 2, 1.0, 0, 0.0),
    ]
