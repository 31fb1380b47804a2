"""The star as data: tables, many-to-one joins, and the standing questions answered from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.numbers import exact_sum, percentage, rounded
from tillwright.operators import checks
from tillwright.operators.facts import lookup, with_date
from tillwright.plans import metrics
from tillwright.plans.mart import Mart


@dataclass(frozen=True)
class ManyToOne:
    left_table: str
    right_table: str
    left_key: str
    right_key: str


JOINS = (
    ManyToOne("fact_sales", "dim_customers", "customer_sk", "customer_sk"),
    ManyToOne("fact_sales", "dim_products", "product_sk", "product_sk"),
    ManyToOne("fact_sales", "dim_vendors", "vendor_sk", "vendor_sk"),
    ManyToOne("fact_sales", "dim_dates", "order_date_sk", "date_sk"),
    ManyToOne("fact_returns", "dim_customers", "customer_sk", "customer_sk"),
    ManyToOne("fact_returns", "dim_dates", "return_date_sk", "date_sk"),
)


def star(mart: Mart, fact: str, attributes: dict[str, Sequence[str]]) -> DataFrame:
    """A fact with the named attributes of its dimensions; rows without a match keep NULLs."""
    rows = getattr(mart, fact)
    for table, columns in attributes.items():
        declared = [j for j in JOINS if (j.left_table, j.right_table) == (fact, table)]
        if not declared:
            raise ValueError(f"no join is declared from {fact} to {table}")
        clash = set(columns) & set(rows.columns)
        if clash:
            raise ValueError(f"{table} columns already present: {sorted(clash)}")
        if table == "dim_dates":
            rows = with_date(rows, declared[0].left_key.replace("_sk", "_key"), columns)
        else:
            rows = lookup(rows, getattr(mart, table), declared[0].left_key, declared[0].right_key, columns)
    return rows


def join_cardinality(mart: Mart) -> DataFrame:
    """Per declared join, how many right-side keys break many-to-one."""

    def duplicates(join: ManyToOne) -> DataFrame:
        repeated = checks.unique(getattr(mart, join.right_table), join.right_key)
        return repeated.agg(F.count("*").alias("duplicate_keys")).select(
            F.lit(join.left_table).alias("left_table"),
            F.lit(join.right_table).alias("right_table"),
            F.lit(f"{join.left_key} = {join.right_key}").alias("condition"),
            "duplicate_keys",
        )

    return reduce(DataFrame.unionByName, [duplicates(j) for j in JOINS])


def revenue_by_region(mart: Mart) -> DataFrame:
    rows = mart.order_sales(customer=["region"]).groupBy("region")
    return rows.agg(rounded(F.sum("sales")).alias("total_revenue"))


def vendors_by_return_rate(mart: Mart) -> DataFrame:
    rates = metrics.mv_return_rate_by_vendor(mart).select("vendor_id", "vendor_name", "return_rate_pct")
    return rates.orderBy(F.col("return_rate_pct").desc_nulls_last(), "vendor_id")


def top_products(mart: Mart, region: str = "West", k: int = 5) -> DataFrame:
    revenue = (
        mart.sales(customer=["region"], measures=["product_id", "sales"])
        .where(F.col("region") == region)
        .groupBy("product_id")
        .agg(rounded(exact_sum(F.col("sales"))).alias("total_revenue"))
    )
    names = mart.dim_products.select("product_id", "product_name")
    named = revenue.join(names, "product_id").select("product_id", "product_name", "total_revenue")
    return named.orderBy(F.col("total_revenue").desc_nulls_last(), "product_id").limit(k)


def customers_by_refund(mart: Mart) -> DataFrame:
    history = metrics.mv_customer_return_history(mart)
    columns = ("customer_id", "customer_name", "total_refund_value", "total_returns")
    return history.select(*columns).orderBy(F.col("total_refund_value").desc_nulls_last(), "customer_id")


def margin_by_segment(mart: Mart) -> DataFrame:
    rows = mart.order_sales(customer=["segment"]).where("segment is not null").groupBy("segment")
    return rows.agg(
        rounded(F.sum("sales")).alias("total_revenue"),
        rounded(F.sum("profit")).alias("total_profit"),
        percentage(F.sum("profit"), F.sum("sales")).alias("profit_margin_pct"),
    )
