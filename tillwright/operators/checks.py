"""Assertions: each returns the offending rows, so an empty result passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.numbers import exact


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where("n_records > 1")


def accepted_values(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    outside = df.where(~F.col(column).isin(*allowed))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def in_range(
    df: DataFrame,
    column: str,
    min_value: float | None = None,
    max_value: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Values outside the range; NULLs pass. An exclusive range also rejects its bounds."""
    return df.where(_outside(column, min_value, max_value, inclusive)).select(column)


def _outside(column: str, min_value: float | None, max_value: float | None, inclusive: bool = True) -> Column:
    value = F.col(column)
    tests = []
    if min_value is not None:
        tests.append(value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        tests.append(value > max_value if inclusive else value >= max_value)
    if not tests:
        raise ValueError("in_range needs min_value or max_value")
    return reduce(or_, tests)


def audit_balanced(audit: DataFrame) -> DataFrame:
    gap = F.col("bronze_count") - (F.col("silver_count") + F.col("rejected_count"))
    return audit.withColumn("imbalance", gap).where("imbalance <> 0")


def allocation_sums(bridge: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose allocation weights do not add up to one."""
    total = F.sum(exact(F.col("allocation_weight")))
    return (
        bridge.groupBy("order_id")
        .agg(total.alias("_total"))
        .select(
            "order_id",
            F.round("_total", 4).cast("double").alias("total_weight"),
            F.abs(F.col("_total") - 1).cast("double").alias("deviation"),
        )
        .where(F.col("deviation") > tolerance)
    )


@dataclass(frozen=True)
class ColumnTest:
    """A declared test of one column. ``allowed`` are the accepted values, ``least`` and ``most`` the range."""

    table: str
    column: str
    kind: str
    allowed: tuple[str, ...] = ()
    least: float | None = None
    most: float | None = None


def _declared(table: str, kind: str, *columns: str) -> tuple[ColumnTest, ...]:
    return tuple(ColumnTest(table, c, kind) for c in columns)


# The tests that the stored tables are declared to pass.
COLUMN_TESTS = (
    *_declared("clean_customers", "not_null", "customer_id", "customer_name", "segment", "region"),
    ColumnTest("clean_customers", "segment", "accepted_values", fv.SEGMENTS),
    ColumnTest("clean_customers", "region", "accepted_values", fv.REGIONS),
    *_declared(
        "clean_orders", "not_null", "order_id", "customer_id", "ship_mode", "order_status", "order_purchase_date"
    ),
    ColumnTest("clean_orders", "ship_mode", "accepted_values", fv.SHIP_MODES),
    ColumnTest("clean_orders", "order_status", "accepted_values", fv.ORDER_STATUSES),
    *_declared("clean_products", "not_null", "product_id", "product_name"),
    *_declared("clean_returns", "not_null", "order_id", "return_status", "return_reason", "return_date"),
    ColumnTest("clean_returns", "refund_amount", "in_range", least=0),
    ColumnTest("clean_returns", "return_status", "accepted_values", fv.RETURN_STATUSES),
    *_declared("clean_transactions", "not_null", "order_id", "product_id", "sales", "quantity", "discount"),
    ColumnTest("clean_transactions", "sales", "in_range", least=0),
    ColumnTest("clean_transactions", "quantity", "in_range", least=1),
    ColumnTest("clean_transactions", "discount", "in_range", least=0, most=1),
    *_declared("clean_vendors", "not_null", "vendor_id", "vendor_name"),
    *_declared("dim_customers", "unique", "customer_sk", "customer_id"),
    *_declared("dim_customers", "not_null", "customer_sk", "customer_id"),
    *_declared("dim_dates", "unique", "date_sk", "date_key"),
    *_declared("dim_dates", "not_null", "date_sk", "date_key"),
    *_declared("dim_products", "unique", "product_sk"),
    *_declared("dim_products", "not_null", "product_sk", "product_id"),
    *_declared("dim_vendors", "unique", "vendor_sk", "vendor_id"),
    *_declared("dim_vendors", "not_null", "vendor_sk", "vendor_id"),
    *_declared("fact_returns", "not_null", "order_id"),
    *_declared("fact_sales", "not_null", "order_id"),
)


def _failing(test: ColumnTest) -> Column:
    """Rows of a table that fail; a NULL passes all tests but not_null."""
    if test.kind == "not_null":
        return F.count_if(F.col(test.column).isNull())
    if test.kind == "accepted_values":
        return F.count_if(~F.col(test.column).isin(*test.allowed))
    return F.count_if(_outside(test.column, test.least, test.most))


def column_tests(table: Callable[[str], DataFrame], tests: Iterable[ColumnTest] = COLUMN_TESTS) -> DataFrame:
    """One row per declared test with the number of failing rows, or of repeated values.

    All row-wise tests of a table are one pass over it; a uniqueness test is one aggregate.
    """
    tests = list(tests)
    parts = []
    for name in dict.fromkeys(t.table for t in tests):
        own = [t for t in tests if t.table == name]
        row_wise = [t for t in own if t.kind != "unique"]
        if row_wise:
            counts = table(name).agg(*[_failing(t).alias(f"n{i}") for i, t in enumerate(row_wise)])
            rows = F.array(*[
                F.struct(
                    F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test"),
                    F.col(f"n{i}").alias("failing"),
                )
                for i, t in enumerate(row_wise)
            ])
            parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
        for t in own:
            if t.kind == "unique":
                repeated = unique(table(name), t.column).agg(F.count("*").alias("failing"))
                parts.append(repeated.select(
                    F.lit(t.table).alias("table_name"), F.lit(t.column).alias("column_name"), F.lit(t.kind).alias("test"), "failing"
                ))
    return reduce(DataFrame.unionByName, parts)
