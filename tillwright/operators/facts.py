"""Facts and the refund bridge.

Each attribute is looked up on the smallest relation that has its key: customers and order dates on the
orders, before these meet the far more numerous lines. A lookup nobody asks for is not joined at all, which
leaves the rows unchanged because every dimension holds its key once.

A surrogate key is a hash of its business key. Rows are shuffled with a flag in the place of each surrogate key, and
get the keys when they are written or handed out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.keys import surrogate_key
from tillwright.functions.numbers import exact_sum, ratio, rounded
from tillwright.operators.dimensions import date_attributes


def lookup(rows: DataFrame, dimension: DataFrame, key: str, dim_key: str, columns: Sequence[str]) -> DataFrame:
    """Left join that adds ``columns`` of a dimension; rows without a match get NULLs."""
    if not columns:
        return rows
    wanted = dimension.select(F.col(dim_key).alias("_dim_key"), *columns)
    return rows.join(wanted, rows[key] == wanted["_dim_key"], "left").drop("_dim_key")


def with_date(rows: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Calendar attributes of a date column; they are computed in place, as the calendar holds every date there is."""
    known = date_attributes(day)
    return rows.withColumns({c: known[c] for c in columns}) if columns else rows


def keyed_orders(
    orders: DataFrame, dim_customers: DataFrame, customer: Sequence[str] = (), date: Sequence[str] = ()
) -> DataFrame:
    """Orders with customer and order-date attributes."""
    rows = orders.withColumn("order_date_key", F.col("order_purchase_date").cast("date"))
    rows = lookup(rows, dim_customers, "customer_id", "customer_id", customer)
    return with_date(rows, "order_date_key", date)


def sales_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders and their lines; the order's vendor wins over the line's.

    Columns of the lines that would clash with those of the order are dropped.
    """
    own = lines.drop("_source_file", "_load_timestamp")
    if "vendor_id" in own.columns:
        own = own.withColumnRenamed("vendor_id", "line_vendor_id")
    joined = orders.join(own, "order_id")
    if "line_vendor_id" not in joined.columns:
        return joined
    vendor = F.coalesce("vendor_id", "line_vendor_id")
    return joined.withColumn("vendor_id", vendor).drop("line_vendor_id")


# The business key that each surrogate key of a fact is the hash of.
KEYED_BY = {
    "customer_sk": "customer_id",
    "product_sk": "product_id",
    "vendor_sk": "vendor_id",
    "order_date_sk": "order_date_key",
    "return_date_sk": "return_date_key",
}
HAS = "_has_"

# Adds the flag of a surrogate key to rows that have the business key: (rows, "customer") -> rows.
Mark = Callable[[DataFrame, str], DataFrame]


def slim_names(names: Sequence[str]) -> list[str]:
    return [HAS + c if c in KEYED_BY else c for c in names]


def slim(rows: DataFrame) -> DataFrame:
    """Rows of a fact with flags in the place of their surrogate keys."""
    return rows.select(*[F.col(c).isNotNull().alias(HAS + c) if c in KEYED_BY else F.col(c) for c in rows.columns])


def with_keys(rows: DataFrame) -> DataFrame:
    """Slim rows with their surrogate keys."""
    keys = {HAS + sk: F.when(F.col(HAS + sk), surrogate_key(key)).alias(sk) for sk, key in KEYED_BY.items()}
    return rows.select(*[keys.get(c, F.col(c)) for c in rows.columns])


def known_in(dimensions: Mapping[str, DataFrame]) -> Mark:
    """Flags by a look into the dimension."""

    def mark(rows: DataFrame, name: str) -> DataFrame:
        key = f"{name}_id"
        ids = dimensions[name].select(F.col(key).alias("_dim_key"), F.lit(True).alias(f"{HAS}{name}_sk"))
        return rows.join(ids, rows[key] == ids["_dim_key"], "left").drop("_dim_key")

    return mark


def unknown(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """The different keys of rows that a dimension lacks."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(dimension.select(key), key, "left_anti")


def known_but(lacking: Mapping[str, DataFrame]) -> Mark:
    """Flags by a look into the keys that the dimension lacks, which are few as a rule."""

    def mark(rows: DataFrame, name: str) -> DataFrame:
        key = f"{name}_id"
        ids = lacking[name].select(F.col(key).alias("_lacking"))
        has = F.col(key).isNotNull() & F.col("_lacking").isNull()
        return rows.join(ids, rows[key] == ids["_lacking"], "left").withColumn(f"{HAS}{name}_sk", has).drop("_lacking")

    return mark


FACT_SALES = (
    "order_id", "customer_sk", "customer_id", "product_sk", "product_id", "vendor_sk", "vendor_id",
    "order_date_sk", "order_date_key", "sales", "quantity", "discount", "profit", "ship_mode",
    "order_status", "order_purchase_date", "payment_type", "_load_timestamp",
)
# What of the sales doesn't depend on the dimensions.
OWN_SALES = tuple(c for c in FACT_SALES if c not in KEYED_BY)


def own_sales(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """Order-line grain, without surrogate keys."""
    return sales_lines(with_day(orders), transactions).select(*OWN_SALES)


def with_day(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date_key", F.col("order_purchase_date").cast("date"))


def dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn(f"{HAS}order_date_sk", F.col("order_date_key").isNotNull())


def slim_sales(orders: DataFrame, transactions: DataFrame, mark: Mark) -> DataFrame:
    """Order-line grain, with flags for surrogate keys."""
    joined = sales_lines(mark(with_day(orders), "customer"), mark(transactions, "product"))
    return mark(dated(joined), "vendor").select(*slim_names(FACT_SALES))


def returns(
    returned: DataFrame,
    orders: DataFrame,
    dim_customers: DataFrame,
    customer: Sequence[str] = ("customer_sk",),
    date: Sequence[str] = ("date_sk",),
) -> DataFrame:
    """Return-event grain; the customer is found on the orders, whose customer ids are never NULL."""
    keyed = keyed_orders(orders, dim_customers, customer).select(
        "order_id", "customer_id", "vendor_id", *customer
    )
    rows = returned.drop("_source_file").join(keyed, "order_id", "left")
    rows = with_date(rows, "return_date", date)
    return rows.withColumns({"return_date_key": F.col("return_date")})


FACT_RETURNS = (
    "order_id", "customer_sk", "customer_id", "return_date_sk", "return_date_key", "refund_amount",
    "return_reason", "return_status", "return_date", "vendor_id", "_load_timestamp",
)


def slim_returns(returned: DataFrame, orders: DataFrame, mark: Mark) -> DataFrame:
    """Return-event grain, with flags for surrogate keys."""
    keyed = mark(orders.select("order_id", "customer_id", "vendor_id"), "customer")
    rows = returned.drop("_source_file").join(keyed, "order_id", "left")
    rows = rows.withColumns(
        {"return_date_key": F.col("return_date"), f"{HAS}return_date_sk": F.col("return_date").isNotNull()}
    )
    return rows.select(*slim_names(FACT_RETURNS))


def bridge(fact_returns: DataFrame, product_sales: DataFrame) -> DataFrame:
    return bridge_keys(slim_bridge(fact_returns, product_sales))


def _other_date_sk(sk: Column, day: str) -> Column:
    """The date key where it is not that of the day: of several returns the largest key need not be of the latest day."""
    own = F.when(F.col(day).isNotNull(), surrogate_key(day))
    return F.when(~sk.eqNullSafe(own), sk).alias("_other_date_sk")


def slim_bridge_rows(rows: DataFrame) -> DataFrame:
    """Rows of the bridge with a flag in the place of the product's surrogate key, and of few date keys."""
    product = F.col("product_sk").isNotNull().alias(f"{HAS}product_sk")
    date = _other_date_sk(F.col("return_date_sk"), "return_date_key")
    return rows.select(*[{"product_sk": product, "return_date_sk": date}.get(c, F.col(c)) for c in rows.columns])


def bridge_keys(rows: DataFrame) -> DataFrame:
    """Slim rows of the bridge with their surrogate keys."""
    own = F.when(F.col("return_date_key").isNotNull(), surrogate_key("return_date_key"))
    date = F.coalesce("_other_date_sk", own).alias("return_date_sk")
    return with_keys(rows.select(*[date if c == "_other_date_sk" else F.col(c) for c in rows.columns]))


def slim_bridge(fact_returns: DataFrame, product_sales: DataFrame) -> DataFrame:
    """Each refund spread over the products of its order, by their share of the order's sales.

    ``product_sales`` has order_id, product_sk, product_id, sales at any finer grain; any value tells of a key. Order totals are a window over
    the sums per product, which lie by order: joined back as an aggregate, all lines would be joined, sorted and summed
    a second time. A window keeps the products of one order at a time, on disk where they are many.
    """
    returned = fact_returns.groupBy("order_id").agg(
        F.max("return_date_sk").alias("return_date_sk"),
        F.max("return_date_key").alias("return_date_key"),
        F.max("return_reason").alias("return_reason"),
        F.max("return_status").alias("return_status"),
        exact_sum(F.col("refund_amount")).alias("refund_amount"),
        F.max("_load_timestamp").alias("_load_timestamp"),
    )
    returned = returned.withColumn("_other_date_sk", _other_date_sk(F.col("return_date_sk"), "return_date_key"))
    lines = product_sales.select("order_id", F.col("product_sk").isNotNull().alias("_known"), "product_id", "sales")
    # lines and sums lie by order from here on
    lines = lines.join(returned.select("order_id"), "order_id", "left_semi")
    # products without a key count as one
    lines = lines.withColumn("_product", F.when(F.col("_known"), F.col("product_id")))
    by_product = lines.groupBy("order_id", "_product").agg(
        F.max("product_id").alias("product_id"), exact_sum(F.col("sales")).alias("line_sales")
    )
    total = exact_sum(F.col("line_sales")).over(Window.partitionBy("order_id"))
    weight = ratio(F.col("line_sales"), F.col("total_order_sales"))
    share = (F.col("refund_amount").cast("double") * F.col("allocation_weight")).cast("decimal(38,6)")
    return (
        by_product.withColumn("total_order_sales", total)
        .join(returned, "order_id")
        .withColumn("allocation_weight", weight)
        .withColumn("allocated_refund", rounded(share))
        .select(
            "order_id",
            F.col("_product").isNotNull().alias(f"{HAS}product_sk"),
            "product_id",
            "_other_date_sk",
            "return_date_key",
            "return_reason",
            "return_status",
            F.col("refund_amount").cast("double").alias("refund_amount"),
            F.col("line_sales").cast("double").alias("line_sales"),
            F.col("total_order_sales").cast("double").alias("total_order_sales"),
            "allocation_weight",
            "allocated_refund",
            "_load_timestamp",
        )
    )
