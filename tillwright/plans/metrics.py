"""Reports over the star. Measures are aggregated by key first; names are joined to the few result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.numbers import exact_sum, percentage, rounded, rounded_ratio
from tillwright.operators.quantiles import positions
from tillwright.plans.mart import Mart
from tillwright.session import stage

MONTH = ("year", "month", "month_name")


def _whole(col: Column) -> Column:
    return F.sum(col).cast("bigint")


def _mean(column: str) -> Column:
    """Average over the non-NULL values."""
    return rounded_ratio(exact_sum(F.col(column)), F.count(column))


def _monthly(mart: Mart) -> DataFrame:
    rows = mart.order_sales(customer=["region"], date=MONTH)
    return rows.where("region is not null and year is not null").groupBy(*MONTH, "region")


def mv_revenue_by_region(mart: Mart) -> DataFrame:
    return _monthly(mart).agg(
        F.countDistinct("order_id").alias("order_count"),
        rounded(F.sum("sales")).alias("total_sales"),
        rounded(F.sum("profit")).alias("total_profit"),
        _whole(F.col("quantity")).alias("total_quantity"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def mv_monthly_revenue_by_region(mart: Mart) -> DataFrame:
    """``avg_order_value`` is the mean of the order lines."""
    return _monthly(mart).agg(
        F.countDistinct("order_id").alias("order_count"),
        rounded(F.sum("sales")).alias("total_revenue"),
        rounded(F.sum("profit")).alias("total_profit"),
        _whole(F.col("quantity")).alias("total_quantity"),
        F.countDistinct("customer_id").alias("unique_customers"),
        rounded_ratio(F.sum("sales"), F.sum("lines")).alias("avg_order_value"),
    )


def mv_segment_profitability(mart: Mart) -> DataFrame:
    rows = mart.order_sales(customer=["segment", "region"]).where("region is not null")
    return rows.groupBy("segment", "region").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("customer_id").alias("customer_count"),
        rounded(F.sum("sales")).alias("total_revenue"),
        rounded(F.sum("profit")).alias("total_profit"),
        percentage(F.sum("profit"), F.sum("sales")).alias("profit_margin_pct"),
        rounded_ratio(F.sum("discount"), F.sum("lines"), 4).alias("avg_discount"),
    )


def mv_return_rate_by_vendor(mart: Mart) -> DataFrame:
    sold = (
        mart.sales(measures=["vendor_id", "sales"])
        .where("vendor_id is not null")
        .groupBy("vendor_id")
        .agg(F.countDistinct("order_id").alias("total_orders"), rounded(exact_sum(F.col("sales"))).alias("total_sales"))
    )
    returned = (
        mart.returns()
        .where("vendor_id is not null")
        .groupBy("vendor_id")
        .agg(
            F.countDistinct("order_id").alias("return_order_count"),
            rounded(exact_sum(F.col("refund_amount"))).alias("total_refunded"),
        )
    )
    names = mart.dim_vendors.select("vendor_id", "vendor_name")
    orders = F.coalesce("return_order_count", F.lit(0))
    return (
        sold.join(names, "vendor_id")
        .join(returned, "vendor_id", "left")
        .select(
            "vendor_id",
            "vendor_name",
            "total_orders",
            "total_sales",
            orders.alias("return_order_count"),
            F.coalesce("total_refunded", F.lit(0.0)).alias("total_refunded"),
            percentage(orders, F.col("total_orders")).alias("return_rate_pct"),
        )
    )


def product_region_sales(mart: Mart) -> DataFrame:
    """Summed by product key and region; product names join the result, not the lines."""
    sums = (
        mart.sales(customer=["region"], measures=["product_id", "sales", "quantity", "profit"])
        .where("region is not null")
        .groupBy("product_id", "region")
        .agg(
            rounded(exact_sum(F.col("sales"))).alias("total_sales"),
            _whole(F.col("quantity")).alias("total_quantity"),
            F.countDistinct("order_id").alias("order_count"),
            rounded(exact_sum(F.col("profit"))).alias("total_profit"),
        )
    )
    names = mart.dim_products.select("product_id", "product_name", "brand")
    return sums.join(names, "product_id").select(
        "product_id", "product_name", "brand", "region", "total_sales", "total_quantity", "order_count", "total_profit"
    )


def mv_slow_moving_products(mart: Mart) -> DataFrame:
    """Products whose percent rank by quantity within their region is at most a quarter.

    With n products, percent rank <= p holds exactly up to the quantity at position floor((n - 1) * p), so
    one threshold per region replaces a window over all products of a region.
    """
    rows = stage(product_region_sales(mart), "product_region_sales")
    quantities = rows.select(F.col("region").alias("grp"), F.col("total_quantity").alias("v"))
    limits = positions(quantities, fv.SLOW_MOVING_SHARE)
    slow = F.lit(False)
    for region, limit in limits.items():
        slow = F.when(F.col("region") == region, F.col("total_quantity") <= limit.lower).otherwise(slow)
    return rows.withColumn("is_slow_moving", slow)


def mv_customer_return_history(mart: Mart) -> DataFrame:
    """Summed per customer and reason first: the reasons are distinct then, and a busy customer is small."""
    by_reason = (
        mart.returns(customer=["customer_sk"])
        .where("customer_sk is not null")
        .groupBy("customer_id", "return_reason")
        .agg(
            F.count("*").alias("returns"),
            exact_sum(F.col("refund_amount")).alias("refund"),
            F.count("refund_amount").alias("refunds"),
            F.count_if(F.col("return_status") == "Approved").alias("approved"),
            F.min("return_date").alias("first_return_date"),
            F.max("return_date").alias("last_return_date"),
        )
    )
    history = by_reason.groupBy("customer_id").agg(
        F.sum("returns").alias("total_returns"),
        rounded(F.sum("refund")).alias("total_refund_value"),
        rounded_ratio(F.sum("refund"), F.sum("refunds")).alias("avg_refund_per_return"),
        F.count("return_reason").alias("distinct_reason_count"),
        F.expr("listagg(return_reason, ', ') within group (order by return_reason)").alias("return_reasons"),
        F.sum("approved").alias("approved_count"),
        percentage(F.sum("approved"), F.sum("returns")).alias("approval_rate_pct"),
        F.min("first_return_date").alias("first_return_date"),
        F.max("last_return_date").alias("last_return_date"),
    )
    names = mart.dim_customers.select("customer_id", "customer_name", "segment", "region")
    return history.join(names, "customer_id").select(
        "customer_id", "customer_name", "segment", "region", *[c for c in history.columns if c != "customer_id"]
    )


def mv_return_reason_analysis(mart: Mart) -> DataFrame:
    rows = mart.returns(customer=["region"]).where("region is not null")
    return rows.groupBy("return_reason", "region").agg(
        F.count("*").alias("return_count"),
        rounded(exact_sum(F.col("refund_amount"))).alias("total_refunded"),
        _mean("refund_amount").alias("avg_refund"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.count_if(F.col("return_status") == "Approved").alias("approved_count"),
        F.count_if(F.col("return_status") == "Rejected").alias("rejected_count"),
    )


def mv_product_return_impact(mart: Mart) -> DataFrame:
    """Summed by the product's id where it is known to have its key, which is a hash of it; by the key of stored rows."""
    regions = mart.order_products(["region"]).where("region is not null")
    keys = [c for c in regions.columns if c != "region"]
    product = "product_sk" if mart.has_stored("bridge_return_products") else "product_id"
    sums = (
        mart.bridge_return_products.where("product_sk is not null")
        .select(*dict.fromkeys([*keys, product, "allocated_refund", "allocation_weight"]))
        .join(regions, keys)
        .groupBy(product, "region")
        .agg(
            F.count("*").alias("return_line_count"),
            rounded(exact_sum(F.col("allocated_refund"))).alias("total_return_cost"),
            _mean("allocated_refund").alias("avg_return_cost"),
            rounded(exact_sum(F.col("allocation_weight")), 4).alias("total_allocation_weight"),
        )
    )
    names = mart.dim_products.select("product_sk", "product_id", "product_name", "brand")
    return sums.join(names, product).select(
        "product_id", "product_name", "brand", "region",
        "return_line_count", "total_return_cost", "avg_return_cost", "total_allocation_weight",
    )


def vendor_product_returns(mart: Mart) -> DataFrame:
    """Returns and refunds per vendor and product: each returned product of an order counts for all its vendors.

    Orders with the same vendors are summed per product before products meet vendors, so that pairs are made once for
    a set of vendors and not for each order. A set is known by the number of its vendors and two sums of their
    hashes, 128 bits together, and named after the first order that has it.
    """
    products = mart.bridge_return_products.select("order_id", "product_id", "allocated_refund")
    vendors = mart.sales(measures=["vendor_id"]).where("vendor_id is not null")
    returned = mart.returns().select("order_id")
    vendors = stage(vendors.join(returned, "order_id", "left_semi").distinct(), "order_vendors")
    of_order = vendors.groupBy("order_id").agg(
        F.count("*").alias("vendors"),
        F.bit_xor(F.xxhash64("vendor_id")).alias("mixed"),
        F.sum(F.xxhash64("vendor_id", F.lit(1)).cast("decimal(38,0)")).alias("total"),
    )
    sets = of_order.groupBy("vendors", "mixed", "total").agg(F.min("order_id").alias("set_id"))
    named = of_order.join(sets, ["vendors", "mixed", "total"]).select("order_id", "set_id")
    sums = products.join(named, "order_id").groupBy("set_id", "product_id").agg(
        F.count("*").alias("return_count"), exact_sum(F.col("allocated_refund")).alias("refund")
    )
    sums = stage(sums, "set_refunds")
    members = vendors.join(sets.select(F.col("set_id").alias("order_id")), "order_id", "left_semi")
    pairs = sums.join(members.withColumnRenamed("order_id", "set_id"), "set_id")
    return pairs.groupBy("vendor_id", "product_id").agg(
        F.sum("return_count").alias("return_count"), F.sum("refund").alias("total_allocated_refund")
    )


def mv_vendor_product_performance(mart: Mart) -> DataFrame:
    """Sales per vendor, product and region; a vendor's returns of a product repeat on each region row.

    Sales and returns are summed by queries of their own, so that what one has shuffled is gone when the other runs.
    """
    mart.hold("transactions", "orders", "returns")
    sold = (
        mart.sales(customer=["region"], measures=["vendor_id", "product_id", "sales", "quantity", "profit"])
        .where("region is not null and vendor_id is not null")
        .groupBy("vendor_id", "product_id", "region")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            rounded(exact_sum(F.col("sales"))).alias("total_sales"),
            _whole(F.col("quantity")).alias("total_quantity"),
            rounded(exact_sum(F.col("profit"))).alias("total_profit"),
        )
    )
    sold = stage(sold, "vendor_product_sales")
    returned = vendor_product_returns(mart)
    returned = stage(
        returned.withColumn("total_allocated_refund", rounded(F.col("total_allocated_refund"))), "vendor_product_returns"
    )
    vendors = mart.dim_vendors.select("vendor_id", "vendor_name")
    products = mart.dim_products.select("product_id", "product_name", "brand")
    return (
        sold.join(returned, ["vendor_id", "product_id"], "left")
        .join(vendors, "vendor_id")
        .join(products, "product_id")
        .select(
            "vendor_id", "vendor_name", "product_id", "product_name", "brand", "region",
            "order_count", "total_sales", "total_quantity", "total_profit",
            F.coalesce("return_count", F.lit(0)).alias("return_count"),
            F.coalesce("total_allocated_refund", F.lit(0.0)).alias("total_allocated_refund"),
        )
    )


METRICS = {
    "mv_revenue_by_region": mv_revenue_by_region,
    "mv_return_rate_by_vendor": mv_return_rate_by_vendor,
    "mv_slow_moving_products": mv_slow_moving_products,
    "mv_monthly_revenue_by_region": mv_monthly_revenue_by_region,
    "mv_segment_profitability": mv_segment_profitability,
    "mv_customer_return_history": mv_customer_return_history,
    "mv_return_reason_analysis": mv_return_reason_analysis,
    "mv_product_return_impact": mv_product_return_impact,
    "mv_vendor_product_performance": mv_vendor_product_performance,
}
