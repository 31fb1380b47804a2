"""Dimensions: one row per business key, with a hashed surrogate key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.keys import surrogate_key


def customers(clean: DataFrame) -> DataFrame:
    """The newest record of each customer, one with an email first; further columns only settle ties.

    A max over structs is combined before the shuffle, so copies of one customer never meet in one task.
    """
    attributes = ("customer_name", "customer_email", "segment", "city", "state", "region")
    newest = F.max(
        F.struct("_load_timestamp", F.col("customer_email").isNotNull().alias("reachable"), "_source_file", *attributes)
    )
    return (
        clean.groupBy("customer_id")
        .agg(newest.alias("newest"))
        .select(surrogate_key("customer_id").alias("customer_sk"), "customer_id", *[f"newest.{c}" for c in attributes])
    )


def products(clean: DataFrame) -> DataFrame:
    attributes = ("product_name", "brand", "category", "sub_category", "upc")
    merged = clean.where("product_id is not null").groupBy("product_id").agg(*[F.max(c).alias(c) for c in attributes])
    return merged.select(surrogate_key("product_id").alias("product_sk"), "product_id", *attributes)


def vendors(clean: DataFrame) -> DataFrame:
    merged = clean.where("vendor_id is not null").groupBy("vendor_id").agg(F.max("vendor_name").alias("vendor_name"))
    return merged.select(surrogate_key("vendor_id").alias("vendor_sk"), "vendor_id", "vendor_name")


def _span(df: DataFrame, column: str) -> DataFrame:
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("first"), F.max(day).alias("last"))


def dates(clean_orders: DataFrame, clean_returns: DataFrame) -> DataFrame:
    """Every day from January 1st of the first year to January 1st after the last.

    Years are generated first and days within each of them, so that no list is longer than a year, or than the
    years a date can hold.
    """
    span = (
        _span(clean_orders, "order_purchase_date")
        .unionByName(_span(clean_returns, "return_date"))
        .agg(F.trunc(F.min("first"), "YEAR").alias("first"), F.trunc(F.max("last"), "YEAR").alias("last"))
    )
    years = span.where("first is not null").select(
        F.add_months("last", 12).alias("end"),
        F.explode(F.sequence(F.year("first"), F.year("last") + 1)).alias("in_year"),
    )
    first, last = (F.make_date("in_year", F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    days = years.select("end", F.explode(F.sequence(first, last)).alias("date_key")).where("date_key <= end")
    return days.select(*[value.alias(name) for name, value in date_attributes("date_key").items()])


def date_attributes(day: str) -> dict[str, Column]:
    """The calendar's columns for a date, which are functions of it; NULL for no date."""
    weekday = F.dayofweek(day) - 1
    return {
        "date_sk": F.when(F.col(day).isNotNull(), surrogate_key(day)),
        "date_key": F.col(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.monthname(day),
        "day": F.day(day),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(0, 6),
    }
