"""Exact money arithmetic: decimal sums do not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"
RATIO = "decimal(38,6)"


def exact(col: Column) -> Column:
    return col.cast(EXACT)


def exact_sum(col: Column) -> Column:
    return F.sum(exact(col))


def rounded(col: Column, places: int = 2) -> Column:
    """Round an exact decimal and hand it out as double."""
    return F.round(col, places).cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """Unrounded double quotient, NULL for a zero divisor."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def rounded_ratio(top: Column, bottom: Column, places: int = 2) -> Column:
    return rounded(ratio(top, bottom).cast(RATIO), places)


def percentage(top: Column, bottom: Column) -> Column:
    return rounded_ratio(top.cast("double") * F.lit(100.0), bottom)


def money_text(col: Column) -> Column:
    return col.cast("decimal(38,2)").cast("string")
