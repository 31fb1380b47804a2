"""The first k rows of every group, without bringing a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, spread: int = 64) -> DataFrame:
    """Rank within parts of each group first; at most ``spread * k`` rows per group go further.

    A part holds whole tasks, so that a task hands on at most k rows of a group.

    ``order`` must tell rows apart for a repeatable result. NULLs come last.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order]
    parts = df.withColumn("_part", F.spark_partition_id() % spread)
    by_part = Window.partitionBy(*group, "_part").orderBy(*ordering)
    kept = parts.withColumn("_rank", F.row_number().over(by_part)).where(F.col("_rank") <= k)
    by_group = Window.partitionBy(*group).orderBy(*ordering)
    return kept.withColumn("_rank", F.row_number().over(by_group)).where(F.col("_rank") <= k).drop("_part")
