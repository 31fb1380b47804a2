"""Exact order statistics of large groups.

A rank over a whole group would sort the group in one task. Here a quantile sketch proposes a narrow value
bracket, the values inside it are counted exactly, and the counts prove whether the wanted position lies in
the bracket; if not, the bracket is widened. The bracket's distinct values are dealt out by ranges; sums per range
tell which one holds the position, and only there counts are added up value by value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import stage


@dataclass(frozen=True)
class Position:
    """The two neighbours of the (n - 1) * p position of a sorted group, and the share between them."""

    count: int
    lower: float
    upper: float
    share: float

    @property
    def interpolated(self) -> float:
        return self.lower + (self.upper - self.lower) * self.share


def _by_group(values: dict[str, float]) -> Column:
    entries = [F.lit(part) for key, value in values.items() for part in (key, value)]
    return F.create_map(*entries)[F.col("grp")]


def positions(values: DataFrame, p: float, accuracy: int = 10_000) -> dict[str, Position]:
    """``values`` has columns grp (a handful of labels) and v; NULL values are left out."""
    rows = values.select("grp", F.col("v").cast("double").alias("v")).where("v is not null")
    found: dict[str, Position] = {}
    margin = 2.0 / accuracy
    counts: dict[str, int] = {}
    while True:
        bounds = [max(0.0, p - margin), min(1.0, p + margin)]
        sketch = rows.groupBy("grp").agg(
            F.count("*").alias("n"), F.percentile_approx("v", bounds, accuracy).alias("bracket")
        )
        sketched = {r["grp"]: r for r in sketch.collect() if r["grp"] not in found}
        counts = {g: r["n"] for g, r in sketched.items()}
        if not sketched:
            return found
        whole = margin >= 1.0
        low = {g: float("-inf") if whole else r["bracket"][0] for g, r in sketched.items()}
        high = {g: float("inf") if whole else r["bracket"][1] for g, r in sketched.items()}
        found.update(_count_in_brackets(rows, p, counts, low, high))
        margin *= 16


def _count_in_brackets(
    rows: DataFrame, p: float, counts: dict[str, int], low: dict[str, float], high: dict[str, float]
) -> dict[str, Position]:
    below_and_inside = rows.where(F.col("grp").isin(*counts) & (F.col("v") <= _by_group(high))).select(
        "grp", F.when(F.col("v") >= _by_group(low), F.col("v")).alias("v")
    )
    histogram = below_and_inside.groupBy("grp", "v").agg(F.count("*").alias("n"))
    ranged = histogram.repartitionByRange("grp", F.col("v").asc_nulls_first())
    ranged = stage(ranged.withColumn("part", F.spark_partition_id()), "value_counts")
    # a row per range and group; NULL stands for what is below the bracket
    below = F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("below")
    parts = ranged.groupBy("grp", "part").agg(F.sum("n").alias("n"), below).orderBy("grp", "part").collect()
    wanted: list[tuple[str, int, int, int]] = []  # group, range, rows before the range, position in the group
    proven = {g: ((n - 1) * p, min(int((n - 1) * p) + 1, n - 1)) for g, n in counts.items()}
    for group, (at, last) in list(proven.items()):
        own = [part for part in parts if part["grp"] == group]
        if sum(part["below"] for part in own) > int(at) or sum(part["n"] for part in own) <= last:
            del proven[group]
            continue
        before = 0
        for part in own:
            wanted += [(group, part["part"], before, i) for i in (int(at), last) if before <= i < before + part["n"]]
            before += part["n"]
    if not wanted:
        return {}
    running = F.sum("n").over(Window.partitionBy("grp", "part").orderBy(F.col("v").asc_nulls_first()))
    chosen = [(F.col("grp") == group) & (F.col("part") == part) for group, part, _, _ in wanted]
    counted = ranged.where(reduce(Column.__or__, chosen)).withColumn("upto", running)
    found = [
        F.min(F.when(where & (F.col("upto") + before > i), F.col("v"))).alias(f"v{k}")
        for k, (where, (_, _, before, i)) in enumerate(zip(chosen, wanted))
    ]
    values = counted.agg(*found).first()
    at_position = {(group, i): values[k] for k, (group, _, _, i) in enumerate(wanted)}
    return {
        group: Position(counts[group], at_position[group, int(at)], at_position[group, last], at - int(at))
        for group, (at, last) in proven.items()
    }
