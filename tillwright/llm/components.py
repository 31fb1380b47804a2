"""Connected components of an undirected graph, by alternating large and small stars.

Every step joins edges with the least neighbour of their ends, so that no list of neighbours is ever built; the
result of each round is written, and the number of rounds grows with the logarithm of the largest component.

Defined results: repeated edges and edges from a node to itself change nothing; a node without edges is in no result;
a table without edges gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stage


def _least(edges: DataFrame, near: Column) -> DataFrame:
    """For each u the least of itself and its neighbours v that `near` takes."""
    return edges.where(near).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _star(edges: DataFrame, own: Column, near: Column, keep: Column, itself: bool) -> DataFrame:
    """Edges from the neighbours that `keep` takes to the least neighbour of their node."""
    least = _least(edges, near)
    joined = edges.where(own).join(least, "u").where(keep)
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if itself:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all nodes of (a, b) edges; the component is the least id in it."""
    everything = F.lit(True)
    now = stage(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, everything, everything, F.col("v") > F.col("u"), itself=False)
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = stage(_star(down, everything, everything, F.col("v") != F.col("m"), itself=True), "edges")
    # every component is a star around its least node
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
