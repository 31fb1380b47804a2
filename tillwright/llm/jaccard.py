"""N-gram Jaccard join: components of documents whose sets of word shingles are alike, in the Jaccard metric.

Documents are joined in a metric space (linkage.py): pivots make Voronoi regions, windows from the triangle inequality
send boundary documents to more than one region, and regions are joined recursively. In the Jaccard metric nearly all
documents are at the largest distance from any document, where no window parts them; the first pivots are therefore
sets of a single shingle. A document belongs to the regions of the shingles that come first in one global order: two
linked documents share one of each other's first n - ceil(percent * n / 100) + 1 shingles, so that no link is lost.
The order is rarest first, as told by a table of counts over all documents with a fixed number of entries; an inexact
count makes regions larger, never wrong.

Defined results: a null text is an empty one; a text without words has no shingles and is linked with nothing; texts
with equal sets are linked; a document whose component has only null ids has a null component; repeated rows give
repeated results. Memory of a task is a multiple of its longest text, for the shingles of that text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm import linkage
from tillwright.llm.linkage import Rule
from tillwright.session import stage

RULE = Rule(size=4, percent=85)
# Entries of the table of counts.
CROWD = 1 << 17


def _crowd(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CROWD, dtype=np.int64)
        for batch in batches:
            for own in rule.sets(batch.column("text")):
                np.add.at(counts, (own & np.uint64(CROWD - 1)).astype(np.int64), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["entry", "times"])

    return run


def crowd(docs: DataFrame, rule: Rule) -> np.ndarray:
    """How many documents have a shingle of each entry of the table."""
    counted = docs.select("text").mapInArrow(_crowd(rule), "entry int, times bigint")
    rows = counted.groupBy("entry").agg(F.sum("times").alias("times")).toPandas()  # at most CROWD rows
    out = np.zeros(CROWD, dtype=np.int64)
    out[rows["entry"].to_numpy(dtype=np.int64)] = rows["times"].to_numpy(dtype=np.int64)
    return out


def prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set of which linked sets share one, the rarest first."""
    n = len(own)
    length = n - -(-percent * n // 100) + 1
    return own[np.lexsort((own, counts[(own & np.uint64(CROWD - 1)).astype(np.int64)]))[:length]]


SETS = "doc_id {kind}, version bigint, id bigint, n int, first array<bigint>, sketch binary"


def _sets(rule: Rule, counts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, firsts, sketches = [], [], [], []
            for own in rule.sets(batch.column("text")):
                some = len(own) > 0
                ids.append(linkage.set_id(own) if some else None)
                sizes.append(len(own))
                firsts.append(prefix(own, counts.value, rule.percent).view(np.int64) if some else None)
                sketches.append(linkage.sketch(own) if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("version"),
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(firsts, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "version", "id", "n", "first", "sketch"],
            )

    return run


def regions(sets: DataFrame) -> DataFrame:
    """Members (region, id, n, pos, sketch) of the single-shingle regions of at least two sets."""
    placed = sets.select("id", "n", F.posexplode("first").alias("pos", "region"))
    shared = placed.groupBy("region").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("region")
    together = placed.join(shared, "region")
    return together.join(sets.select("id", "sketch"), "id")


def texts_of(docs: DataFrame, owners: DataFrame, rule: Rule) -> Callable[[DataFrame], DataFrame]:
    """The text of one document for each set; owners: (id, doc_id)."""

    def run(ids: DataFrame) -> DataFrame:
        wanted = ids.join(owners, "id").withColumnRenamed("doc_id", "owner")
        found = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("owner")))
        return found.select("id", "text").mapInArrow(same, "id bigint, text string").dropDuplicates(["id"])

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only rows whose text has the set, as several rows may have one doc_id."""
        for batch in batches:
            own = [len(s) > 0 and linkage.set_id(s) == i for s, i in zip(rule.sets(batch["text"]), batch["id"].to_pylist())]
            yield batch.select(["id", "text"]).filter(pa.array(own, pa.bool_()))

    return run


def _classed(docs: DataFrame, rule: Rule, region_rows: int) -> DataFrame:
    """doc_id, version (a hash of the text), n, component (its least set; null without words), component_id."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = spark.sparkContext.broadcast(crowd(docs, rule))
    schema = SETS.format(kind=docs.schema["doc_id"].dataType.simpleString())
    hashed = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    every = stage(hashed.mapInArrow(_sets(rule, counts), schema), "sets")
    filled = every.where(F.col("id").isNotNull())
    owners = stage(filled.groupBy("id").agg(F.min("doc_id").alias("doc_id")), "owners")
    unique = filled.select("id", "n", "first", "sketch").dropDuplicates(["id"])
    _, found = linkage.links(regions(stage(unique, "unique_sets")), texts_of(docs, owners, rule), rule, region_rows)
    named = owners.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = named.select("id", "component").join(least, "component").select("id", "component", "component_id")
    # a set may be that of a third of all documents: the join is split where it is
    result = every.select("doc_id", "version", "id", "n").join(of_set, "id", "left")
    own = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "version", "n", "component", own.alias("component_id"))


def classes(docs: DataFrame, rule: Rule = RULE, region_rows: int = linkage.REGION_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    found = _classed(docs, rule, region_rows)
    return found.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")


def distinct(docs: DataFrame, rule: Rule = RULE, region_rows: int = linkage.REGION_ROWS) -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest id, of several texts with that
    id the one with the smallest hash, of equal rows any. Documents without words all stay."""
    found = stage(_classed(docs, rule, region_rows), "classed").where(F.col("component").isNotNull())
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    chosen = found.where(first).groupBy("component").agg(F.min("version").alias("chosen"))
    judged = found.join(chosen, "component").withColumn("stays", first & (F.col("version") == F.col("chosen")))
    taken = ("_id", "_version")
    while any(c in docs.columns for c in taken):
        taken = tuple(c + "_" for c in taken)
    keys = [F.col("doc_id").alias(taken[0]), F.col("version").alias(taken[1])]
    same = F.col("doc_id").eqNullSafe(F.col(taken[0])) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(taken[1])
    )
    gone = judged.where("NOT stays").select(*keys).distinct()
    kept = docs.join(gone, same, "left_anti")
    repeated = judged.where("stays").groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeated = stage(repeated.select(*keys), "repeated")
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(one)
