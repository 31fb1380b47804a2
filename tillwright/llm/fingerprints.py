"""Document fingerprints: MinHash signatures, the successor's edits, and near copies by banded signatures.

Shingles of five words are hashed, and HASHES universal hash functions permute the hashes in numpy; the signature
keeps the least value of each. The fingerprint writes the last 16 bits of every value in hex, and the likeness of two
fingerprints is the share of equal values, which estimates the Jaccard similarity of the shingle sets.

Near copies: texts with equal shingle sets are taken once, bands of signature values are joined in Spark, and the sets
of those that share a band are compared exactly (linkage.py), so that a class holds no pair by chance.

The edited text of a document takes its second half from the start of the next document, by doc_id. Documents are
dealt by ranges of doc_id and sorted; the first document of a range is also sent to the range before, so that the
order of all documents never meets in one place and every text moves once.

Defined results: a null text is an empty one; a text with fewer than five words has its whole sequence as its only
shingle; the fingerprint of a text without words is all ones and like that of another such text only; a null doc_id
comes before all others, rows of one doc_id are in the order of their texts, equal rows in any; a single document is
its own next one; a table without documents gives none. A task holds a few megabytes of texts, or one longer text, and
some 20 bytes for each of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import jaccard, linkage
from tillwright.llm import text as T
from tillwright.llm.linkage import Rule
from tillwright.session import stage

SHINGLE = 5
HASHES = 128
RULE = Rule(size=SHINGLE, percent=80)
# Values in a band: two sets of similarity 0.8 share at least one of the 32 bands but for 5 of 100 million cases.
BAND = 4

_rng = np.random.default_rng(20_011)
_FACTORS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_TERMS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_EMPTY = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
# Shingles permuted at once, so that the values stay in the processor's cache.
_AT_ONCE = 1 << 14


def signatures(texts) -> np.ndarray:
    """The least value of each permutation over the shingles of each text, as rows."""
    out = []
    for _, data, offsets in T.slices(texts):
        hashes, bounds = T.shingles(T.split_words(data, offsets, T.SPACED), SHINGLE)
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        rows = np.tile(_EMPTY, (len(bounds) - 1, 1))
        for t in range(len(bounds) - 1):
            for a in range(bounds[t], bounds[t + 1], _AT_ONCE):
                own = low[a : min(a + _AT_ONCE, bounds[t + 1])]
                least = (own[None, :] * _FACTORS[:, None] + _TERMS[:, None]).min(axis=1)
                np.minimum(rows[t], least, out=rows[t])
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, HASHES), dtype=np.uint32)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values; an empty text is like an empty one only."""
    return float((a == b).mean())


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a hex string."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([written(s) for s in signatures(texts)], pa.string())

    return of(text)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as many code points of the next one, or by all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


REPORT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _dealt(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, text, bucket, borrowed): every document in its range, and the first of each in the range before."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    cuts: list = []
    if ranges > 1:
        numeric = dict(docs.dtypes)["doc_id"] not in ("string", "binary")
        if not numeric:
            raise TypeError("doc_id must be a number")
        found = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
        cuts = sorted(set(found or ()))
    bounds = spark.sparkContext.broadcast(np.array(cuts))

    @F.arrow_udf("int")
    def bucket(own: pa.Array) -> pa.Array:
        known = own.is_valid().to_numpy(zero_copy_only=False)
        values = own.fill_null(0).to_numpy(zero_copy_only=False)
        places = np.searchsorted(bounds.value, values, side="right") if len(bounds.value) else np.zeros(len(own))
        return pa.array(np.where(known, places, 0).astype(np.int32))

    # one row per range: bounded by the number of ranges
    heads = docs.select("doc_id", bucket("doc_id").alias("bucket")).groupBy("bucket").agg(
        F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")
    ).orderBy("bucket").collect()
    used = [r["bucket"] for r in heads]
    before = {b: used[i - 1] for i, b in enumerate(used)}
    first = {r["bucket"]: None if r["nulls"] else r["first"] for r in heads}
    lend = spark.createDataFrame(
        [(first[b], before[b]) for b in used], f"head {docs.schema['doc_id'].dataType.simpleString()}, to int"
    )
    own = docs.select("doc_id", "text", bucket("doc_id").alias("bucket"), F.lit(False).alias("borrowed"))
    lent = docs.join(F.broadcast(lend), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", F.col("to").alias("bucket"), F.lit(True).alias("borrowed")
    )
    return own.unionByName(lent)


def _with_next(kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (bucket, borrowed, doc_id, text); each own row is reported with the row after it."""

    def report(ids: list, texts: list[str], after: list[str]) -> pa.RecordBatch:
        whole = signatures(pa.array([*texts, after[-1]], pa.large_string()))
        changed = [edited(a, b) for a, b in zip(texts, after)]
        # the signature of the next text is the next row's, unless the next range lent it
        other = signatures(pa.array(changed, pa.large_string()))
        columns = [
            pa.array(ids, kind),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([written(s) for s in whole[:-1]], pa.string()),
            pa.array([written(s) for s in other], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(whole, other)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(whole[:-1], whole[1:])], pa.float64()),
        ]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, bucket, closed, size = [], [], None, False, 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "borrowed")))
            for doc_id, text, own_bucket, borrowed in rows:
                if own_bucket != bucket:
                    ids, texts, bucket, closed, size = [], [], own_bucket, False, 0
                if closed:
                    continue
                if borrowed:
                    yield report(ids, texts, [*texts[1:], text])
                    ids, texts, closed, size = [], [], True, 0
                    continue
                if size > 4 * T.SLICE_BYTES:  # all but the last, whose next row is this one
                    yield report(ids, texts, [*texts[1:], text])
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)

    return run


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each document."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(docs, ranges).repartition("bucket").sortWithinPartitions("bucket", "borrowed", "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
    return dealt.mapInArrow(_with_next(arrow), f"doc_id {kind}, {REPORT}")


SETS = "doc_id {kind}, id bigint, n int, sketch binary, bands array<bigint>"


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, sketches, bands = [], [], [], []
        found = signatures(batch.column("text"))
        for own, signature in zip(RULE.sets(batch.column("text")), found):
            some = len(own) > 0
            ids.append(linkage.set_id(own) if some else None)
            sizes.append(len(own))
            sketches.append(linkage.sketch(own) if some else None)
            parts = signature.astype(np.uint64).reshape(-1, BAND)
            mixed = np.arange(len(parts), dtype=np.uint64)
            for j in range(BAND):
                mixed = T.mix(mixed * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
            bands.append(mixed.view(np.int64) if some else None)
        columns = [batch.column("doc_id"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32())]
        columns += [pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "n", "sketch", "bands"])


def near_copies(docs: DataFrame, region_rows: int = linkage.REGION_ROWS) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of the texts linked to it by similarities of at least 0.8.

    A text without words, and one without near copies, is alone: its class is its own id.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    every = stage(docs.mapInArrow(_banded, SETS.format(kind=kind)), "signatures")
    filled = every.where(F.col("id").isNotNull())
    owners = stage(filled.groupBy("id").agg(F.min("doc_id").alias("doc_id")), "owners")
    unique = stage(filled.select("id", "n", "sketch", "bands").dropDuplicates(["id"]), "unique_signatures")
    placed = unique.select("id", "n", F.lit(0).alias("pos"), F.explode("bands").alias("region"))
    shared = placed.groupBy("region").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("region")
    regions = placed.join(shared, "region").join(unique.select("id", "sketch"), "id")
    _, found = linkage.links(regions, jaccard.texts_of(docs, owners, RULE), RULE, region_rows)
    named = owners.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    of_set = named.select("id", "component").join(least, "component").select("id", "class_id")
    result = every.select("doc_id", "id").join(of_set, "id", "left")
    return result.select("doc_id", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
