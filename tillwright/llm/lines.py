"""Line dedup: repeated multi-line chunks, cut where rolling hashes of the lines say so.

A rolling hash over ROLLED line hashes chooses boundaries, at least LEAST_LINES lines apart, so that the same lines
are cut alike wherever they stand, whatever precedes them. A chunk that occurs more than once anywhere is kept where
it occurs first (smallest doc_id, then position) and removed elsewhere. Chunks are grouped by their digest and the
bytes of a group compared; chunks of one digest with unlike bytes are grouped by the bytes themselves.

Lines end at "\\n". Chunks of fewer than LEAST_LINES lines and chunks of white space only always stay.

Defined results: a null text is an empty one, with one empty line; a text whose chunks are all copies becomes empty;
rows that agree in doc_id, position and chunk count as one occurrence, so that repeated rows keep the same lines; a
null doc_id comes before all others.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stage

ROLLED = 2
LEAST_LINES = 2
# One in so many places is a boundary.
DIVISOR = 2
# Parameters of the rolling hash; a change cuts all texts anew.
MULTIPLIER, MODULUS = 1_000_003, (1 << 31) - 1

CHUNK = "array<struct<pos: int, digest: string, chunk: string>>"
KEPT = "struct<text: string, n_lines: bigint, n_removed: bigint>"


def line_hash(line: str) -> int:
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def boundaries(lines: list[str]) -> list[int]:
    """The first line of each chunk."""
    out, rolled, leaving = [0], 0, pow(MULTIPLIER, ROLLED, MODULUS)
    hashes = [line_hash(line) for line in lines]
    for i, own in enumerate(hashes):
        rolled = (rolled * MULTIPLIER + own) % MODULUS
        if i >= ROLLED:
            rolled = (rolled - hashes[i - ROLLED] * leaving) % MODULUS
        if i + 1 >= ROLLED and rolled % DIVISOR == 0 and i - out[-1] >= LEAST_LINES:
            out.append(i)
    return out


def chunks(text: str | None) -> list[tuple[int, int, str]]:
    """(first line, number of lines, text) of each chunk."""
    lines = (text or "").split("\n")
    cuts = boundaries(lines)
    return [(a, b - a, "\n".join(lines[a:b])) for a, b in zip(cuts, [*cuts[1:], len(lines)])]


def _digest(chunk: str) -> str:
    return hashlib.md5(chunk.encode()).hexdigest()


def _candidates(text: str | None) -> list[dict]:
    """The chunks that may be removed."""
    return [
        {"pos": pos, "digest": _digest(chunk), "chunk": chunk}
        for pos, n, chunk in chunks(text)
        if n >= LEAST_LINES and chunk.strip(" \n")
    ]


def candidates(text: Column) -> Column:
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("digest", pa.string()), ("chunk", pa.string())]))

    @F.arrow_udf(CHUNK)
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array((_candidates(t.as_py()) for t in texts), kind, size=len(texts))

    return cut(text)


def without(text: Column, gone: Column) -> Column:
    """The text without the chunks that `gone` lists as (pos, digest)."""
    kind = pa.struct([("text", pa.large_string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])

    def one(own: str | None, listed) -> dict:
        if not listed:
            return {"text": own or "", "n_lines": (own or "").count("\n") + 1, "n_removed": 0}
        listed = {(x["pos"], x["digest"]) for x in listed}
        cut = chunks(own)
        keep = [c for c in cut if c[1] < LEAST_LINES or (c[0], _digest(c[2])) not in listed]
        n = sum(c[1] for c in cut)
        return {"text": "\n".join(c[2] for c in keep), "n_lines": n, "n_removed": n - sum(c[1] for c in keep)}

    @F.arrow_udf(KEPT)
    def kept(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = (one(t.as_py(), x.as_py()) for t, x in zip(texts, lists))
        return pa.array(rows, kind, size=len(texts)).cast(
            pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])
        )

    return kept(text, gone)


def removals(docs: DataFrame) -> DataFrame:
    """(id, gone): for each document with later copies of a chunk, their positions and digests."""
    found = docs.select(F.col("doc_id").alias("id"), F.explode(candidates(F.col("text"))).alias("c"))
    found = found.select("id", "c.pos", "c.digest", "c.chunk")
    place = F.struct("id", "pos")

    def first(*keys: str) -> DataFrame:
        return found.groupBy(*keys).agg(
            F.min(place).alias("first"),
            F.max(place).alias("last"),
            (F.min("chunk") == F.max("chunk")).alias("alike"),
        )

    groups = stage(first("digest").where(~F.col("first").eqNullSafe(F.col("last"))), "chunks")
    later = found.join(groups.where("alike"), "digest").where(~place.eqNullSafe(F.col("first")))
    later = later.select("id", "pos", "digest")
    unlike = groups.where("NOT alike").select("digest")
    if not unlike.isEmpty():
        own = found.join(unlike, "digest", "left_semi")
        exact = (
            own.groupBy("digest", "chunk")
            .agg(F.min(place).alias("first"), F.max(place).alias("last"))
            .where(~F.col("first").eqNullSafe(F.col("last")))
        )
        more = own.join(exact, ["digest", "chunk"]).where(~place.eqNullSafe(F.col("first")))
        later = later.unionByName(more.select("id", "pos", "digest"))
    return later.groupBy("id").agg(F.collect_set(F.struct("pos", "digest")).alias("gone"))


def deduplicated(docs: DataFrame, kept: str = "kept") -> DataFrame:
    """The documents with a column of the remaining text, its number of lines before, and how many were removed."""
    gone = removals(docs).select(F.col("id").alias(f"{kept}_id"), F.col("gone").alias(f"{kept}_gone"))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone[f"{kept}_id"]), "left")
    joined = joined.withColumn(kept, without(F.col("text"), F.col(f"{kept}_gone")))
    return joined.drop(f"{kept}_id", f"{kept}_gone")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, n_chars and text_sha256 of each document's remaining text."""
    found = deduplicated(docs.select("doc_id", "text"))
    kept = F.col("kept")
    return found.select(
        "doc_id",
        kept["n_lines"].alias("n_lines"),
        kept["n_removed"].alias("n_removed"),
        F.length(kept["text"]).cast("bigint").alias("n_chars"),
        F.sha2(kept["text"], 256).alias("text_sha256"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents with the remaining texts and their lengths, with their own columns."""
    name = "_kept"
    while any(c.startswith(name) for c in docs.columns):
        name += "_"
    found = deduplicated(docs, name)
    text = F.col(f"{name}.text")
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
