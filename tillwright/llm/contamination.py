"""Benchmark decontamination: Wu-Manber search of benchmark windows in whole texts.

A window is 10 consecutive words of an item; an item with fewer words, but not none, is one window of its own length.
For each window length, a shift table over hashed blocks of two words says how far a search may skip from a position,
buckets of the last block hold the windows that may end where the shift is 0, and a direct comparison of the words
confirms them. Segments of many texts are searched side by side in numpy.

Items are cut into pieces of bounded length and searched in blocks of bounded size, one pass over the documents for
each block; what the passes find is joined per row, without a shuffle.

Defined results: a null text has no words, a document without words has no hits; an item without id, without text or
without words is left out; equal items all count; repeated rows give repeated results; an empty benchmark finds
nothing. A task holds a few megabytes of texts, or one longer text, and some 50 bytes for each of its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import text as T
from tillwright.session import stage

WINDOW = 10
BLOCK_WORDS = 2
PIECE_WORDS = 2000
# A block's windows take some 50 times its bytes in memory.
BLOCK_BYTES = 2 << 20
SEGMENT = 256

FOUND = "struct<n_words: bigint, runs: array<int>, items: array<string>>"


class Searcher:
    """Wu-Manber tables for windows of one length; windows: the words of each distinct window, as bytes."""

    def __init__(self, length: int, hashes: np.ndarray, words: list[bytes], items: list[list[str]]):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        blocks = self._blocks(hashes.ravel()).reshape(-1)
        n = len(hashes)
        # about four entries for each different block, as neighbouring windows share theirs
        bits = max(10, int(4 * (n + length)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shifts = np.full(1 << bits, length - self.block + 1, dtype=np.uint8)
        for j in range(self.block - 1, length):  # j: the last word of a block within the window
            at = blocks[np.arange(n) * length + j] & self.mask
            np.minimum.at(self.shifts, at, length - 1 - j)
        suffix = blocks[np.arange(n) * length + length - 1]
        order = np.argsort(suffix, kind="stable")
        self.suffixes, self.hashes = suffix[order], hashes[order]
        self.words = [words[i] for i in order]
        self.items = [items[i] for i in order]

    def _blocks(self, hashes: np.ndarray) -> np.ndarray:
        """For each word, a hash of the block that ends with it; the first words of a text are never asked for."""
        out = hashes.copy()
        for back in range(1, self.block):
            out[back:] = out[back:] * np.uint64(0x9FB21C651E98DF25) + hashes[:-back]
        return T.mix(out)

    def positions(self, words: T.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(last word, window) of each occurrence, as far as hashes tell."""
        first = words.bounds[:-1] + self.length - 1
        number = np.maximum(0, words.bounds[1:] - first)
        pieces = -(-number // SEGMENT)
        if not pieces.sum():
            return
        text = np.repeat(np.arange(len(number)), pieces)
        part = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = first[text] + part * SEGMENT
        end = np.minimum(at + SEGMENT, words.bounds[1:][text])
        blocks = self._blocks(words.hashes)
        stops = []
        while len(at):
            skip = self.shifts[blocks[at] & self.mask].astype(np.int64)
            stops.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            inside = at < end
            at, end = at[inside], end[inside]
        stop = np.concatenate(stops)
        low = np.searchsorted(self.suffixes, blocks[stop], side="left")
        high = np.searchsorted(self.suffixes, blocks[stop], side="right")
        own = low < high
        stop, low, high = stop[own], low[own], high[own]
        back = np.arange(self.length - 1, -1, -1)
        while len(stop):  # the next window of each bucket
            same = (words.hashes[stop[:, None] - back] == self.hashes[low]).all(axis=1)
            yield stop[same], low[same]
            low = low + 1
            more = low < high
            stop, low, high = stop[more], low[more], high[more]


def _folded(words: T.Words, alphabet: T.Alphabet = T.ALPHANUMERIC) -> bytes:
    return alphabet.fold[words.data].tobytes()


def build(pieces: Iterable[tuple[str, str, bool]]) -> list[Searcher]:
    """Searchers for a bounded block of (item, piece of text, whether it is the whole item)."""
    found: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = defaultdict(dict)
    for item, text, whole in pieces:
        data, offsets = T.raw(pa.array([text]))
        words = T.split_words(data, offsets, T.ALPHANUMERIC)
        n = len(words.hashes)
        length = min(WINDOW, n) if whole else WINDOW
        if not length:
            continue
        folded = _folded(words)
        own = [folded[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        for i in range(n - length + 1):
            key = b" ".join(own[i : i + length])
            found[length].setdefault(key, (words.hashes[i : i + length], set()))[1].add(item)
    return [
        Searcher(length, np.array([h for h, _ in of.values()]), list(of), [sorted(i) for _, i in of.values()])
        for length, of in sorted(found.items())
    ]


def search(texts, searchers: list[Searcher], runs: list | None = None, items: list | None = None) -> Iterator[dict]:
    """n_words, the runs of hit words [start, end, ...], and the items of each text, joined to those given."""
    for first, data, offsets in T.slices(texts):
        words = T.split_words(data, offsets, T.ALPHANUMERIC)
        n = len(words)
        change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        found: list[set[str]] = [set() if items is None else set(items[first + t] or ()) for t in range(n)]
        for t in range(n if runs is not None else 0):
            own = np.asarray(runs[first + t] or (), dtype=np.int64) + words.bounds[t]
            np.add.at(change, own[0::2], 1)
            np.add.at(change, own[1::2], -1)
        folded = None
        for searcher in searchers:
            for stop, window in searcher.positions(words):
                if not len(stop):
                    continue
                folded = folded or _folded(words)
                text = np.searchsorted(words.bounds, stop, side="right") - 1
                for e, w, t in zip(stop.tolist(), window.tolist(), text.tolist()):
                    b = e - searcher.length + 1
                    spans = zip(words.starts[b : e + 1].tolist(), words.ends[b : e + 1].tolist())
                    if b" ".join([folded[x:y] for x, y in spans]) == searcher.words[w]:
                        change[b] += 1
                        change[e + 1] -= 1
                        found[t].update(searcher.items[w])
        hit = np.cumsum(change[:-1]) > 0
        for t in range(n):
            own = hit[words.bounds[t] : words.bounds[t + 1]]
            edges: list[int] = []
            if found[t]:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))).tolist()
            yield {"n_words": len(own), "runs": edges, "items": sorted(found[t])}


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Items cut into pieces of PIECE_WORDS words that overlap by one word less than a window."""
    for batch in batches:
        out = []
        for item, text in zip(batch["item"], batch["text"]):
            data, offsets = T.raw(pa.array([text]))
            words = T.split_words(data, offsets, T.ALPHANUMERIC)
            n = len(words.starts)
            step = PIECE_WORDS - WINDOW + 1
            for k, b in enumerate(range(0, max(1, n - WINDOW + 1), step) if n else ()):
                e = min(n, b + PIECE_WORDS)
                piece = data[words.starts[b] : words.ends[e - 1]].tobytes().decode()
                out.append((item, k, piece, n <= PIECE_WORDS))
        yield pd.DataFrame(out, columns=["item", "k", "piece", "whole"])


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str, bool]]]:
    """The pieces of all items in blocks of about BLOCK_BYTES, one after the other."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
    items = items.where(F.col("item").isNotNull() & F.col("text").isNotNull())
    pieces = stage(items.mapInPandas(_pieces, "item string, k int, piece string, whole boolean"), "benchmark_pieces")
    total = pieces.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    number = -(-total // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item", "k"), F.lit(max(number, 1)))
    for b in range(number):
        yield [tuple(r) for r in pieces.where(block == b).select("item", "piece", "whole").collect()]


def _found(searchers, text: Column, before: Column | None) -> Column:
    """The column that searches one broadcast block."""

    def rows(texts, runs=None, items=None) -> pa.Array:
        kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        return pa.array(search(texts, searchers.value, runs, items), kind, size=len(texts))

    if before is None:

        @F.arrow_udf(FOUND)
        def once(texts: pa.Array) -> pa.Array:
            return rows(texts)

        return once(text)

    @F.arrow_udf(FOUND)
    def again(texts: pa.Array, runs: pa.Array, items: pa.Array) -> pa.Array:
        return rows(texts, runs.to_pylist(), items.to_pylist())

    return again(text, before["runs"], before["items"])


def contamination(docs: DataFrame, benchmark: DataFrame, found: str = "contamination") -> DataFrame:
    """The documents with a column of n_words, runs of hit words [start, end, ...) and items with occurring windows.

    found: the new column's name; a column of that name must not exist.
    """
    spark, done = docs.sparkSession, False
    for block in blocks(benchmark):
        searchers = spark.sparkContext.broadcast(build(block))
        if done:
            docs = stage(docs, "contamination")
        docs = docs.withColumn(found, _found(searchers, F.col("text"), F.col(found) if done else None))
        done = True
    if not done:
        docs = docs.withColumn(found, _found(spark.sparkContext.broadcast([]), F.col("text"), None))
    return docs


def n_hit(found: Column) -> Column:
    """The number of hit words: the runs' ends less their starts."""
    signed = F.transform(found["runs"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("bigint"))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    searched = contamination(docs.select("doc_id", "text"), benchmark, "found")
    found = F.col("found")
    return searched.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        n_hit(found).alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(found["items"])), 256).alias("items_sha256"),
        (F.size(found["runs"]) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    name = "_contamination"
    while name in docs.columns:
        name += "_"
    searched = contamination(docs, benchmark, name)
    return searched.where(F.size(F.col(name)["runs"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
