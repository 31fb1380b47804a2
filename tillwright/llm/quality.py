"""Quality classifier: a factorisation machine over hashed words, structure statistics and size metadata.

Every text becomes a sparse vector: hashed words weighted by the root of their share, statistics of its structure
(letters, digits, symbols, repeats, lines) and of its size. The machine scores it by

    bias + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

that is all pairwise interactions in time linear in the number of features. It is fitted in numpy, by stochastic
gradients with per-weight steps, on a bounded sample of labelled documents (SAMPLE_PER_CLASS rows of each label).
Labels, language, source and id are never inputs.

Defined results: a null text is an empty one; an empty text is scored by its statistics; equal texts have equal
scores; without usable labels of both classes nothing is known against a text and its score is 1. Memory of a task is a
multiple of its longest text, for the different words of that text and their values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import sampling
from tillwright.llm import text as T

# At most so many documents of each label are fitted on.
SAMPLE_PER_CLASS = 4000

FOLDS, HELD_OUT = 4, 2
ACCEPTED = 0.7

BUCKETS = 1 << 16
FACTORS = 8
STATISTICS = 16
EPOCHS = 12

_BYTES = np.arange(256)
_KINDS = np.stack(
    [
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 97) & (_BYTES <= 122),
        (_BYTES >= 48) & (_BYTES <= 57),
        _BYTES >= 0x80,
        np.isin(_BYTES, list(b".,;:?'\"()-")),
        np.isin(_BYTES, list(b"!#$%&*+/<=>@[\\]^_`{|}~")),
        np.isin(_BYTES, list(b"\t\n\x0b\x0c\r ")),
    ]
).astype(np.float32)


@dataclass
class Features:
    """Sparse rows: row r has buckets[bounds[r]:bounds[r + 1]] with their values, and a row of statistics."""

    buckets: np.ndarray
    values: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray


def _group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows, zero for empty ones."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=np.float32)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> Features:
    words = T.split_words(data, offsets, T.SPACED)
    n, counts = len(words), words.counts
    text_of = np.repeat(np.arange(n), counts)
    # distinct words of each text with their counts
    keys = (text_of.astype(np.uint64) << np.uint64(16)) | (words.hashes & np.uint64(BUCKETS - 1))
    distinct, times = np.unique(keys, return_counts=True)
    owner = (distinct >> np.uint64(16)).astype(np.int64)
    bounds = np.searchsorted(owner, np.arange(n + 1))
    total = np.maximum(counts, 1).astype(np.float32)
    values = np.sqrt(times.astype(np.float32) / total[owner])

    size = np.diff(offsets).astype(np.float32)
    some = np.maximum(size, 1)
    histogram = np.zeros((n, 256), dtype=np.float32)
    for t in range(n):
        histogram[t] = np.bincount(data[offsets[t] : offsets[t + 1]], minlength=256)
    shares = histogram @ _KINDS.T / some[:, None]
    newlines = histogram[:, 10]
    most = np.zeros(n, dtype=np.float32)
    full = np.diff(bounds) > 0
    if full.any():
        most[full] = np.maximum.reduceat(times, bounds[:-1][full])
    # words that repeat the word before them, and words that end with a symbol
    repeated = np.zeros(len(words.hashes), dtype=np.float32)
    if len(repeated) > 1:
        repeated[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text_of[1:] == text_of[:-1])
    closing = _KINDS[5][data[words.ends - 1]] if len(words.ends) else np.zeros(0, np.float32)
    letters = np.maximum(shares[:, 0] + shares[:, 1], 1e-3)
    statistics = np.column_stack(
        [
            shares,
            shares[:, 0] / letters,
            np.diff(bounds) / total,
            most / total,
            _group_sums(repeated, words.bounds) / total,
            _group_sums(closing, words.bounds) / total,
            size / total / 20,
            np.log1p(counts) / 5,
            np.log1p(newlines) / 3,
            np.log1p(total / (newlines + 1)) / 4,
        ]
    ).astype(np.float32)
    buckets = (distinct & np.uint64(BUCKETS - 1)).astype(np.int64)
    return Features(buckets, values, bounds, statistics)


@dataclass
class Machine:
    """Weights and factors; the last STATISTICS rows belong to the statistics, which are centred and scaled."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def _rows(self, x: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of all rows: index, value, bounds."""
        n = len(x.bounds) - 1
        fixed = np.clip((x.statistics - self.centre) / self.scale, -5, 5)
        bounds = x.bounds + STATISTICS * np.arange(n + 1)
        index = np.empty(bounds[-1], dtype=np.int64)
        value = np.empty(bounds[-1], dtype=np.float32)
        last = (bounds[1:, None] - STATISTICS + np.arange(STATISTICS)).ravel()
        index[last] = np.tile(BUCKETS + np.arange(STATISTICS), n)
        value[last] = fixed.ravel()
        own = np.ones(bounds[-1], dtype=bool)
        own[last] = False
        index[own], value[own] = x.buckets, x.values
        return index, value, bounds

    def logits(self, x: Features) -> np.ndarray:
        index, value, bounds = self._rows(x)
        part = self.factors[index] * value[:, None]
        sums, squares = _group_sums(part, bounds), _group_sums(part * part, bounds)
        linear = _group_sums(self.linear[index] * value, bounds)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _rows_of(x: Features, rows: np.ndarray) -> Features:
    pieces = [slice(x.bounds[r], x.bounds[r + 1]) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([p.stop - p.start for p in pieces])])
    return Features(
        np.concatenate([x.buckets[p] for p in pieces]),
        np.concatenate([x.values[p] for p in pieces]),
        bounds,
        x.statistics[rows],
    )


def fit(x: Features, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, both classes with the same weight; a light penalty keeps weights small."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATISTICS
    machine = Machine(
        0.0,
        np.zeros(size, dtype=np.float32),
        (rng.standard_normal((size, FACTORS)) * 0.02).astype(np.float32),
        x.statistics.mean(axis=0),
        x.statistics.std(axis=0) + 1e-3,
    )
    seen_linear, seen_factors = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    step, seen_bias = 0.15, 1e-2
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            own = _rows_of(x, rows)
            index, value, bounds = machine._rows(own)
            part = machine.factors[index] * value[:, None]
            sums, squares = _group_sums(part, bounds), _group_sums(part * part, bounds)
            z = machine.bias + _group_sums(machine.linear[index] * value, bounds)
            z += 0.5 * (sums * sums - squares).sum(axis=1)
            error = ((_sigmoid(z) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            each = np.repeat(error, np.diff(bounds)) * value
            order = np.argsort(index, kind="stable")
            used, first = np.unique(index[order], return_index=True)
            towards = each[:, None] * (np.repeat(sums, np.diff(bounds), axis=0) - part)
            g = np.add.reduceat(each[order], first) + 1e-5 * machine.linear[used]
            h = np.add.reduceat(towards[order], first, axis=0) + 1e-5 * machine.factors[used]
            seen_linear[used] += g * g
            machine.linear[used] -= step * g / np.sqrt(seen_linear[used])
            seen_factors[used] += h * h
            machine.factors[used] -= 0.3 * step * h / np.sqrt(seen_factors[used])
            seen_bias += float(error.sum()) ** 2
            machine.bias -= step * float(error.sum()) / seen_bias**0.5
    return machine


def _features_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        labels, out = batch["label"].to_numpy(), []
        for first, data, offsets in T.slices(pa.Array.from_pandas(batch["text"], type=pa.large_string())):
            x = features(data, offsets)
            for t in range(len(x.bounds) - 1):
                own = slice(x.bounds[t], x.bounds[t + 1])
                out.append((labels[first + t], x.buckets[own].astype(np.int32), x.values[own], x.statistics[t]))
        yield pd.DataFrame(out, columns=["label", "buckets", "word_values", "statistics"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine | None:
    """A machine fitted on the sample; None without documents of both labels."""
    sample = sampling.labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class)
    schema = "label int, buckets array<int>, word_values array<float>, statistics array<float>"
    rows = sample.select("doc_id", "text", "label").mapInPandas(_features_of, schema).toPandas()
    if rows["label"].nunique() < 2:
        return None
    rows = rows.assign(size=rows["buckets"].map(len), key=rows["word_values"].map(lambda v: float(np.sum(v))))
    rows = rows.sort_values(["label", "size", "key"], kind="stable")  # whatever order the tasks had
    bounds = np.concatenate([[0], np.cumsum(rows["size"])])
    x = Features(
        np.concatenate(rows["buckets"].to_list()).astype(np.int64),
        np.concatenate(rows["word_values"].to_list()).astype(np.float32),
        bounds,
        np.stack(rows["statistics"].to_list()).astype(np.float32),
    )
    return fit(x, rows["label"].to_numpy().astype(np.float32))


def score(spark: SparkSession, text: Column, machine: Machine | None) -> Column:
    """The probability of label 1, from the text alone."""
    model = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if model.value is None:
            return pa.array(np.ones(len(texts)))
        out = [_sigmoid(model.value.logits(features(data, offsets))) for _, data, offsets in T.slices(texts)]
        return pa.array(np.concatenate(out).astype(float) if out else np.zeros(0))

    return scored(text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    machine = train(docs, labels)
    scored = docs.select(
        "doc_id",
        F.coalesce(sampling.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(docs.sparkSession, F.col("text"), machine).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches ACCEPTED."""
    return docs.where(score(docs.sparkSession, F.col("text"), train(docs, labels)) >= ACCEPTED)
