"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is the sum of two hashed embeddings, of the word and of its first bytes. Filters of one, two and three words
run over the whole text, each filter keeps its largest response, and a logistic layer scores them. The network is
trained in numpy on all labelled documents, in shards of some SHARD_ROWS that tasks fit side by side: in each round
every shard starts from the same network, and the changes that the shards make are averaged. Since only the largest
response of a filter has a gradient, a step touches a few words per text.

Thresholds are calibrated by language on all labelled documents that the network wasn't fitted on, a quarter of them,
from counts of their logits in steps of 1 / LOGIT_STEPS, and scores are shifted
so that each language's threshold is 0.7. The language is told from common words of the text itself: the language,
source, id and label columns are never inputs of a score.

Defined results: a null text is an empty one; a text without words has the score of no response at all; equal texts
have equal scores; without usable labels of both classes every score is 0. Of a long text the words are held, some 32
bytes each; responses are held for a block of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import sampling
from tillwright.llm import text as T
from tillwright.session import stage

# Documents that are fitted on in one go, on average, and how often the networks of several shards are averaged.
SHARD_ROWS = 8192
ROUNDS = 3
# Tasks that fit side by side; each hands out one network.
MOST_TASKS = 64
# Numbers of a network that are summed together.
SLICE = 1 << 16
LOGIT_STEPS = 1024

FOLDS, HELD_OUT = 3, 1
TOXIC = 0.7

BUCKETS = 1 << 17
# Of 3, 4 and 5 the one that parts the labels of the two learning folds best, each fitted on the other.
PREFIX_BYTES = 4
WIDTH = 16
FILTER_WIDTHS = (1, 2, 3)
FILTERS = 16
EPOCHS = 10
DROPPED = 0.5
# A small sample is gone through more often.
LEAST_STEPS = 600
# Words whose responses are held at once.
BLOCK_WORDS = 1 << 15

# Common words that tell a language.
LANGUAGES = {
    "en": "the and of to in is that it was for with are be this on",
    "de": "der die und das den von ist nicht mit sich auf für im zu ein",
    "fr": "le la les des et un une du que est dans qui par pour sur",
    "es": "el los las que y del se por con una su para es al lo",
}
OTHER = len(LANGUAGES)


def _hashes(words: str) -> np.ndarray:
    data, offsets = T.raw(pa.array([words]))
    return T.split_words(data, offsets, T.ALPHANUMERIC).hashes


_COMMON = [_hashes(words) for words in LANGUAGES.values()]
_COMMON_BUCKETS = np.zeros((OTHER, BUCKETS), dtype=bool)
for _row, _common in zip(_COMMON_BUCKETS, _COMMON):
    _row[(_common & np.uint64(BUCKETS - 1)).astype(np.int64)] = True


@dataclass
class Texts:
    """Word and prefix buckets of consecutive texts; text t has words bounds[t]:bounds[t + 1]."""

    words: np.ndarray
    prefixes: np.ndarray
    bounds: np.ndarray


def encode(data: np.ndarray, offsets: np.ndarray) -> Texts:
    words = T.split_words(data, offsets, T.ALPHANUMERIC)
    mask = np.uint64(BUCKETS - 1)
    prefixes = T.prefix_hashes(words, T.ALPHANUMERIC, PREFIX_BYTES)
    return Texts((words.hashes & mask).astype(np.int32), (prefixes & mask).astype(np.int32), words.bounds)


def languages(x: Texts) -> np.ndarray:
    """The index of the language with most common words in each text, OTHER without any."""
    n = len(x.bounds) - 1
    hits = np.zeros((n, OTHER), dtype=np.int64)
    for k in range(OTHER):
        sums = np.concatenate([[0], np.cumsum(_COMMON_BUCKETS[k][x.words])])
        hits[:, k] = sums[x.bounds[1:]] - sums[x.bounds[:-1]]
    return np.where(hits.max(axis=1, initial=0) > 0, hits.argmax(axis=1), OTHER)


@dataclass
class Network:
    words: np.ndarray
    prefixes: np.ndarray
    # filters[w] has one (WIDTH, FILTERS) matrix for each word of its width
    filters: list[np.ndarray]
    shift: np.ndarray
    output: np.ndarray
    bias: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(OTHER + 1))

    def responses(self, x: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each text, at least 0, and the word where its window begins.

        Words behind the last one count as empty, so that a window begins at every word. Long texts are gone through
        in blocks of words.
        """
        n, total = len(x.bounds) - 1, len(x.words)
        best = np.zeros((n, len(FILTER_WIDTHS) * FILTERS), dtype=np.float32)
        where = np.full(best.shape, -1, dtype=np.int64)
        for a in range(0, total, BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, total)
            seen = slice(a, b + max(FILTER_WIDTHS) - 1)
            embedded = self.words[x.words[seen]] + self.prefixes[x.prefixes[seen]]
            first, last = np.searchsorted(x.bounds, [a, b - 1], side="right") - 1
            cuts = np.clip(x.bounds[first : last + 2], a, b)
            full = first + np.flatnonzero(np.diff(cuts) > 0)
            starts, ends = np.maximum(x.bounds[full], a) - a, np.minimum(x.bounds[full + 1], b) - a
            left = np.repeat(x.bounds[full + 1] - a, ends - starts) - np.arange(b - a)  # words up to the end of the text
            for k, width in enumerate(FILTER_WIDTHS):
                own = embedded[: b - a] @ self.filters[k][0]
                for j in range(1, width):
                    ahead = embedded[j : j + b - a] @ self.filters[k][j]
                    ahead[left[: len(ahead)] <= j] = 0
                    own[: len(ahead)] += ahead
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                own += self.shift[columns]
                top = np.maximum.reduceat(own, starts, axis=0)
                if self.training:
                    at = np.stack([a + s + own[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
                    where[full, columns] = np.where(top > best[full, columns], at, where[full, columns])
                best[full, columns] = np.maximum(top, best[full, columns])
        return best, where

    training: bool = False

    def logits(self, x: Texts) -> np.ndarray:
        return self.responses(x)[0] @ self.output + self.bias

    def scores(self, x: Texts) -> np.ndarray:
        """The probability, shifted so that the threshold of the text's language is TOXIC."""
        return sigmoid(self.logits(x) - self.thresholds[languages(x)] + np.log(TOXIC / (1 - TOXIC)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _rows_of(x: Texts, rows: np.ndarray) -> Texts:
    pieces = [slice(x.bounds[r], x.bounds[r + 1]) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([p.stop - p.start for p in pieces])])
    return Texts(np.concatenate([x.words[p] for p in pieces]), np.concatenate([x.prefixes[p] for p in pieces]), bounds)


class _Steps:
    """Adagrad for one array."""

    def __init__(self, array: np.ndarray, rate: float):
        self.array, self.rate, self.seen = array, rate, np.full(array.shape, 1e-3, dtype=np.float32)

    def take(self, gradient: np.ndarray, rows=slice(None)) -> None:
        self.seen[rows] += gradient * gradient
        self.array[rows] -= self.rate * gradient / np.sqrt(self.seen[rows])


def unfitted(rng: np.random.Generator) -> Network:
    normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    return Network(
        normal(BUCKETS, WIDTH, by=0.1),
        normal(BUCKETS, WIDTH, by=0.1),
        [normal(width, WIDTH, FILTERS, by=0.3) for width in FILTER_WIDTHS],
        np.zeros(len(FILTER_WIDTHS) * FILTERS, dtype=np.float32),
        normal(len(FILTER_WIDTHS) * FILTERS, by=0.3),
    )


SEED = 11


def fit(
    x: Texts,
    y: np.ndarray,
    epochs: int = EPOCHS,
    seed: int = SEED,
    start: Network | None = None,
    rate: float = 1.0,
    share: float | None = None,
    least_steps: int = LEAST_STEPS,
) -> Network:
    """A network fitted from ``start``; ``share`` is that of label 1, by which both labels weigh alike."""
    rng = np.random.default_rng(seed)
    net = unfitted(rng) if start is None else _copy(start)
    net.training = True
    words, prefixes = _Steps(net.words, 0.1 * rate), _Steps(net.prefixes, 0.1 * rate)
    filters = [_Steps(f, 0.05 * rate) for f in net.filters]
    shift, output = _Steps(net.shift, 0.05 * rate), _Steps(net.output, 0.05 * rate)
    share = y.mean() if share is None else share
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    parts = max(1, len(y) // 64)
    for _ in range(max(epochs, -(-least_steps // parts))):
        for rows in np.array_split(rng.permutation(len(y)), parts):
            own = _rows_of(x, rows)
            best, where = net.responses(own)
            # some filters are left out of each step, so that no few of them carry all words
            left = (rng.random(best.shape) >= DROPPED).astype(np.float32) / (1 - DROPPED)
            best = best * left
            error = ((sigmoid(best @ net.output + net.bias) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            back = error[:, None] * net.output * left * (where >= 0)
            output.take(best.T @ error + 1e-5 * net.output)
            net.bias -= 0.5 * rate * float(error.sum())
            shift.take(back.sum(axis=0))
            touched, towards = [], []
            ends = own.bounds[1:]
            for k, width in enumerate(FILTER_WIDTHS):
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                at, g = where[:, columns], back[:, columns]
                change = np.zeros_like(net.filters[k])
                for j in range(width):
                    position = at + j
                    inside = (at >= 0) & (position < ends[:, None]) & (g != 0)
                    t, f = np.nonzero(inside)
                    p, part = position[t, f], g[t, f][:, None]
                    embedded = net.words[own.words[p]] + net.prefixes[own.prefixes[p]]
                    for filter_ in range(FILTERS):
                        change[j, :, filter_] = (embedded * part)[f == filter_].sum(axis=0)
                    touched.append(p)
                    towards.append(part * net.filters[k][j].T[f])
                filters[k].take(change)
            p, g = np.concatenate(touched), np.concatenate(towards)
            for steps, ids in ((words, own.words[p]), (prefixes, own.prefixes[p])):
                used, place = np.unique(ids, return_inverse=True)
                summed = np.zeros((len(used), WIDTH), dtype=np.float32)
                np.add.at(summed, place, g)
                steps.take(summed, used)
    net.training = False
    return net


def threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """The middle between the two neighbouring logits that part the labels best, by the F1 measure of label 1."""
    z, place = np.unique(logits, return_inverse=True)
    return _cut(z, np.bincount(place[y != 1], minlength=len(z)), np.bincount(place[y == 1], minlength=len(z)))


def _cut(z: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """The threshold from the numbers of both labels at sorted different logits."""
    toxic = ones.sum()
    caught = toxic - np.concatenate([[0], np.cumsum(ones)])
    flagged = (zeros + ones).sum() - np.concatenate([[0], np.cumsum(zeros + ones)])
    gain = 2 * caught / np.maximum(1, flagged + toxic)
    best = np.flatnonzero(gain == gain.max())
    cut = int(best[len(best) // 2])
    low, high = z[max(cut - 1, 0)], z[min(cut, len(z) - 1)]
    return float((low + high) / 2)


# A language with fewer labelled documents of a class takes the threshold of all languages.
FEWEST_TO_CALIBRATE = 30


_ENCODED = pa.schema([("label", pa.int32()), ("place", pa.int64()), ("words", pa.binary()), ("prefixes", pa.binary())])


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in T.slices(batch["text"]):
            x = encode(data, offsets)
            rows = [slice(x.bounds[t], x.bounds[t + 1]) for t in range(len(x.bounds) - 1)]
            known = [batch[name].slice(first, len(rows)) for name in ("label", "place")]
            texts = [pa.array([of[r].tobytes() for r in rows], pa.binary()) for of in (x.words, x.prefixes)]
            yield pa.record_batch([*known, *texts], schema=_ENCODED)


def _decoded(rows: pa.Table | pa.RecordBatch) -> Texts:
    words, prefixes = (rows[name].to_pylist() for name in ("words", "prefixes"))
    numbers = [np.frombuffer(b"".join(of), np.int32) for of in (words, prefixes)]
    return Texts(*numbers, np.cumsum([0, *[len(w) // 4 for w in words]]))


def _copy(net: Network) -> Network:
    return _from_vector(_vector(net))


def _vector(net: Network) -> np.ndarray:
    arrays = [net.words, net.prefixes, *net.filters, net.shift, net.output, np.array([net.bias], np.float32)]
    return np.concatenate([a.ravel() for a in arrays])


def _from_vector(vector: np.ndarray) -> Network:
    n = len(FILTER_WIDTHS) * FILTERS
    shapes = [(BUCKETS, WIDTH)] * 2 + [(width, WIDTH, FILTERS) for width in FILTER_WIDTHS] + [(n,), (n,), (1,)]
    ends = np.cumsum([int(np.prod(shape)) for shape in shapes])
    words, prefixes, *filters, shift, output, bias = (
        vector[end - int(np.prod(shape)) : end].reshape(shape).astype(np.float32) for end, shape in zip(ends, shapes)
    )
    return Network(words, prefixes, filters, shift, output, float(bias[0]))


_CHANGES = "slice int, shard int, change binary"


def _round(rows: DataFrame, net: Network, shards: int, share: float, number: int) -> Network:
    """The network moved by the mean of what each shard's documents change in it."""
    rounds = ROUNDS if shards > 1 else 1
    # later rounds go on with smaller steps; a single shard is fitted at once
    options = {"epochs": EPOCHS // rounds, "rate": 1 / (1 + number), "share": share}
    options["least_steps"] = LEAST_STEPS // rounds
    start = rows.sparkSession.sparkContext.broadcast(net)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, total, first = _vector(start.value), None, None
        for shard, own in _shards(batches):
            y = own["label"].to_numpy().astype(np.float32)
            change = _vector(fit(_decoded(own), y, seed=SEED + 1 + shard, start=start.value, **options)) - before
            total, first = (change, shard) if total is None else (total + change, first)
        if total is not None:
            for k, a in enumerate(range(0, len(total), SLICE)):
                row = [pa.array([v], t) for v, t in ((k, pa.int32()), (first, pa.int32()), (total[a : a + SLICE].tobytes(), pa.binary()))]
                yield pa.record_batch(row, ["slice", "shard", "change"])

    def summed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")  # in one order, so that equal input gives equal sums
        total = sum(np.frombuffer(c, np.float32) for c in rows["change"].to_pylist())
        return pa.table({"slice": rows["slice"][:1], "shard": rows["shard"][:1], "change": pa.array([total.tobytes()], pa.binary())})

    placed = rows.repartition(min(shards, MOST_TASKS), "shard").sortWithinPartitions("shard", "place", "words")
    parts = placed.mapInArrow(fitted, _CHANGES).groupBy("slice").applyInArrow(summed, _CHANGES)
    # together as large as one network
    found = {r["slice"]: np.frombuffer(bytes(r["change"]), np.float32) for r in parts.collect()}
    start.unpersist()
    return _from_vector(_vector(net) + np.concatenate([found[k] for k in sorted(found)]) / shards)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard, which come one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch["shard"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if held and b > a and held[0]["shard"][0].as_py() != numbers[a]:
                yield held[0]["shard"][0].as_py(), pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield held[0]["shard"][0].as_py(), pa.Table.from_batches(held)


def _calibrated(rows: DataFrame, net: Network) -> Network:
    """The network with thresholds from the logits of all rows, which are counted by language and label."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 32):  # responses are many times as large as the texts
                own = batch.slice(a, 32)
                x = _decoded(own)
                steps = np.round(np.clip(shared.value.logits(x), -64, 64) * LOGIT_STEPS).astype(np.int32)
                columns = [pa.array(languages(x).astype(np.int32)), pa.array(steps), own["label"]]
                yield pa.record_batch(columns, ["language", "step", "label"])

    counted = rows.mapInArrow(logits, "language int, step int, label int").groupBy("language", "step").agg(
        F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones")
    )
    found = counted.orderBy("step", "language").toArrow()  # at most 128 * LOGIT_STEPS rows a language
    language, step, zeros, ones = (found[c].to_numpy() for c in ("language", "step", "zeros", "ones"))
    out = _copy(net)
    for k in (None, *range(OTHER + 1)):
        own = np.ones(len(step), dtype=bool) if k is None else language == k
        if k is None or min(zeros[own].sum(), ones[own].sum()) >= FEWEST_TO_CALIBRATE:
            z, place = np.unique(step[own], return_inverse=True)
            counts = [np.bincount(place, of[own], len(z)).astype(np.int64) for of in (zeros, ones)]
            out.thresholds[slice(None) if k is None else k] = _cut(z / LOGIT_STEPS, *counts)
    return out


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """A network fitted on three of four labelled documents, with thresholds from the others; None without both labels.

    With too few documents of a label among the others, all documents serve for both.
    """
    known = sampling.labelled(docs, labels, "toxic", FOLDS, HELD_OUT)
    known = known.select("label", F.xxhash64("doc_id").alias("place"), "text")
    rows = stage(known.mapInArrow(_encoded, "label int, place bigint, words binary, prefixes binary"), "labelled_texts")
    other = F.pmod(F.col("place"), F.lit(4)) == 3
    sizes = {(r["other"], r["label"]): r["count"] for r in rows.groupBy(other.alias("other"), "label").count().collect()}
    parted = min(sizes.get((True, y), 0) for y in (0, 1)) >= FEWEST_TO_CALIBRATE
    ones, zeros = (sum(n for (o, y), n in sizes.items() if y == label and not (parted and o)) for label in (1, 0))
    if not ones or not zeros:
        return None
    shards = -(-(ones + zeros) // SHARD_ROWS)
    fitted_on = (rows.where(~other) if parted else rows).withColumn(
        "shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int")
    )
    net = unfitted(np.random.default_rng(SEED))
    for number in range(ROUNDS if shards > 1 else 1):
        net = _round(fitted_on, net, shards, ones / (ones + zeros), number)
    return _calibrated(rows.where(other) if parted else rows, net)


# Texts scored at once hold about so many bytes.
SCORED_BYTES = 1 << 18


def score(spark: SparkSession, text: Column, net: Network | None) -> Column:
    """The probability of label 1, from the text alone; TOXIC is the threshold of every language."""
    model = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if model.value is None:
            return pa.array(np.zeros(len(texts)))
        out = [model.value.scores(x) for x in _short(texts)]
        return pa.array(np.concatenate(out).astype(float) if out else np.zeros(0))

    return scored(text)


def _short(texts) -> Iterator[Texts]:
    """Encoded texts in groups of about SCORED_BYTES."""
    for _, data, offsets in T.slices(texts):
        x = encode(data, offsets)
        group = offsets[:-1] // SCORED_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            own = slice(x.bounds[a], x.bounds[b])
            yield Texts(x.words[own], x.prefixes[own], x.bounds[a : b + 1] - x.bounds[a])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    net = train(docs, labels)
    scored = docs.select(
        "doc_id",
        F.coalesce(sampling.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(docs.sparkSession, F.col("text"), net).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
