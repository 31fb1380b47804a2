"""Language-model scores: a probabilistic suffix tree over words.

Tokens are the words of a text and one end. The root of the tree is the smoothed distribution of single tokens; a
context of up to DEPTH preceding tokens becomes a state if it diverges from its parent, the longest shorter state: the
likelihood gained on the training tokens by its own distribution must pay for its entries (half the logarithm of the
number of tokens each, as in the Bayesian information criterion). A state's distribution keeps what its frequent next
tokens were seen more than DISCOUNT times for and spreads the rest as its parent does; a token is scored in the state
of the longest suffix of what precedes it, the end of the text before counting as the first context of a text.

Sequences of up to DEPTH + 1 tokens count from LEAST_COUNT occurrences on, however large the corpus is. A sequence can be
that frequent only if both sequences of one token less are, so lengths are counted one after the other. Neither the
counts nor the tree are ever on the driver or whole in a task:

- Texts are numbered token by token in chunks of about CHUNK_TOKENS, which are stored, one row each.
- A chunk asks for its different sequences of a length, each once with its count, in rows by buckets of hashes. A bucket
  sums the counts over all chunks, ranks its frequent sequences, and tells every chunk the ranks of those it asked for.
  Rank and bucket together name a sequence, and the names of a sequence without its last token and of that token are
  the key of a sequence of one token more.
- The tree is grown by joins of the frequent sequences of a length with those of one token less. What a state gives
  and leaves is sent to the chunks the way the ranks were, and a chunk scores its texts.

To score other texts than those learnt from, they ask the buckets of the stored sequences. Tokens are known by 64-bit
hashes of their words.

Defined results: a null text is an empty one, which is its end alone; a null id is not held out and learnt from;
repeated rows count and are scored each; without training texts every count is 0 and the root is uniform. Memory of a
task is a multiple of the longest text and of CHUNK_TOKENS.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm import sampling
from tillwright.llm import text as T
from tillwright.session import stage

FOLDS, HELD_OUT = 7, 2

DEPTH = 3
# No share of all tokens is too small for a sequence to count.
LEAST_SHARE = 0.0
LEAST_COUNT = 10
DISCOUNT = 0.75
# Tokens that are numbered together; a bucket of sequences holds about as many.
CHUNK_TOKENS = 1 << 21

END = np.uint64(0x1D8E4E27C47D124F)
_LOW = 0xFFFFFFFF
_NAMES = 1 << 31


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, an end behind each, and the n + 1 bounds of the texts in them."""
    words = T.split_words(data, offsets, T.SPACED)
    bounds = words.bounds + np.arange(len(words.bounds))
    out = np.full(bounds[-1], END, dtype=np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[bounds[1:] - 1] = False
    out[inside] = words.hashes
    return out, bounds


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(tokens, bounds, other columns) of a few consecutive texts, or of one long text."""
    for batch in batches:
        rest = batch.drop_columns(["text"])
        for first, data, offsets in T.slices(batch["text"]):
            tokens, bounds = _tokens(data, offsets)
            yield tokens, bounds, rest.slice(first, len(bounds) - 1)


def _runs(pieces: Iterator, size) -> Iterator[list]:
    """Consecutive pieces of at most CHUNK_TOKENS together by their size; a larger piece is alone."""
    held, total = [], 0
    for piece in pieces:
        if held and total + size(piece) > CHUNK_TOKENS:
            yield held
            held, total = [], 0
        held.append(piece)
        total += size(piece)
    if held:
        yield held


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value in the sorted keys, -1 where it is not among them."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _pair(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The key of a sequence: the name of all but its last token, and the name of the last one; -1 without either."""
    return np.where((before >= 0) & (after >= 0), (before << np.int64(32)) | after, np.int64(-1))


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the highest bit set in all but the last byte of a number; and each number's bytes."""
    longest = max(1, -(-int(numbers.max()).bit_length() // 7)) if len(numbers) else 1
    size = np.ones(len(numbers), dtype=np.int64)
    for k in range(1, longest):
        size += numbers >= 1 << (7 * k)
    ends = np.cumsum(size)
    out = np.zeros(ends[-1] if len(ends) else 0, dtype=np.uint8)
    for k in range(longest):
        own = size > k
        more = np.where(size[own] > k + 1, 128, 0)
        out[(ends - size)[own] + k] = (numbers[own] >> (7 * k)) & 127 | more
    return out, size


def _unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    out = np.zeros(len(ends), dtype=np.int64)
    for k in range(int((ends - starts).max()) + 1 if len(ends) else 0):
        own = starts + k <= ends
        out[own] |= (data[starts[own] + k].astype(np.int64) & 127) << (7 * k)
    return out


def _write(numbers: np.ndarray) -> bytes:
    return _packed(numbers)[0].tobytes()


def _read(data: bytes) -> np.ndarray:
    return _unpacked(np.frombuffer(data, np.uint8))


# Chunks


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per chunk: its texts' ids, whether they are learnt from, their sizes and tokens, and its words."""
    partition = TaskContext.get().partitionId()
    for run, pieces in enumerate(_runs(_slices(batches), lambda piece: len(piece[0]))):
        words, number = np.unique(np.concatenate([tokens for tokens, _, _ in pieces]), return_inverse=True)
        order = np.argsort(-np.bincount(number, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))  # the most frequent words have the shortest numbers
        sizes = np.concatenate([np.diff(bounds) for _, bounds, _ in pieces])
        rest = pa.Table.from_batches([own for _, _, own in pieces]).combine_chunks().to_batches()[0]
        learnt = rest["learnt"].to_numpy(zero_copy_only=False)
        n = np.bincount(number[np.repeat(learnt, sizes)], minlength=len(words))
        ids = pa.ListArray.from_arrays(pa.array([0, len(rest)], pa.int32()), rest["doc_id"])
        columns = {
            "chunk": pa.array([(partition << 24) + run]),
            "doc_id": ids,
            "learnt": pa.array([learnt.astype(np.uint8).tobytes()], pa.binary()),
            "sizes": pa.array([_write(sizes)], pa.binary()),
            "tokens": pa.array([_write(rank[number])], pa.binary()),
            "places": pa.array([_write(order)], pa.binary()),
            "words": pa.array([words.tobytes()], pa.binary()),
            "n": pa.array([_write(n)], pa.binary()),
            "n_tokens": pa.array([int(sizes.sum())]),
        }
        yield pa.record_batch(list(columns.values()), list(columns))


def _chunked(docs: DataFrame, learnt: Column) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"chunk bigint, doc_id array<{kind}>, learnt binary, sizes binary, tokens binary, places binary, words binary, n binary, n_tokens bigint"
    return stage(docs.select("doc_id", "text", learnt.alias("learnt")).mapInArrow(_chunks, columns), "chunks")


# Asked sequences

_ASKED = "bucket int, chunk bigint, keys binary, n binary"


def _buckets(keys: np.ndarray, level: int, buckets: int) -> np.ndarray:
    """The bucket of each key; words are hashes, so that sorted words lie in order of their buckets."""
    hashes = keys.view(np.uint64)
    if level:
        hashes = T.mix(hashes + np.uint64(level))
    return (hashes >> np.uint64(65 - buckets.bit_length())).astype(np.int64) if buckets > 1 else np.zeros(len(keys), np.int64)


def _write_keys(keys: np.ndarray, level: int) -> bytes:
    return keys.tobytes() if not level else _write(np.diff(keys, prepend=0))


def _read_keys(data: bytes, level: int) -> np.ndarray:
    return np.frombuffer(data, np.uint64).copy() if not level else np.cumsum(_read(data))


def _asking(chunk: int, keys: np.ndarray, n: np.ndarray, level: int, buckets: int) -> pa.RecordBatch:
    """A row per bucket of sorted keys."""
    of = _buckets(keys, level, buckets)
    if level:
        order = np.argsort(of, kind="stable")
        of, keys, n = of[order], keys[order], n[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])[: len(of) + 1]
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    columns = {
        "bucket": pa.array(of[cuts[:-1]], pa.int32()),
        "chunk": pa.array(np.full(len(spans), chunk)),
        "keys": pa.array([_write_keys(keys[a:b], level) for a, b in spans], pa.binary()),
        "n": pa.array([_write(n[a:b]) for a, b in spans], pa.binary()),
    }
    return pa.record_batch(list(columns.values()), list(columns))


def _grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows of a table in order of a column, by its values."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[column] != current:
                yield current, rows
                rows = []
            current = row[column]
            rows.append(row)
    if rows:
        yield current, rows


_ANSWERED = "level int, bucket int, chunk bigint, keys binary, n binary, ranks binary, total bigint, size bigint"


def _answered(asked: DataFrame, level: int, buckets: int) -> DataFrame:
    """Answers to the chunks, and a row without a chunk for each bucket: its frequent sequences, or all its words.

    Rows of the latter kind among the asked ones bring counts, but no answer is owed to them.
    """

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches, "bucket"):
            parts = [_read_keys(row["keys"], level) for row in rows]
            cuts = np.cumsum([0, *[len(part) for part in parts]])
            keys, at = np.unique(np.concatenate(parts), return_inverse=True)
            counts = np.concatenate([_read(row["n"]) for row in rows])
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, at, counts)
            frequent = total >= LEAST_COUNT
            rank = np.cumsum(frequent) - 1
            if len(keys) and (int(rank[-1]) + 1) * buckets > _NAMES:
                raise OverflowError("too many frequent sequences to be named")
            found = []
            for row, a, b in zip(rows, cuts[:-1], cuts[1:]):
                if row["chunk"] is None:
                    continue
                own = at[a:b]
                hit = own[frequent[own]]
                kept = (None, _write(total[own])) if not level else (_write_keys(keys[hit], level), None)
                found.append((level, bucket, row["chunk"], *kept, _write(np.diff(rank[hit], prepend=0)), None, None))
            stored = total > 0 if not level else frequent
            sums = int(total.sum()), int((total > 0).sum())
            found.append((level, bucket, None, _write_keys(keys[stored], level), _write(total[stored]), None, *sums))
            for k in range(0, len(found), 256):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found[k : k + 256]), kinds)], names)

    names = [c.split()[0] for c in _ANSWERED.split(", ")]
    kinds = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in _ANSWERED.split(", ")]
    dealt = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    return stage(dealt.mapInArrow(answered, _ANSWERED), f"sequences_{level}")


@dataclass(frozen=True)
class Chunk:
    """Texts as names, and places in the answers, of frequent words, -1 for others; an end is before each text, at firsts."""

    learnt: np.ndarray
    counts: np.ndarray
    inside: np.ndarray
    firsts: np.ndarray
    places: np.ndarray
    names: np.ndarray
    answers: dict[int, list[dict]]
    buckets: int

    @classmethod
    def of(cls, row: dict, answers: list[dict], buckets: int) -> Chunk:
        by_level: dict[int, list[dict]] = {}
        for answer in answers:
            by_level.setdefault(answer["level"], []).append(answer)
        sizes = _read(row["sizes"])
        firsts = np.cumsum(sizes) - sizes + np.arange(len(sizes))
        inside = np.ones(int(sizes.sum()) + len(sizes), dtype=bool)
        inside[firsts] = False
        number = np.empty(len(inside), dtype=np.int64)
        number[inside] = _read(row["places"])[_read(row["tokens"])]
        number[firsts] = number[firsts + sizes]  # the last token of a text is its end
        n = np.concatenate([_read(a["n"]) for a in by_level[0]])
        places = np.where(n >= LEAST_COUNT, np.cumsum(n >= LEAST_COUNT) - 1, -1)[number]
        names = _taken(_names(by_level[0], buckets), places, -1)
        learnt = np.repeat(np.frombuffer(row["learnt"], np.uint8) > 0, sizes + 1)
        return cls(learnt, n[number], inside, firsts, places, names, by_level, buckets)

    def sequences(self, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(keys, places, names) of the sequences of 2, 3 ... tokens that begin at each token, -1 without.

        Places are those in the order of ``values``. Both sequences of one token less are frequent, and none runs from
        one text into the next.
        """
        key = _pair(self.names[:-1], self.names[1:])
        key[self.firsts[1:] - 1] = -1
        for level in range(1, levels + 1):
            answers = self.answers.get(level, [])
            if not answers:
                yield key, np.full(len(key), -1, dtype=np.int64), np.full(len(key), -1, dtype=np.int64)
                return
            known = np.concatenate([_read_keys(a["keys"], level) for a in answers])
            order = np.argsort(known)
            at = _places(known[order], key)
            at[at >= 0] = order[at[at >= 0]]
            named = _taken(_names(answers, self.buckets), at, -1)
            yield key, at, named
            key = np.where(named[1:] >= 0, _pair(named[:-1], self.names[level + 1 :]), -1)

    def values(self, level: int, column: str, places: np.ndarray, default: float) -> np.ndarray:
        """What the answers of a level hold at the places, the default where the place is -1."""
        answers = self.answers.get(level, [])
        held = np.concatenate([np.zeros(0), *[np.frombuffer(a[column], np.float64) for a in answers]])
        return _taken(held, places, default)


def _taken(values: np.ndarray, places: np.ndarray, default: float) -> np.ndarray:
    return np.append(values, np.array([default], dtype=values.dtype))[places]  # the place -1 is the last one


def _names(answers: list[dict], buckets: int) -> np.ndarray:
    return np.concatenate([np.cumsum(_read(a["ranks"])) * buckets + a["bucket"] for a in answers])


def _each_chunk(
    chunks: DataFrame, answers: DataFrame, buckets: int, made: Callable[[dict, Chunk], pa.RecordBatch], columns: str
) -> DataFrame:
    """A table from each chunk and its answers; as many tasks as chunks, however many they are."""
    answers = answers.where(F.col("chunk").isNotNull())
    both = chunks.drop("words", "n", "n_tokens").unionByName(answers, allowMissingColumns=True)
    dealt = both.repartition(max(chunks.count(), 1), "chunk").sortWithinPartitions("chunk", "level", "bucket")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(_lists(batches), "chunk"):
            yield made(rows[0], Chunk.of(rows[0], rows[1:], buckets))

    return dealt.mapInArrow(each, columns)


class _Rows:
    """A batch whose rows keep document ids as Arrow values."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.batch = batch

    def to_pylist(self) -> list[dict]:
        rows = self.batch.drop_columns(["doc_id"]).to_pylist()
        for k, row in enumerate(rows):
            if row["tokens"] is not None:
                row["doc_id"] = self.batch["doc_id"][k].values
        return rows


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
    return map(_Rows, batches)


def _asked_words(chunks: DataFrame, buckets: int) -> DataFrame:
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _asking(row["chunk"], np.frombuffer(row["words"], np.uint64), _read(row["n"]), 0, buckets)

    return chunks.select("chunk", "words", "n").mapInArrow(asked, _ASKED)


def _asked_sequences(chunks: DataFrame, answers: DataFrame, level: int, buckets: int) -> DataFrame:
    def asked(row: dict, chunk: Chunk) -> pa.RecordBatch:
        *_, (keys, _, _) = chunk.sequences(level)
        here = keys >= 0
        # the lowest bit tells whether the sequence is learnt from
        both = np.sort((keys[here] << np.int64(1)) | chunk.learnt[: len(keys)][here])
        first = np.flatnonzero(np.diff(both >> np.int64(1), prepend=-1))
        n = np.add.reduceat(both & 1, first) if len(first) else np.zeros(0, np.int64)
        return _asking(row["chunk"], both[first] >> np.int64(1), n, level, buckets)

    return _each_chunk(chunks, answers, buckets, asked, _ASKED)


def _levels(chunks: DataFrame, depth: int, buckets: int, stored: tuple[DataFrame, ...] | None = None) -> list[DataFrame]:
    """Answers for words, then for sequences of 2 to depth + 1 tokens; with stored sequences their counts and no others."""
    found: list[DataFrame] = []
    for level in range(depth + 1 if stored is None else len(stored)):
        if level:
            before = found[0]
            for answers in found[1:]:
                before = before.unionByName(answers)
            asked = _asked_sequences(chunks, before, level, buckets)
        else:
            asked = _asked_words(chunks, buckets)
        if stored is not None:
            asked = asked.unionByName(stored[level].select(*asked.columns))
        found.append(_answered(asked, level, buckets))
    return found


# The tree


@dataclass(frozen=True)
class Tree:
    """states[d]: how many contexts of d + 1 tokens are states. values: (level, bucket, rank, own, spread).

    own: what the state before the last token of a sequence gives to that token itself; spread: what a state leaves to
    its parent. Sequences that neither are a state nor follow one have no row.
    """

    n_tokens: int
    n_words: int
    states: tuple[np.ndarray, ...]
    values: DataFrame


@dataclass(frozen=True)
class Model:
    """sequences[d]: stored sequences of d + 1 tokens with their counts, in rows by bucket."""

    sequences: tuple[DataFrame, ...]
    buckets: int
    tree: Tree


def _listed(stored: DataFrame, level: int, buckets: int) -> DataFrame:
    """(name, key, n) of the frequent sequences of a length."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = _read_keys(row["keys"], level).view(np.int64), _read(row["n"])
                keys, n = keys[n >= LEAST_COUNT], n[n >= LEAST_COUNT]
                names = np.arange(len(keys)) * buckets + row["bucket"]
                yield pa.record_batch([pa.array(names), pa.array(keys), pa.array(n)], ["name", "key", "n"])

    return stored.select("bucket", "keys", "n").mapInArrow(listed, "name bigint, key bigint, n bigint")


def _exact(value: Column, places: int = 18) -> Column:
    """A sum that doesn't depend on the order of its terms."""
    return F.sum(value.cast(f"decimal(38,{places})")).cast("double")


def _grown(sequences: tuple[DataFrame, ...], buckets: int) -> Model:
    """The states among the frequent sequences, by the divergence from their parents."""
    sums = sequences[0].agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_tokens, n_words = int(sums[0]), int(sums[1])
    root = (F.col("n") + 1).cast("double") / F.lit(float(n_tokens + n_words + 1))
    before = _listed(sequences[0], 0, buckets).select("name", "key", "n", F.lit(None).cast("bigint").alias("shorter"), root.alias("resolved"))
    before = stage(before.withColumn("own", F.lit(0.0)), "words_of_tree")
    values, states = [], []
    n, parent = F.col("n").cast("double"), F.col("parent")
    for level in range(1, len(sequences)):
        kids = _listed(sequences[level], level, buckets).select(
            "name", "key", "n", F.shiftright("key", 32).alias("context"), F.col("key").bitwiseAND(F.lit(_LOW)).alias("last")
        )
        kids = kids.join(before.select(F.col("name").alias("context"), F.col("n").alias("before"), F.col("shorter").alias("suffix")), "context")
        # the same last token behind the context without its first token
        if level == 1:
            tail = before.select(F.col("name").alias("tail"), F.col("name").alias("shorter"), F.col("resolved").alias("parent"))
            kids = kids.withColumn("tail", F.col("last"))
        else:
            tail = before.select(F.col("key").alias("tail"), F.col("name").alias("shorter"), F.col("resolved").alias("parent"))
            kids = kids.withColumn("tail", F.shiftleft("suffix", 32).bitwiseOR(F.col("last")))
        kids = kids.join(tail, "tail").drop("tail", "suffix", "last")
        own = kids.groupBy("context", "before").agg(
            F.sum("n").alias("listed"),
            F.count("*").alias("entries"),
            (1 - _exact(parent, 25)).alias("parent_left"),
            _exact(n * F.log(n / F.col("before") / parent)).alias("gain"),
        )
        left, entries = F.col("before") - F.col("listed"), F.col("entries")
        rest = F.when(
            (left > 0) & (F.col("parent_left") > 0), left * F.log(left / F.col("before") / F.col("parent_left"))
        ).otherwise(0.0)
        least = entries * F.lit(float(np.log(max(n_tokens, 2)))) / 2
        own = own.where(F.col("gain") + rest >= least).select(
            F.col("context").alias("state"), (1 - (F.col("listed") - DISCOUNT * entries) / F.col("before")).alias("spread")
        )
        own = stage(own, f"states_{level}")
        states.append(np.array([own.count()]))
        is_state = F.col("state").isNotNull()
        given = F.when(is_state, (n - DISCOUNT) / F.col("before")).otherwise(0.0)
        resolved = F.when(is_state, F.col("given") + F.col("spread") * parent).otherwise(parent)
        kids = kids.join(own, F.col("context") == F.col("state"), "left").withColumn("given", given)
        kids = stage(kids.select("name", "key", "n", "shorter", resolved.alias("resolved"), F.col("given").alias("own")), f"grown_{level}")
        values.append(_values(before, own, level - 1, buckets))
        before = kids
    values.append(_values(before, None, len(sequences) - 1, buckets))
    rows = values[0]
    for more in values[1:]:
        rows = rows.unionByName(more)
    return Model(sequences, buckets, Tree(n_tokens, n_words, tuple(states), rows))


def _values(named: DataFrame, states: DataFrame | None, level: int, buckets: int) -> DataFrame:
    rows = named.select("name", "own")
    if states is None:
        rows = rows.withColumn("spread", F.lit(1.0))
    else:
        rows = rows.join(states, F.col("name") == F.col("state"), "left").withColumn("spread", F.coalesce("spread", F.lit(1.0)))
    bucket = F.pmod("name", F.lit(buckets)).cast("int").alias("bucket")
    rank = F.floor(F.col("name") / buckets).cast("bigint").alias("rank")
    return rows.where("own <> 0 or spread <> 1").select(F.lit(level).alias("level"), bucket, rank, "own", "spread")


def _learnt(chunks: DataFrame, depth: int) -> tuple[Model, list[DataFrame]]:
    """The tree of the chunks' texts that are learnt from, and the answers of all lengths to the chunks."""
    tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = 1 << max(0, (int(tokens) // CHUNK_TOKENS).bit_length())
    answers = _levels(chunks, depth, buckets)
    sequences = tuple(a.where(F.col("chunk").isNull()) for a in answers)
    return _grown(sequences, buckets), answers


def train(training: DataFrame, depth: int = DEPTH) -> Model:
    """The tree of the texts of a table."""
    docs = training.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    return _learnt(_chunked(docs, F.lit(True)), depth)[0]


# Scores

SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"
_VALUED = "level int, bucket int, chunk bigint, keys binary, n binary, ranks binary, own binary, spread binary"


def _valued(answers: list[DataFrame], model: Model) -> DataFrame:
    """The answers with what the tree holds for each of their sequences."""
    rows = answers[0]
    for more in answers[1:]:
        rows = rows.unionByName(more)
    rows = rows.where(F.col("chunk").isNotNull()).drop("total", "size")
    buckets = model.buckets
    both = rows.unionByName(
        model.tree.values.select("level", "bucket", "rank", F.col("own").alias("value"), F.col("spread").alias("left")),
        allowMissingColumns=True,
    ).withColumn("place", F.concat_ws("-", "level", "bucket"))
    # a bucket's values come before its answers
    dealt = both.repartition(buckets * len(answers), "place").sortWithinPartitions("place", "chunk", "rank")

    return dealt.mapInArrow(_with_values, _VALUED)


def _with_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, ranks, own, spread, pieces = None, None, None, None, []
    for batch in batches:
        places = batch["place"].dictionary_encode()
        for a, b in _segments(places.indices.to_numpy()):
            if places[a].as_py() != current:
                current, ranks, pieces = places[a].as_py(), None, []
            part = batch.slice(a, b - a)
            told = part["chunk"].null_count
            if told:
                pieces.append([part.slice(0, told)[c].to_numpy() for c in ("rank", "value", "left")])
            rows = part.slice(told).to_pylist()
            if not rows:
                continue
            if ranks is None:
                none = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
                ranks, own, spread = (np.concatenate(column) for column in zip(*pieces or [none]))
            columns: dict[str, list] = {name: [row[name] for row in rows] for name in ("level", "bucket", "chunk", "keys", "n", "ranks")}
            at = [_places(ranks, np.cumsum(_read(row["ranks"]))) for row in rows]
            for name, held, default in (("own", own, 0.0), ("spread", spread, 1.0)):
                columns[name] = [np.where(p >= 0, held[p] if len(held) else default, default).tobytes() for p in at]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns.values(), kinds)], list(columns))


def _segments(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def _probabilities(chunk: Chunk, root: np.ndarray, levels: int) -> np.ndarray:
    """The probability of each token in its longest state."""
    out = root.copy()
    context = chunk.places
    for d, (_, at, _) in enumerate(chunk.sequences(levels)):
        # context[i]: the sequence of d + 1 tokens that begins at i; it precedes token i + d + 1
        spread = chunk.values(d, "spread", context[: len(at)], 1.0)
        if d == 0:
            spread[chunk.firsts[1:] - 1] = 1.0  # an end and the end before the next text
        target = out[d + 1 : d + 1 + len(at)]
        target *= spread
        target += chunk.values(d + 1, "own", at, 0.0)
        context = at
    return out


def _scored(chunks: DataFrame, answers: list[DataFrame], model: Model) -> DataFrame:
    kind = chunks.schema["doc_id"].dataType.elementType.simpleString()
    n_tokens, n_words, levels = model.tree.n_tokens, model.tree.n_words, len(answers) - 1

    def scored(row: dict, chunk: Chunk) -> pa.RecordBatch:
        sizes, counts = _read(row["sizes"]), chunk.counts[chunk.inside]
        root = (chunk.counts + 1) / (n_tokens + n_words + 1)
        probabilities = _probabilities(chunk, root, levels)
        starts = np.cumsum(sizes) - sizes  # no text is without its end
        columns = {
            "doc_id": row["doc_id"],
            "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
            "base_score": pa.array(np.add.reduceat(np.log10(root[chunk.inside]), starts)),
            "score": pa.array(np.add.reduceat(np.log10(probabilities[chunk.inside]), starts)),
        }
        return pa.record_batch(list(columns.values()), list(columns))

    return _each_chunk(chunks, _valued(answers, model), model.buckets, scored, f"doc_id {kind}, {SCORES}")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each text of a table, in logarithms to the base of 10."""
    chunks = _chunked(docs, F.lit(False))
    return _scored(chunks, _levels(chunks, 0, model.buckets, model.sequences), model)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(sampling.fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    All documents are numbered and ask for sequences once, those that are held out without adding to the counts.
    """
    chunks = _chunked(docs, ~held_out(F.col("doc_id")))
    model, answers = _learnt(chunks, DEPTH)
    return _scored(chunks, answers, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tree.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
