"""Spelling variants: a bit-sliced position index over blocks of the vocabulary.

Two words are near if one inserted, deleted or replaced letter makes one the other. For a block of words the index holds
a bitset over the words for each position and letter. All words of the block are looked up at once: letter by letter,
word-parallel recurrences keep the set of words that agree so far without an error, and those with one error, where an
inserted or deleted letter shifts the position that is compared.

Blocks are made of groups that must share letters. With m letters in the shorter word of a near pair, the pair shares
its first x or its last m - x letters, for any x; a word therefore joins a group by its first half and one by its last
half, for m its own length and one less. A group of more than BLOCK words is parted again in the same way, over the
letters that aren't shared yet, until a single letter is left, where the alphabet bounds it. A pair that two groups
share is taken in the first of them. So each pair is found once, and no group grows with the vocabulary.

Defined results: a null text has no words, a null id counts as an empty one; rows of one id count as they are; words of
any length are whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stage

RUN = re.compile("[a-zÀ-ÿ]+")
DAMAGED = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
# A form is so many times as frequent as its variant.
TIMES = 5

# Words that are compared with each other at once.
BLOCK = 1024
# Different words that a task counts before it hands them on.
COUNTED = 1 << 18


def counted(docs: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, n): runs of letters of all texts, of which a hash of id and run picks some to lose a letter."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.record_batch(columns, ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                lowered = text.encode().lower().decode()  # A to Z alone
                for word, n in Counter(map(re.Match.group, RUN.finditer(lowered))).items():
                    if len(word) >= least_letters:
                        hashed = zlib.crc32(word.encode(), start)
                        if hashed % DAMAGED == 0:
                            at = hashed % len(word)
                            word = word[:at] + word[at + 1 :]
                        found[word] += n
                if len(found) >= COUNTED:
                    yield out()
        if found:
            yield out()

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInArrow(words, "word string, n bigint")
    return rows.where(F.length("word") >= least_letters).groupBy("word").agg(F.sum("n").alias("n"))


_GROUP = ["m", "a", "b", "shared"]


def _shared(word: Column, a: Column, b: Column) -> Column:
    """The first a and the last b letters; a and b tell where they part."""
    return F.concat(F.substring(word, F.lit(1), a), F.right(word, b))


def _halves() -> Column:
    """The two parts of a group: half of its m - a - b free letters are shared as well, at the front or at the back."""
    a, b, free = F.col("a"), F.col("b"), F.col("m") - F.col("a") - F.col("b")
    half = F.floor(free / 2).cast("int")
    parts = [(a + half, b), (a, b + free - half)]
    return F.array(*[F.struct(x.alias("a"), y.alias("b"), _shared(F.col("word"), x, y).alias("shared")) for x, y in parts])


def _parted(rows: DataFrame, parts: Column) -> DataFrame:
    return rows.select("word", "n", "m", F.explode(parts).alias("part")).select("word", "n", "m", "part.*")


def groups(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, m, a, b, shared): a row for each group of each word; (m, a, b, shared) is the group."""
    length = F.length("word")
    lengths = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where("m > 0")
    lengths = lengths.withColumns({"a": F.lit(0), "b": F.lit(0), "shared": F.lit("")})
    rows = _parted(lengths.where("m > 1"), _halves()).unionByName(lengths.where("m = 1"))
    done = []
    while True:
        rows = stage(rows, "groups")
        large = rows.groupBy(_GROUP).count().where((F.col("count") > block) & (F.expr("m - a - b") > 1))
        large = stage(large.select(*_GROUP, F.lit(True).alias("large")), "large_groups")
        if large.isEmpty():
            done.append(rows)
            break
        marked = stage(rows.join(large, _GROUP, "left"), "marked_groups")
        done.append(marked.where(F.col("large").isNull()).drop("large"))
        rows = _parted(marked.where("large"), _halves())
    out = done[0]
    for further in done[1:]:
        out = out.unionByName(further)
    return out


def _bitsets(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as bitsets of 64-bit words."""
    packed = np.packbits(rows, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class Index:
    """Bitsets over the words of a block for each position and letter; words have m or m + 1 letters."""

    def __init__(self, words: list[str], m: int):
        self.m, self.lengths = m, np.array([len(w) for w in words])
        padded = "".join(w if len(w) > m else w + "\0" for w in words)
        points = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), m + 1)
        letters, codes = np.unique(points, return_inverse=True)
        self.codes, self.size = codes.reshape(points.shape), len(letters)
        self.tables: dict[int, np.ndarray] = {}
        self.of_length = {n: _bitsets((self.lengths == n)[None])[0] for n in (m, m + 1)}

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the set of words that have it at the position."""
        if position not in self.tables:
            for old in [p for p in self.tables if p < position - 2]:
                del self.tables[old]
            self.tables[position] = _bitsets(self.codes[:, position] == np.arange(self.size)[:, None])
        return self.tables[position][letters]

    def longer_or_equal(self, rows: np.ndarray, among: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """For words of m letters the near words of m and of m + 1 letters, among a set for each word.

        A longer word that has the word's first cut letters is left out where cut < m + 1.
        """
        exact, replaced, inserted, left_out = among.copy(), *np.zeros((3, *among.shape), np.uint64)
        for i in range(self.m):
            left_out[cut == i] = exact[cut == i]
            letters = self.codes[rows, i]
            here = self.having(i, letters)
            inserted = (inserted | exact) & self.having(i + 1, letters)
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
        return (replaced & self.of_length[self.m]) | ((inserted | exact) & self.of_length[self.m + 1] & ~left_out)

    def shorter(self, rows: np.ndarray, among: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """For words of m + 1 letters the near words of m letters, less those that have the word's first cut letters."""
        exact, deleted, left_out = among.copy(), *np.zeros((2, *among.shape), np.uint64)
        for i in range(self.m + 1):
            left_out[cut == i] = exact[cut == i]
            letters = self.codes[rows, i]
            before = exact
            deleted = (deleted & self.having(i - 1, letters) if i else deleted) | before
            exact = exact & self.having(i, letters)
        return deleted & self.of_length[self.m] & ~left_out


def near(words: list[str], counts: list[int], group: np.ndarray, b: np.ndarray, m: int) -> Iterator[tuple[str, int, str, int]]:
    """(word, near words, the most frequent of them, its count) of each word with near words in its own group.

    The words of a group have m or m + 1 letters, of which the last b are shared.
    """
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    words, counts = [words[i] for i in order], [counts[i] for i in order]
    group, b = group[order], b[order]
    index = Index(words, m)
    together = _bitsets(group == np.arange(group.max() + 1)[:, None])
    # a pair that also shares its first m - b letters is taken in the group of those
    cut = np.where(b > 0, m - b, m + 2)
    for length, look_up in ((m, index.longer_or_equal), (m + 1, index.shorter)):
        rows = np.flatnonzero(index.lengths == length)
        if not len(rows):
            continue
        found = look_up(rows, together[group[rows]], cut[rows])
        number = np.bitwise_count(found).sum(axis=1)
        for k in np.flatnonzero(number).tolist():
            word = int(np.flatnonzero(found[k])[0])
            best = 64 * word + (int(found[k, word]) & -int(found[k, word])).bit_length() - 1
            yield words[rows[k]], int(number[k]), words[best], counts[best]


def pairs(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, form, form_n) of each word with near words, for each of its groups."""
    rows = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> pa.RecordBatch:
            words, counts, m, b, group = ([r[k] for r in held] for k in range(5))
            group = np.unique(group, return_inverse=True)[1]
            found = list(near(words, counts, group, np.array(b), m[0]))
            names, kinds = ["word", "near", "form", "form_n"], [pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*found) if found else [[]] * 4
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        held: list[tuple] = []  # whole groups of one m, and the group that is being read
        current, number, whole = None, 0, 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("word", "n", *_GROUP)]
            for word, n, *key in zip(*columns):
                if key != current:
                    if len(held) - whole == 1:
                        held.pop()  # a word alone in its group
                    if held and (key[0] != current[0] or len(held) >= block):
                        yield out(held)
                        held = []
                    current, number, whole = key, number + 1, len(held)
                held.append((word, n, key[0], key[2], number))
        if len(held) > 1:
            yield out(held)

    return rows.mapInArrow(looked_up, "word string, near bigint, form string, form_n bigint")


def variants(words: DataFrame, block: int = BLOCK, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary of distinct (word, n)."""
    found = pairs(groups(words, block), block).groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("best"),
    )
    kept = -F.col("best.less") >= times * F.col("n")
    forms = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(kept, F.col("best.form")).alias("form"),
        F.when(kept, -F.col("best.less")).alias("form_n"),
    )
    forms = stage(forms, "forms")
    roots = _roots(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    joined = forms.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of links, whose covered length doubles in each round.

    A form is `times` as frequent as its variant, so chains have no circles and grow with the logarithm of the counts.
    """
    while True:
        ahead = links.select(F.col("word").alias("passed"), F.col("root").alias("further"))
        links = links.join(ahead, F.col("root") == F.col("passed"), "left")
        links = stage(links.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if links.where(F.col("further").isNotNull()).isEmpty():
            return links.drop("further")
        links = links.drop("further")


def report(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words that occur often enough."""
    return variants(stage(counted(docs).where(F.col("n") >= LEAST_COUNT), "vocabulary"))
