"""Words and shingles of whole Arrow text columns as 64-bit hashes, in numpy and in bounded slices.

A null text is an empty one. Words are runs of word bytes of the UTF-8 text; every byte from 0x80 on is a word
byte, so that a letter outside ASCII is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and what each byte counts as."""

    is_word: np.ndarray
    fold: np.ndarray

    @property
    def values(self) -> np.ndarray:
        return _BYTE_VALUES[self.fold]


def _alphabet(is_word) -> Alphabet:
    fold = np.arange(256, dtype=np.uint8)
    fold[ord("A") : ord("Z") + 1] += 32
    return Alphabet(np.array([bool(is_word(int(fold[b]))) for b in range(256)]), fold)


# Runs without ASCII white space.
SPACED = _alphabet(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
# Runs of ASCII letters, ASCII digits and everything outside ASCII.
ALPHANUMERIC = _alphabet(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        back = np.full(size, _INVERSE, dtype=np.uint64)
        back[0] = 1
        _powers, _inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _powers[:n], _inverses[:n]


@dataclass(frozen=True)
class Words:
    """Words of consecutive texts: word i is data[starts[i]:ends[i]], text t has words bounds[t]:bounds[t + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def column(array) -> pa.Array:
    """A text column as one Arrow array of large strings."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_string())
    return array.cast(pa.large_string()).fill_null("")


def raw(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets of the texts in them."""
    array = column(array)
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of consecutive texts with at most SLICE_BYTES bytes, or of one longer text."""
    data, offsets = raw(array)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def split_words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    """The words of consecutive texts; long texts are hashed piece by piece, cut between words."""
    n = len(data)
    if n <= 2 * SLICE_BYTES:
        return _split_words(data, offsets, alphabet)
    parts, a = [], 0
    while a < n:
        b = min(n, a + SLICE_BYTES)
        while b < n:  # on to the next byte that is in no word
            ahead = alphabet.is_word[data[b : b + SLICE_BYTES]]
            if not ahead.all():
                b += int(ahead.argmin())
                break
            b = min(n, b + SLICE_BYTES)
        inner = offsets[(offsets > a) & (offsets < b)]
        part = _split_words(data[a:b], np.concatenate([[a], inner, [b]]) - a, alphabet)
        parts.append((part.starts + a, part.ends + a, part.hashes))
        a = b
    starts, ends, hashes = (np.concatenate(column) for column in zip(*parts))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def _split_words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = alphabet.is_word[data]
    change = inside[1:] != inside[:-1]
    edges = np.flatnonzero(change)
    starts, ends = edges[0::2], edges[1::2]
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a word that touches the next text's first word
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, starts, ends, np.zeros(0, np.uint64), bounds)
    powers, inverses = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(alphabet.values[data] * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64) * np.uint64(_ODD))
    return Words(data, starts, ends, hashes, bounds)


def prefix_hashes(words: Words, alphabet: Alphabet, length: int) -> np.ndarray:
    """A hash of the first `length` bytes of each word."""
    out = np.empty(len(words.starts), np.uint64)
    ends = np.minimum(words.ends, words.starts + length)
    cuts = np.flatnonzero(np.diff(words.starts // SLICE_BYTES)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(out)]):
        if a == b:
            continue
        first = words.starts[a]
        data = words.data[first : ends[b - 1]]
        powers, inverses = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(alphabet.values[data] * powers[: len(data)], out=sums[1:])
        x, y = words.starts[a:b] - first, ends[a:b] - first
        out[a:b] = mix((sums[y] - sums[x]) * inverses[x] + np.uint64(length))
    return out


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` consecutive entries; entry i belongs to entries i to i + size - 1."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for j in range(1, size):
        total *= _SHINGLE
        total += hashes[j : j + n]
    return mix(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, repeats included, and the texts' bounds in them.

    A text of fewer than `size` words has its whole sequence as its only shingle, a text without words has none.
    """
    counts = words.counts
    number = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(number)])
    rolled = windows(words.hashes, size)
    out = np.empty(bounds[-1], dtype=np.uint64)
    whole = counts >= size
    if whole.any():
        kept = np.repeat(whole, number)
        first = np.repeat(words.bounds[:-1] - bounds[:-1], number) + np.arange(bounds[-1])
        out[kept] = rolled[first[kept]]
    for t in np.flatnonzero((counts > 0) & ~whole):
        own = words.hashes[words.bounds[t] : words.bounds[t + 1]]
        out[bounds[t]] = mix(windows(own, len(own)) + np.uint64(len(own)))[0]
    return out, bounds


def shingle_sets(array, size: int, alphabet: Alphabet = SPACED) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in slices(array):
        hashes, bounds = shingles(split_words(data, offsets, alphabet), size)
        for t in range(len(bounds) - 1):
            yield np.unique(hashes[bounds[t] : bounds[t + 1]])
