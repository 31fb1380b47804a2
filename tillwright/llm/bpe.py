"""Byte-pair encoding of whole texts with a public vocabulary file, and decoding.

A pre-token is a doubly linked list of symbols. A priority queue holds (merge rank, position) of every adjacent pair
that can merge; the lowest rank merges first, the leftmost among equals, and entries whose pair has changed since
are skipped. Ids are decoded by concatenating the vocabulary's strings with the separator of the file's decoder.

The file's own pipeline is followed: special tokens are cut out of the raw text, the rest is normalised (NFC, white
space runs to one space, lower case), split by the file's pattern and mapped to byte symbols.

Defined results: a null text is an empty one and has no ids; texts of any length are encoded whole; repeated rows
give repeated results; null ids decode to an empty text, null entries of ids are left out.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"

# Pre-tokens whose ids a worker remembers; the memory is emptied when it is full and never changes a result.
REMEMBERED = 600_000

# The split pattern that the codec follows, and the same for characters whose classes are listed.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-zªµºÀ-ÖØ-öø-ɏ]+|[0-9²³¹¼-¾]"
    r"|[^\t-\r \x85\xa0A-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+"
)
UNUSUAL = re.compile(r"[^\x00-ɏ\u2010-\u2027]")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {b: chr(b) for b in own}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(own))
    return [symbols[b] for b in range(256)]


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        kinds = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError(f"{path} has a normaliser or decoder that is not supported")
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"{path} splits words by another pattern")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(re.escape(s) for s in self.special) or r"(?!)")
        self.strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        symbols = _byte_symbols()
        self.bytes_of = {s: b for b, s in enumerate(symbols)}
        self.first = [ids[s] for s in symbols]
        self.last = [ids[s + end] for s in symbols]
        # (left id, right id) as one number -> merge rank; rank -> merged id
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(map(tuple, model["merges"])):
            self.ranks.setdefault(ids[a] << 20 | ids[b], rank)
            self.merged.append(ids[a + b])
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        rank_of, n = self.ranks.get, len(symbols)
        # pairs[i]: the rank at which symbol i merges with the one after it, -1 if it can't or is gone
        pairs = [rank_of(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]
        queue = [rank << 32 | i for i, rank in enumerate(pairs) if rank >= 0]
        if not queue:
            return symbols
        pairs.append(-1)
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push, merged = heapq.heappop, heapq.heappush, self.merged
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if pairs[i] != rank:
                continue  # stale: one of the two symbols has been merged since
            j = after[i]
            symbols[i] = new = merged[rank]
            symbols[j] = pairs[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pairs[i] = rank = rank_of(new << 20 | symbols[k], -1)
                if rank >= 0:
                    push(queue, rank << 32 | i)
            else:
                pairs[i] = -1
            h = before[i]
            if h >= 0:
                pairs[h] = rank = rank_of(symbols[h] << 20 | new, -1)
                if rank >= 0:
                    push(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        data = word.encode(errors="surrogateescape")
        first = self.first
        symbols = [first[b] for b in data[:-1]]
        symbols.append(self.last[data[-1]])
        return self.merge(symbols)

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens.

        White space is never part of one, so that its normalisation is left out. Texts with letters beyond those
        whose classes never change take the library's own normaliser and pattern, whose Unicode version decides.
        """
        plain = unicodedata.normalize("NFC", text).lower()
        if UNUSUAL.search(plain) is None:
            return USUAL_WORDS.findall(plain)
        found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(map(self.bytes_of.__getitem__, piece)).decode(errors="surrogateescape") for piece, _ in found]

    def _plain(self, text: str, out: list[int]) -> None:
        known = self.known
        for word in self.words(text):
            ids = known.get(word)
            if ids is None:
                ids = tuple(self.word(word))
                if len(word) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids
            out += ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        done = 0
        for found in self.cut.finditer(text):
            self._plain(text[done : found.start()], out)
            out.append(self.special[found.group()])
            done = found.end()
        self._plain(text[done:] if done else text, out)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """A file without a decoder puts a space between the strings; ids outside the vocabulary are left out."""
        try:
            return " ".join(map(self.strings.__getitem__, ids))
        except KeyError:
            return " ".join([self.strings[i] for i in ids if i in self.strings])


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, read once by each Python worker."""
    return Codec(path)


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def encode(text: Column, path: str | None = None) -> Column:
    """The ids of a text as array<int>."""
    path = path or vocabulary()

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encode_one = codec(path).encode
        return pa.array((encode_one(t.as_py()) for t in texts), pa.list_(pa.int32()), size=len(texts))

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of ids; the round trip gives the normalised byte symbols, as the file has no decoder."""
    path = path or vocabulary()

    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        decode_one = codec(path).decode
        return pa.array((decode_one([i for i in r.as_py() or () if i is not None]) for r in rows), pa.string())

    return text(ids)


DIGEST = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"


def digests(text: Column, path: str | None = None) -> Column:
    """Number of ids, SHA-256 of the ids as little-endian unsigned 32-bit integers, SHA-256 of the decoded text."""
    path = path or vocabulary()

    @F.arrow_udf(DIGEST)
    def digest(texts: pa.Array) -> pa.Array:
        own = codec(path)
        counts, sums, decoded = [], [], []
        for t in texts:
            ids = own.encode(t.as_py())
            counts.append(len(ids))
            sums.append(hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
            decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digest(text)


def token_counts(text: Column, path: str | None = None) -> Column:
    """The number of ids of a text."""
    path = path or vocabulary()

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        encode_one = codec(path).encode
        return pa.array((len(encode_one(t.as_py())) for t in texts), pa.int64(), size=len(texts))

    return count(text)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the digests of each text's ids and of the text decoded from them."""
    found = docs.select("doc_id", digests(F.col("text"), path).alias("digest"))
    return found.select("doc_id", "digest.*")
