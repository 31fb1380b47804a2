from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.shared import DOCUMENT, ODD_TEXTS, spaced
from tillwright.llm import queries, suffixes

END = object()


def _held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Plain:
    """The tree as dictionaries of tuples of tokens."""

    def __init__(self, texts, depth=suffixes.DEPTH):
        texts = [[END, *spaced(t), END] for t in texts]
        self.counts = Counter(w for t in texts for w in t[1:])
        self.total = sum(self.counts.values())
        least = max(suffixes.LEAST_COUNT, math.ceil(suffixes.LEAST_SHARE * self.total))
        self.states = {}
        for d in range(1, depth + 1):
            sequences = Counter(tuple(t[i : i + d + 1]) for t in texts for i in range(len(t) - d))
            contexts = Counter(tuple(t[i : i + d]) for t in texts for i in range(len(t) - d))
            children = {}
            for key, n in sequences.items():
                if n >= least:
                    children.setdefault(key[:-1], {})[key[-1]] = n
            grown = {}
            for context, own in children.items():
                n = contexts[context]
                parents = {w: self.probability(context[1:], w) for w in own}
                gain = sum(c * math.log(c / n / parents[w]) for w, c in own.items())
                left, parent_left = n - sum(own.values()), 1 - sum(parents.values())
                if left > 0 and parent_left > 0:
                    gain += left * math.log(left / n / parent_left)
                if gain >= len(own) * math.log(self.total) / 2:
                    grown[context] = (n, own)
            self.states |= grown

    def probability(self, context, word) -> float:
        for k in range(len(context)):
            state = self.states.get(tuple(context[k:]))
            if state:
                n, own = state
                spread = 1 - sum(c - suffixes.DISCOUNT for c in own.values()) / n
                mine = (own[word] - suffixes.DISCOUNT) / n if word in own else 0.0
                return mine + spread * self.probability(context[k + 1 :], word)
        return (self.counts[word] + 1) / (self.total + len(self.counts) + 1)

    def scores(self, text):
        tokens = [END, *spaced(text), END]
        base = sum(math.log10((self.counts[w] + 1) / (self.total + len(self.counts) + 1)) for w in tokens[1:])
        context = lambda i: tokens[max(0, i - suffixes.DEPTH) : i]
        score = sum(math.log10(self.probability(context(i), tokens[i])) for i in range(1, len(tokens)))
        return len(tokens) - 1, sum(self.counts[w] > 0 for w in tokens[1:]), self.total, base, score


def _check(rows, docs):
    plain = Plain([t for i, t in docs if not _held_out(i)])
    expected = sorted(((i is not None, i or 0, _held_out(i), *plain.scores(t)) for i, t in docs), key=lambda r: r[:5] + r[6:])
    found = sorted(((r[0] is not None, r[0] or 0, *tuple(r)[1:]) for r in rows), key=lambda r: r[:5] + r[6:])
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:6] == b[:6]
        assert a[6:] == pytest.approx(b[6:], rel=1e-9)
    return plain


def _texts(seed=2, n=120):
    rng = random.Random(seed)
    phrases = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 6))) for _ in range(25)]
    texts = [" ".join(rng.choice(phrases) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    return texts + ODD_TEXTS + [texts[0]] * 20 + ["", None, "END end"]


@pytest.mark.parametrize("chunk", [suffixes.CHUNK_TOKENS, 300])
def test_scores_are_those_of_the_plain_tree(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffixes, "CHUNK_TOKENS", chunk)
    rows = [(None if i % 31 == 30 else i % 150, t) for i, t in enumerate(_texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs = docs.withColumns({c: F.lit(1) for c in ("word", "n", "chunk", "number", "tokens")})
    plain = _check(suffixes.report(docs).collect(), rows)
    assert {len(c) for c in plain.states} == {1, 2, 3}


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op13_lm_scores(spark, SMALL).collect()
    _check(rows, docs)
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_probabilities_of_a_state_sum_to_one(spark):
    texts = [t for t in _texts(5, 60) if t]
    model = suffixes.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    plain = Plain(texts)
    assert sum(int(s.sum()) for s in model.tree.states) == len(plain.states) > 3
    for state in list(plain.states)[:20]:
        known = sum(plain.probability(state, w) for w in plain.counts)
        assert known + plain.probability(state, "never seen") == pytest.approx(1)


def test_numbers_are_packed_and_unpacked():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 1 << 30, 5])
    data, size = suffixes._packed(numbers)
    assert suffixes._unpacked(data).tolist() == numbers.tolist()
    assert size.tolist() == [1, 1, 1, 2, 2, 3, 3, 4, 5, 1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCUMENT)
    assert suffixes.report(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in suffixes.score(docs, suffixes.train(empty)).collect()}
    assert (rows[1]["n_tokens"], rows[1]["n_known"], rows[1]["score"]) == (3, 0, 0.0)
    assert rows[2]["n_tokens"] == 1


def test_a_long_text(spark):
    text = "tick tock " * 300_000
    rows = suffixes.report(spark.createDataFrame([(1, text), (2, "tick tock")], "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 600_001, 2: 3}


def test_rare_sequences_of_a_large_corpus_count(spark):
    filler = "tick tock " * 1_050_000
    learnt = [i for i in range(30) if not _held_out(i)][:11]
    docs = [(learnt[0], filler), *[(i, "alpha beta gamma delta") for i in learnt[1:]]]
    rows = suffixes.report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    plain = _check(rows, docs)
    assert plain.total * 5e-6 > plain.counts["alpha"] >= suffixes.LEAST_COUNT
    assert any(context[-1] == "alpha" for context in plain.states)
