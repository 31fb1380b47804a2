from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.shared import DOCUMENT, ODD_TEXTS, documents
from tillwright.llm import queries, spelling


def _words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def _near(word, vocabulary, letters):
    """All words of the vocabulary at one edit, by making every edit."""
    made = {word[:i] + word[i + 1 :] for i in range(len(word))}
    made |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    made |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return (made - {word}) & vocabulary.keys()


def _plain(vocabulary):
    letters = set("".join(vocabulary))
    forms, number = {}, {}
    for word, n in vocabulary.items():
        around = _near(word, vocabulary, letters)
        number[word] = len(around)
        best = min(around, key=lambda w: (-vocabulary[w], w), default=None)
        forms[word] = best if best is not None and vocabulary[best] >= 5 * n else None
    rows = []
    for word, n in vocabulary.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        rows.append((word, form, root, n, number[word], vocabulary.get(form)))
    return sorted(rows)


def _check(found, vocabulary):
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in found.collect()) == _plain(vocabulary)


@pytest.mark.parametrize("block", [1, 3, 20, spelling.BLOCK])
def test_variants_are_those_of_all_edits(spark, block):
    """A crowd of words over few letters, so that groups are parted down to single letters."""
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 5, 6, 7, 8]))) for _ in range(500)}
    words |= {"x" * n for n in range(1, 12)} | {"stammering" + "ab"[i % 2] * i for i in range(70)}
    vocabulary = {w: rng.choice([5, 6, 7, 30, 40, 900]) for w in words}
    rows = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    _check(spelling.variants(rows, block), vocabulary)


def test_chains_lead_to_their_last_form(spark):
    vocabulary = {"a" * (6 + k): 5**k * 5 for k in range(9)}
    found = spelling.variants(spark.createDataFrame(list(vocabulary.items()), "word string, n bigint"))
    _check(found, vocabulary)
    assert {r["root"] for r in found.collect()} == {"a" * 14}


def test_odd_texts(spark):
    texts = ODD_TEXTS + ["ÀÉîöÿ× straße Straße", "naïveté " * 9, "naivete " * 60, "naïvete " * 50, "ǅungla ſtraße ŉ"] + ["Twice over"] * 8
    docs = documents(spark, texts).withColumns({c: F.lit(1) for c in ("word", "n", "id", "m", "shared")})
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _check(spelling.report(docs), _words(rows))


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    _check(queries.op11_spelling_variants(spark, SMALL), _words(docs))


def test_empty_table(spark):
    assert spelling.report(spark.createDataFrame([], DOCUMENT)).count() == 0
