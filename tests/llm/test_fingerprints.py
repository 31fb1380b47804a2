from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.shared import ODD_TEXTS, joined, near_copies, shingles
from tillwright.llm import fingerprints, queries


def _jaccard(a: str, b: str) -> float:
    x, y = shingles(a, 5), shingles(b, 5)
    return len(x & y) / len(x | y) if x | y else 1.0


def _check(rows, ordered):
    """ordered: the (doc_id, text) of all documents in their order."""
    after = [t for _, t in ordered[1:]] + [t for _, t in ordered[:1]]
    expected = {}
    for (doc_id, text), other in zip(ordered, after):
        text, other = text or "", other or ""
        half = len(text) // 2
        expected.setdefault(doc_id, []).append((text, text[: len(text) - half] + other[:half], other))
    known, errors = {}, []
    assert len(rows) == len(ordered)
    for row in rows:
        digest = row["edited_sha256"]
        text, changed, other = next(e for e in expected[row["doc_id"]] if hashlib.sha256(e[1].encode()).hexdigest() == digest)
        assert row["n_chars"] == len(text)
        assert known.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert known.setdefault(changed, row["edited_fingerprint"]) == row["edited_fingerprint"]
        errors += [row["near_edited"] - _jaccard(text, changed), row["near_next"] - _jaccard(text, other)]
    if not rows:
        return
    assert np.abs(errors).max() < 0.25
    assert abs(np.mean(errors)) < 0.02


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    _check(queries.op1_fingerprints(spark, SMALL).collect(), sorted(tuple(r) for r in docs))


@pytest.mark.parametrize("texts", [ODD_TEXTS, ["only one text of a few more words than five"], []])
def test_odd_texts(spark, texts):
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs = docs.withColumns({"bucket": F.lit(1), "borrowed": F.lit(2), "head": F.lit(3)})
    _check(fingerprints.successors(docs).collect(), rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "b"), (None, "a"), (1, "c d"), (1, "c d"), (1, "aa"), (2, "e")]
    found = fingerprints.successors(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    _check(found, [(None, "a"), (None, "b"), (1, "aa"), (1, "c d"), (1, "c d"), (2, "e")])


def test_near_copies_are_those_of_all_pairs(spark):
    texts = near_copies() + ODD_TEXTS + [None, "  ", "A  b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("bands", F.lit(1))
    expected = joined([shingles(t, 5) for t in texts], 80)
    found = dict(fingerprints.near_copies(docs).collect())
    assert [found[i] for i in range(len(texts))] == expected
    assert fingerprints.near_copies(docs.limit(0)).count() == 0
