from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.shared import ODD_TEXTS, documents, spaced
from tillwright.llm import bpe, counts
from tillwright.session import new_path


def _rows(df):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in df.collect()}


@pytest.fixture
def rollup(spark):
    return counts.Rollup(spark, new_path(spark, "rollup_test"))


def test_batches_equal_a_recount_and_commit_once(spark, rollup):
    docs = documents(spark, ODD_TEXTS)
    short = F.length(F.coalesce("text", F.lit(""))) < 5
    revised = docs.where(~short)
    after = revised.withColumn("text", F.concat("text", F.lit(" more words"))).withColumn("source", F.lit("new"))
    assert rollup.commit("one", counts.deltas(inserted=docs))
    assert not rollup.commit("one", counts.deltas(inserted=docs))
    edit = counts.deltas(deleted=docs.where(short), revised=(revised, after))
    assert rollup.commit("two", edit)
    assert not rollup.commit("two", edit)
    assert _rows(rollup.totals()) == _rows(counts.deltas(inserted=after))
    words = sum(len(spaced(r["text"])) for r in after.collect())
    assert sum(v[1] for k, v in _rows(rollup.totals()).items() if k[2] == "words@1") == words


@pytest.mark.parametrize("n", [0, 5])
def test_an_interrupted_commit_counts_nothing_and_is_replaced(spark, rollup, monkeypatch, n):
    """Also if the batch turns out to be empty when it is sent again."""
    docs = documents(spark, ODD_TEXTS)
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(spark, "createDataFrame", _lost)
        rollup.commit("one", counts.deltas(inserted=docs.limit(3)))
    assert rollup.totals().count() == 0 and not rollup.committed("one")
    assert rollup.commit("one", counts.deltas(inserted=docs.limit(n)))
    assert _rows(rollup.totals()) == _rows(counts.deltas(inserted=docs.limit(n)))


def _lost(*_):
    raise RuntimeError("lost before the ledger was written")


def test_folded_attempts_keep_totals_and_batches(spark, rollup):
    docs = documents(spark, ODD_TEXTS)
    for i in range(4):
        rollup.commit(str(i), counts.deltas(inserted=docs) if i % 2 == 0 else counts.deltas(deleted=docs.limit(4)))
    before = _rows(rollup.totals())
    assert rollup.fold() == 4 and rollup.fold() == 1
    assert _rows(rollup.totals()) == before
    assert not rollup.commit("2", counts.deltas(inserted=docs))
    assert rollup.commit("4", counts.deltas(inserted=docs.limit(4))) and rollup.fold() == 2
    assert sum(v[0] for v in _rows(rollup.totals()).values()) == sum(v[0] for v in before.values()) + 2 * docs.limit(4).count()


def test_bpe_counts_and_empty_batches(spark, rollup):
    docs = documents(spark, ODD_TEXTS).withColumns({"tokenizer": F.lit("x"), "n_docs": F.lit(9), "counts": F.lit(1)})
    rows = _rows(counts.deltas(inserted=docs, tokenizers=counts.BPE_TOKENIZER))
    own = bpe.codec(bpe.vocabulary())
    assert sum(v[1] for v in rows.values()) == sum(len(own.encode(t)) for t in ODD_TEXTS)
    assert rollup.commit("none", counts.deltas(inserted=docs.limit(0)))
    assert rollup.totals().count() == 0
    with pytest.raises(ValueError):
        counts.deltas()
