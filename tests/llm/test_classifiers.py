from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from tests.llm.shared import ODD_TEXTS, documents
from tillwright.llm import quality, queries, sampling, toxicity


def _check(rows, folds, held_out, labels, column, least):
    good = []
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % folds == held_out)
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.7)
        if row["held_out"] and row["doc_id"] in labels:
            good.append(row["predicted"] == labels[row["doc_id"]][column])
    assert len(good) > 50
    assert np.mean(good) >= least


@pytest.mark.parametrize(
    ("query", "folds", "held_out", "column", "least"),
    [(queries.op3_quality, 4, 2, "quality", 0.97), (queries.op9_toxicity, 3, 1, "toxic", 0.85)],
)
def test_held_out_accuracy(spark, query, folds, held_out, column, least):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = query(spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    _check(rows, folds, held_out, labels, column, least)


def test_scores_do_not_depend_on_other_columns_or_held_out_labels(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "score": F.lit(1), "label": F.lit(0)})
    one = {r["doc_id"]: r["score"] for r in quality.report(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in quality.report(moved, other).collect()}
    assert one == two


@pytest.mark.parametrize(("report", "column"), [(quality.report, "quality"), (toxicity.report, "toxic")])
def test_odd_texts_and_missing_labels(spark, report, column):
    docs = documents(spark, ODD_TEXTS * 2)
    labels = [(i, i % 2) for i in range(len(ODD_TEXTS))] + [(0, 1), (3, None), (None, 1), (999, 1)]
    some = spark.createDataFrame(labels, f"doc_id bigint, {column} int")
    for table in (some, some.where(f"{column} = 1"), some.limit(0)):
        rows = report(docs, table).collect()
        assert len(rows) == 2 * len(ODD_TEXTS)
        assert all(0 <= r["score"] <= 1 for r in rows)
    expected = 1.0 if column == "quality" else 0.0
    assert {r["score"] for r in rows} == {expected}
    assert report(docs.limit(0), some).count() == 0


def test_interactions_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    size = quality.BUCKETS + quality.STATISTICS
    machine = quality.Machine(
        0.5,
        rng.standard_normal(size).astype(np.float32),
        rng.standard_normal((size, quality.FACTORS)).astype(np.float32),
        np.zeros(quality.STATISTICS, np.float32),
        np.ones(quality.STATISTICS, np.float32),
    )
    x = quality.Features(np.array([3, 9, 3]), np.array([0.5, 2, 1], np.float32), np.array([0, 2, 3, 3]), rng.standard_normal((3, quality.STATISTICS)).astype(np.float32))
    for row, logit in enumerate(machine.logits(x)):
        own = slice(x.bounds[row], x.bounds[row + 1])
        index = np.concatenate([x.buckets[own], quality.BUCKETS + np.arange(quality.STATISTICS)])
        value = np.concatenate([x.values[own], x.statistics[row]])
        expected = machine.bias + machine.linear[index] @ value
        for i in range(len(index)):
            for j in range(i):
                expected += machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j]
        assert logit == pytest.approx(expected, rel=1e-3, abs=1e-2)


def test_largest_responses_are_those_of_each_window():
    rng = np.random.default_rng(2)
    widths, filters, width = toxicity.FILTER_WIDTHS, toxicity.FILTERS, toxicity.WIDTH
    net = toxicity.Network(
        rng.standard_normal((toxicity.BUCKETS, width)).astype(np.float32),
        rng.standard_normal((toxicity.BUCKETS, width)).astype(np.float32),
        [rng.standard_normal((w, width, filters)).astype(np.float32) for w in widths],
        rng.standard_normal(len(widths) * filters).astype(np.float32),
        rng.standard_normal(len(widths) * filters).astype(np.float32),
    )
    x = toxicity.Texts(rng.integers(0, 99, 9), rng.integers(0, 99, 9), np.array([0, 4, 4, 5, 9]))
    best, _ = net.responses(x)
    for t in range(4):
        own = [net.words[x.words[p]] + net.prefixes[x.prefixes[p]] for p in range(x.bounds[t], x.bounds[t + 1])]
        for k, w in enumerate(widths):
            for f in range(filters):
                found = [sum(own[i + j] @ net.filters[k][j][:, f] for j in range(w) if i + j < len(own)) for i in range(len(own))]
                expected = max([0.0, *(v + net.shift[k * filters + f] for v in found)])
                assert best[t, k * filters + f] == pytest.approx(expected, rel=1e-4, abs=1e-4)


def test_threshold_parts_the_labels():
    assert toxicity.threshold(np.array([3.0, -1, 0, 5]), np.array([1, 0, 0, 1])) == 1.5
    # one stray toxic text far below doesn't let the clean ones pass for toxic
    logits = np.concatenate([[-9.0], np.linspace(-5, -1, 50), np.linspace(2, 4, 8)])
    assert toxicity.threshold(logits, np.array([1] + [0] * 50 + [1] * 8)) == 0.5
    # no cut between equal logits
    assert toxicity.threshold(np.array([0.0, 1, 1, 2]), np.array([0, 0, 1, 1])) in (0.5, 1.5)


def test_sample_holds_a_row_per_id_and_no_labels_without_a_document(spark):
    ids = list(range(40))
    docs = spark.createDataFrame([(i, f"text {i} {k}") for i in ids for k in range(30 if i < 20 else 1)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(2000)], "doc_id bigint, quality int")
    rows = sampling.labelled_sample(docs, labels, "quality", 4, 2, 5).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 10
    assert all(r["label"] == r["doc_id"] % 2 and r["text"].startswith(f"text {r['doc_id']} ") for r in rows)
    again = sampling.labelled_sample(docs.repartition(7), labels, "quality", 4, 2, 5).collect()
    assert sorted(rows) == sorted(again)


def test_responses_in_blocks_are_those_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(3)
    bounds = np.cumsum([0, 5, 0, 1, 300, 2, 0, 40, 1])
    words, prefixes = (rng.integers(0, 50, bounds[-1]).astype(np.int32) for _ in range(2))
    x = toxicity.Texts(words, prefixes, bounds)
    net = toxicity.fit(x, np.array([0, 1, 0, 1, 1, 0, 1, 0], dtype=np.float32), epochs=1)
    net.training = True
    whole = net.responses(x)
    for size in (1, 3, 7, 64):
        monkeypatch.setattr(toxicity, "BLOCK_WORDS", size)
        best, where = net.responses(x)
        assert np.allclose(best, whole[0], atol=1e-5)
        assert (where == whole[1]).all()


def test_all_labelled_documents_are_learnt_from(spark):
    """More than the 4,000 of a class that were once taken."""
    ids = spark.range(9000)
    docs = ids.selectExpr("id as doc_id", "concat('text ', id) as text")
    docs = docs.unionByName(docs.where("doc_id < 20").selectExpr("doc_id", "'zzz' as text"))
    labels = ids.selectExpr("id as doc_id", "0 as toxic").unionByName(ids.selectExpr("id + 9000 as doc_id", "1 as toxic"))
    rows = sampling.labelled(docs, labels, "toxic", toxicity.FOLDS, toxicity.HELD_OUT).collect()
    usable = {i for i in range(9000) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT}
    assert len(usable) > 4000
    assert len(rows) == len(usable) and {r["doc_id"] for r in rows} == usable


def test_shards_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 512)
    large = MEDIUM.replace("sf0.01", "sf0.1")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    docs, known = (spark.read.parquet(f"{large}/{name}.parquet") for name in ("documents", "labels"))
    _check(toxicity.report(docs, known).collect(), 3, 1, labels, "toxic", 0.85)


def test_shards_come_one_after_the_other():
    shards = pa.array([0, 0, 2, 2, 2, 5], pa.int32())
    whole = pa.record_batch([shards, pa.array(range(6))], ["shard", "n"])
    for size in (1, 2, 4, 6):
        batches = iter([whole.slice(a, size) for a in range(0, 6, size)])
        assert [(s, t["n"].to_pylist()) for s, t in toxicity._shards(batches)] == [(0, [0, 1]), (2, [2, 3, 4]), (5, [5])]
