from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, differences
from tests.conftest import SMALL
from tests.llm.shared import ODD_TEXTS, documents, joined, shingles
from tests.llm.test_lines import _plain
from tillwright.llm import bpe, contamination, queries
from tillwright.session import stage


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit("extra"))
    texts = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SMALL), name.replace(" ", "_"))
        texts.append(docs)
    rows = [{r["doc_id"]: r["text"] for r in t.collect()} for t in texts[:-1]]
    assert all(t.columns == texts[0].columns for t in texts[:-1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = [i in rows[1] for i in rows[0] if labels.get(i) == 1]
    assert sum(kept) >= 0.95 * len(kept)
    assert {i: [t] for i, t in rows[2].items()} == _plain(list(rows[1].items()))
    ids = sorted(rows[2])
    component = joined([shingles(rows[2][i], 5) for i in ids], 80)
    assert sorted(rows[3]) == [i for k, i in enumerate(ids) if component[k] == k]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    searchers = contamination.build((str(i), t, True) for i, t in items)
    clean = [i for i in rows[3] if not next(contamination.search(pa.array([rows[3][i]], pa.string()), searchers))["items"]]
    assert sorted(rows[4]) == sorted(clean)
    own = bpe.codec(bpe.vocabulary())
    assert {r["doc_id"]: r["n_tokens"] for r in texts[-1].collect()} == {i: len(own.encode(t)) for i, t in rows[4].items()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name]) is None


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SMALL)
        assert docs.count() == 0


def test_near_copies_by_five_words_and_80_percent(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)] + [" ".join(base + [f"x{k}_{i}" for i in range(n)]) for k, n in enumerate([36, 44, 60])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    component = joined([shingles(t, 5) for t in texts], 80)
    assert component == [0, 0, 0, 3] and joined([shingles(t, 4) for t in texts], 85) == [0, 1, 2, 3]
    kept = corpus_pipeline.drop_copies(spark, docs, SMALL).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(component))


def test_stages_with_odd_documents(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, extra columns, and labels of none or of one kind."""
    docs = documents(spark, ODD_TEXTS * 2).withColumns({c: F.lit(1) for c in ("id", "kept", "found", "gone", "score", "label")})
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = stage(function(spark, docs, str(tmp_path)), "odd")
        assert kept.columns == docs.columns
        assert (kept.count() == rows) == (name != "n-gram jaccard join")
    encoded = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert encoded.count() == rows


def test_what_a_stage_shuffled_goes_with_its_query(spark):
    def shuffled() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs = documents(spark, [(i, " ".join(f"w{i % 7}x{k}" for k in range(20))) for i in range(50)])
    spark.conf.set(setting, "false")  # a stage configures the session that it is called in
    copies = dict(corpus_pipeline.STAGES)["n-gram jaccard join"](spark, docs, SMALL)
    before = shuffled()
    kept = stage(copies, "kept")
    assert not shuffled() - before
    assert kept.count() == 7
    assert copies.count() == 7 and len(copies.collect()) == len(copies.collect()) == 7
    assert spark.conf.get(setting) == "true"
