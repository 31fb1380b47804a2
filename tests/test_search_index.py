"""Search in stored postings finds what a search of the texts finds, before and after documents change."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwright.operators import search_index
from tillwright.operators.search import search
from tillwright.plans import pipeline
from tillwright.session import new_path
from tillwright.sources.tables import Tables

SCHEMA = "doc_id string, doc_text string, kind string"
QUESTIONS = {1: "pen ink", 2: "w3 w4 absent", 3: "Größe?", 4: "absent"}


def documents(spark, seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Pen", "ink", "größe"]
    rows = [(f"d{i}", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))), rng.choice("ab")) for i in range(n)]
    return spark.createDataFrame([*rows, ("null", None, "a"), ("empty", "", None)], SCHEMA)


@pytest.fixture
def tables(spark):
    return Tables(spark, new_path(spark, "warehouse"))


def check(tables, docs):
    for filters in (None, {"kind": "b"}):
        found = search_index.search(tables, QUESTIONS, filters, k=4).orderBy("qid", "rank").collect()
        assert found == search(docs, QUESTIONS, filters, k=4).orderBy("qid", "rank").collect()


def test_build_and_refresh(spark, tables):
    first, second = documents(spark, 1), documents(spark, 1, 40).unionByName(documents(spark, 2).where("doc_id in ('d50', 'd51')"))
    search_index.build(tables, first, ["kind"])
    check(tables, first)
    assert search_index.refresh(tables, first, ["kind"]) == 0
    assert search_index.refresh(tables, second, ["kind"]) == 20
    check(tables, second)
    moved = second.withColumn("kind", F.when(F.col("doc_id") == "d3", "c").otherwise(F.col("kind")))
    assert search_index.refresh(tables, moved, ["kind"]) == 1
    check(tables, moved)
    assert search_index.refresh(tables, first.limit(0), ["kind"]) == moved.count() - moved.where("doc_text is null").count()
    assert search_index.search(tables, QUESTIONS).count() == 0


def test_only_changed_documents_are_taken_apart(spark, tables, monkeypatch):
    first = documents(spark, 1)
    other = F.when(F.col("doc_id") == "d7", "pen pen").otherwise(F.col("doc_text"))
    second = first.where("doc_id <> 'd8'").withColumn("doc_text", other).union(spark.createDataFrame([("d99", "new ink", "b")], SCHEMA))
    search_index.build(tables, first, ["kind"])
    seen, lengths = [], search_index._lengths
    monkeypatch.setattr(search_index, "_lengths", lambda docs, *more: seen.extend(docs.collect()) or lengths(docs, *more))
    assert search_index.refresh(tables, second, ["kind"]) == 3
    assert sorted(row["doc_id"] for row in seen) == ["d7", "d99"]
    check(tables, second)


def test_a_refresh_that_broke_off_is_made_up_for(spark, tables, monkeypatch):
    first, second = documents(spark, 1), documents(spark, 3)
    search_index.build(tables, first, ["kind"])
    replace = Tables.replace_parts

    def broken(self, name, *more):
        if name == search_index.LENGTHS:
            raise RuntimeError("lost")
        replace(self, name, *more)

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(Tables, "replace_parts", broken)
        search_index.refresh(tables, second, ["kind"])
    search_index.refresh(tables, second, ["kind"])
    check(tables, second)


def test_a_search_reads_the_parts_and_rows_of_its_words(spark, tables):
    search_index.build(tables, documents(spark, 1), ["kind"])
    plan = search_index.hits(tables, ["w3"])._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "EqualTo(word,w3)" in scan and "PartitionFilters: []" not in scan


def test_documents_keep_their_time_and_their_files(spark, tables):
    columns = [F.lit("product").alias("doc_type"), *[F.lit(None).cast("string").alias(c) for c in ("product_id", "vendor_id", "region")]]
    of = lambda n, text="same": spark.range(n).select(F.concat(F.lit("p"), "id").alias("doc_id"), *columns, F.concat(F.lit(text), "id").alias("doc_text"))
    times = lambda: dict(tables.read("rag_documents").select("doc_id", "updated_at").collect())
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(tables.path("rag_documents")).rglob("*.parquet")}
    pipeline.put_documents(tables, of(50), datetime(2024, 1, 1))
    before = files()
    pipeline.put_documents(tables, of(50), datetime(2024, 1, 2))
    assert files() == before
    changed = of(49).where("doc_id <> 'p7'").unionByName(of(8, "other").where("doc_id = 'p7'"))
    pipeline.put_documents(tables, changed, datetime(2024, 1, 3))
    expected = {f"p{i}": datetime(2024, 1, 3 if i == 7 else 1) for i in range(49)}
    assert times() == expected
    assert 0 < len(files().items() & before.items()) < len(before)
    # an attribute changes: the document keeps its time
    pipeline.put_documents(tables, changed.withColumn("region", F.lit("East")), datetime(2024, 1, 4))
    assert times() == expected
    assert tables.read("rag_documents").where("region = 'East'").count() == 49


def test_texts_are_compared_as_bytes(spark, tables, monkeypatch):
    row = ("p1", "product", "text", None, None, None)
    of = spark.createDataFrame([row], "doc_id string, doc_type string, doc_text string, product_id string, vendor_id string, region string")
    pipeline.put_documents(tables, of)
    seen, differing = [], pipeline._differing
    monkeypatch.setattr(pipeline, "_differing", lambda *rows: seen.extend(rows[:2]) or differing(*rows))
    pipeline.put_documents(tables, of)
    assert [dict(rows.dtypes)["text"] for rows in seen] == ["binary", "binary"]


def test_words_are_counted_before_they_are_shuffled(spark):
    rows = [("a", "x", "pen pen ink"), ("a", "x", "pen ink ink"), (None, "x", "pen"), (None, None, "Pen, ink"), ("b", "y", None), ("c", "y", " ")]
    documents = spark.createDataFrame(rows, "doc_id string, kind string, doc_text string")
    found = search_index._postings(documents, ["kind"], "doc_id", "doc_text")
    assert sorted([tuple(r) for r in found.select("word", "doc_id", "kind", "length", "n").collect()], key=str) == sorted(
        [("pen", "a", "x", 3, 3), ("ink", "a", "x", 3, 3), ("pen", None, "x", 1, 1), ("pen", None, None, 2, 1), ("ink", None, None, 2, 1)],
        key=str,
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and "hashpartitioning(word" not in plan
