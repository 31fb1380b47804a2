"""One text of several megabytes, and one without any break, beside short ones: whole in every operator."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.shared import alphanumeric, spaced
from tillwright.llm import bpe, contamination, fingerprints, jaccard, lines, quality, repair, spelling, suffixes, toxicity

LONG = "".join(f"word{i % 9973} und Straße {i % 101}.{chr(10) if i % 7 == 0 else ' '}" for i in range(200_000))
UNBROKEN = "x" * 1_000_000
TEXTS = {1: LONG, 2: "short text of a few words", 3: UNBROKEN, 4: None, 5: LONG[:-30]}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_lengths_and_digests(docs):
    assert len(LONG) > 4_000_000
    found = by_id(fingerprints.successors(docs))
    assert {i: r["n_chars"] for i, r in found.items()} == {i: len(t or "") for i, t in TEXTS.items()}
    kept = by_id(lines.report(docs))
    assert kept[1]["n_lines"] == LONG.count("\n") + 1 and kept[3]["n_chars"] == len(UNBROKEN)


def test_words(docs, spark):
    known = by_id(suffixes.report(docs))
    assert {i: r["n_tokens"] for i, r in known.items()} == {i: len(spaced(t)) + 1 for i, t in TEXTS.items()}
    items = spark.createDataFrame([(7, " ".join(alphanumeric(LONG)[-40:-25]))], "item_id bigint, text string")
    found = by_id(contamination.report(docs, items))
    assert {i: r["n_words"] for i, r in found.items()} == {i: len(alphanumeric(t)) for i, t in TEXTS.items()}
    assert found[1]["contaminated"] and not found[2]["contaminated"]
    vocabulary = {r["word"]: r["n"] for r in spelling.report(docs).collect()}
    assert abs(vocabulary["straße"] - 2 * 200_000) <= 2


def test_near_copies(docs):
    found = by_id(jaccard.classes(docs))
    assert found[1]["component_id"] == found[5]["component_id"] == 1
    assert found[3]["n_shingles"] == 1 and found[4]["n_shingles"] == 0
    assert {r["doc_id"]: r["class_id"] for r in fingerprints.near_copies(docs).collect()}[5] == 1


def test_classifiers_and_ids(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in TEXTS], "doc_id bigint, quality int, toxic int")
    for report in (quality.report, toxicity.report):
        assert all(0 <= r["score"] <= 1 for r in report(docs, labels).collect())
    own = by_id(bpe.round_trip(docs.where("doc_id <> 5")))
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    library.no_truncation()
    library.no_padding()
    ids = library.encode(LONG, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    assert (own[1]["n_tokens"], own[1]["decoded_sha256"]) == (len(ids), hashlib.sha256(decoded.encode()).hexdigest())


def test_a_long_conversation(spark):
    """Of 20,000 turns every tenth is missing, and one text has a megabyte."""
    role = F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant")
    text = F.when(F.col("turn") == 11, F.lit("y" * 1_000_000 + ".")).otherwise(F.concat(F.lit("Turn "), "turn", F.lit(".")))
    rows = spark.range(20_000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"))
    rows = rows.where("turn % 10 <> 3").withColumns({"role": role, "text": text})
    found = repair.repaired(rows).orderBy("position").select("role").collect()
    assert [r["role"] for r in found] == ["user", "assistant"] * (len(found) // 2)
    (result,) = repair.parsed(repair._as_is(rows)).collect()
    assert (result["gaps"], result["illegal"], result["cost"]) == (2000, 2000, 2000 * 3)
    assert result["audit"].count("K") == 18_000
