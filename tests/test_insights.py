from __future__ import annotations

import json
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwright import fixed_values as fv
from tillwright.catalogue import QUERIES, mart
from tillwright.functions.completion import complete
from tillwright.operators.search import search
from tillwright.plans import insights, metrics, semantic


def test_completion_model(spark):
    rows = spark.createDataFrame([("hi",), (None,)], "prompt string")

    def shout(prompts: pd.Series) -> pd.Series:
        return prompts.str.upper()

    assert [r[0] for r in rows.select(complete(F.col("prompt"), shout)).collect()] == ["HI", None]
    assert [r[0] for r in rows.select(complete(F.col("prompt"))).collect()] == ["Draft for 2 characters: hi", None]


def test_flagged_customers(spark):
    flagged = insights.flagged_return_customers(mart(spark, SMALL), company="Acme").collect()
    assert flagged and all(r["anomaly_score"] >= fv.ANOMALY_FLAG_SCORE for r in flagged)
    assert all("for Acme." in r["prompt"] and r["investigation_brief"].endswith(r["prompt"]) for r in flagged)


def test_scores_without_thresholds(spark):
    """No customers, no quartiles, no points from them."""
    history = metrics.mv_customer_return_history(mart(spark, SMALL)).where("false")
    assert insights.anomaly_thresholds(history) == {
        "total_returns": None, "total_refund_value": None, "avg_refund_per_return": None}
    assert insights.anomaly_scores(history, insights.anomaly_thresholds(history)).count() == 0


def test_each_vendor_has_a_document(spark):
    m = mart(spark, SMALL)
    texts = [r["kpi_data"] for r in insights._vendor_documents(metrics.mv_return_rate_by_vendor(m)).collect()]
    names = sorted(json.loads(t)["vendor"] for t in texts)
    assert names == sorted(r["vendor_name"] for r in metrics.mv_return_rate_by_vendor(m).collect())


def documents(spark, texts):
    cells = [(f"d{i:04}", "vendor", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(cells, "doc_id string, doc_type string, doc_text string").repartition(8)


def test_context_is_cut_and_counted(spark):
    texts = [f"return {i:05} " + "x" * (i % 7) for i in range(2000)] + [None]
    found = {r["qid"]: r for r in insights.rag_context(documents(spark, texts)).collect()}
    assert found[2]["documents"] == " | ".join(t for t in texts if t)[:3000]
    assert found[2]["retrieved_count"] == 5 and found[4]["documents"] == found[2]["documents"]
    assert found[1]["documents"] is None and found[1]["retrieved_count"] == 0


def test_shortest_documents_fill_the_context(spark):
    texts = ["r" for _ in range(1500)]
    found = {r["qid"]: r["documents"] for r in insights.rag_context(documents(spark, texts)).collect()}
    assert found[2] == " | ".join(texts)[:3000]


def test_empty_texts_before_others(spark):
    """Documents without text still bring a separator each, and the others follow."""
    texts = [""] * 900 + ["return"] * 500
    found = {r["qid"]: r["documents"] for r in insights.rag_context(documents(spark, texts)).collect()}
    assert found[2] == " | ".join(texts)[:3000]


def test_search_keeps_letters_of_all_scripts(spark):
    docs = documents(spark, ["die Größe zählt", "размер важен", "gr e"])
    found = search(docs, {1: "Größe", 2: "РАЗМЕР"}, k=2).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["doc_id"]) for r in found] == [(1, "d0000"), (2, "d0001")]


def test_few_documents(spark):
    found = {r["qid"]: r for r in insights.rag_context(documents(spark, ["a return", "b", None])).collect()}
    assert (found[2]["documents"], found[2]["retrieved_count"]) == ("a return | b", 3)
    assert (found[4]["documents"], found[4]["retrieved_count"]) == ("a return", 1)


def test_search_filter_and_order(spark):
    docs = documents(spark, ["pen and ink", "ink ink ink", "paper", "", None, "PEN!"])
    found = search(docs, {1: "Pen?", 2: "ink paper", 3: "absent"}, k=2).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["doc_id"]) for r in found] == [(1, "d0005"), (1, "d0000"), (2, "d0002"), (2, "d0001")]
    assert search(docs, {1: "pen"}, filters={"doc_type": "product"}).count() == 0


def test_star_needs_a_declared_join(spark):
    m = mart(spark, SMALL)
    with pytest.raises(ValueError):
        semantic.star(m, "fact_returns", {"dim_products": ["brand"]})
    with pytest.raises(ValueError):
        semantic.star(m, "fact_sales", {"dim_customers": ["customer_id"]})
    assert semantic.star(m, "fact_sales", {"dim_customers": ["region"]}).count() == m.fact_sales.count()


def test_whole_quality_report_against_plain_python(spark):
    """Every sample text and every prompt, from all quarantined rows."""
    own = mart(spark, SMALL)
    rejected = own.rejected_records.select("source_table", "affected_field", "issue_type", "record_key", "record_data").collect()
    totals = {r["entity"]: r["bronze_count"] for r in own.pipeline_audit_log.collect()}
    groups = {}
    for r in rejected:
        groups.setdefault((r[0].replace("clean_", ""), r[1], r[2]), []).append((r[3], r[4]))
    found = {(r["entity"], r["affected_field"], r["issue_type"]): r for r in QUERIES["dq_audit_report"](spark, SMALL).collect()}
    assert found.keys() == groups.keys() and len(found) > 10
    for (entity, field, issue), records in groups.items():
        row = found[entity, field, issue]
        records.sort(key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1].encode()))
        samples = " | ".join(text for _, text in records[:3])
        rate = (Decimal(100 * len(records)) / totals[entity]).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert (row["rejected_count"], row["total_entity_records"], row["sample_records"]) == (len(records), totals[entity], samples)
        assert row["rejection_rate_pct"] == float(rate)
        facts = f"Entity: {entity}. Field: {field}. Issue: {issue}. Rejected: {len(records)} out of {totals[entity]} records ({rate}%)."
        assert row["prompt"] == fv.QUALITY_PROMPT.split("Entity: ")[0].format(company=insights.COMPANY) + f"{facts} Samples: {samples}"
        assert row["prompt"] in row["ai_explanation"]
