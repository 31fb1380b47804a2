"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    bpe,
    chat,
    contamination,
    counts,
    fingerprints,
    jaccard,
    lines,
    oracles,
    personal,
    quality,
    repair,
    spelling,
    suffixes,
    toxicity,
)
from tillwright.session import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.successors(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(_table(spark, sf_dir, "conversations"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded; then, by the length of their texts, some are deleted, some lose the second half of
    their text, some move to another source; that batch is sent twice; at last some deleted ones come back."""
    docs = _table(spark, sf_dir, "documents").select("source", "lang", "text")
    size = F.coalesce(F.length("text"), F.lit(0)) % 10
    half = F.substring("text", F.lit(1), F.length("text").cast("int") / 2)
    cut, moved = docs.where(size == 2), docs.where(size == 3)
    before = cut.unionByName(moved)
    after = cut.withColumn("text", half).unionByName(moved.withColumn("source", F.concat("source", F.lit("-moved"))))
    rollup = counts.Rollup(spark, new_path(spark, "token_counts"))
    rollup.commit("load", counts.deltas(inserted=docs))
    for _ in range(2):
        rollup.commit("edit", counts.deltas(deleted=docs.where(size == 1), revised=(before, after)))
    rollup.commit("restore", counts.deltas(inserted=docs.where((size == 1) & (F.length("text") % 20 == 1))))
    return rollup.totals()


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(_table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(_table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(_table(spark, sf_dir, "conversations"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_counts": op5_token_counts,
    "op6_bpe": op6_bpe,
    "op7_line_dedup": op7_line_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_repair": op12_repair,
    "op13_lm_scores": op13_lm_scores,
}

ORACLES: dict[str, str] = {
    "op2_chat": oracles.CHAT,
    "op4_jaccard_join": oracles.JACCARD_JOIN,
    "op5_token_counts": oracles.TOKEN_COUNTS,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op10_decontamination": oracles.DECONTAMINATION,
    "op11_spelling_variants": oracles.SPELLING_VARIANTS,
    "op12_repair": oracles.CONVERSATION_REPAIR,
}
