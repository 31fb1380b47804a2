"""A training-data pipeline over documents: each stage is written and read again as the next one's documents."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import bpe, contamination, jaccard, lines, quality
from tillwright.llm.linkage import Rule
from tillwright.session import configure, stage

# The rule of op4's query is that query's contract; near copies are dropped by five words and 80 %.
COPIES = Rule(size=5, percent=80)


def configured(function):
    """A stage may be called by itself, in a session that nothing has configured."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(configure(spark), docs, sf_dir)

    return run


@configured
def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@configured
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that another document, or an earlier place, has as well go; n_chars follows the text."""
    return lines.clean(docs)


@configured
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their shingles the one with the smallest id stays."""
    return jaccard.distinct(docs, COPIES)


@configured
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@configured
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document: their number, their digest, and that of the text decoded from them."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("n-gram jaccard join", drop_copies),
    ("benchmark decontamination", decontaminate),
    ("bpe encoding and decoding", encode),
]

# The quality classifier is trained; its decisions can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_").replace("-", "_"))
    return docs
