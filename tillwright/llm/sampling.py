"""Labelled documents to fit a model on, all or a bounded sample, and the folds that labels may be learnt from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id has no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _usable(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(id, label) outside the held-out fold; of an id that is labelled twice the smallest label."""
    usable = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out)
    )
    return usable.groupBy("id").agg(F.min("label").alias("label"))


def _one_text(rows: DataFrame) -> DataFrame:
    """Of the rows of one id the one whose text has the smallest hash."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy("id", "label").agg(least).select(F.col("id").alias("doc_id"), "least.text", "label")


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, text, label) of all labelled documents outside the held-out fold, a row for each id."""
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return _one_text(texts.join(_usable(labels, label, folds, held_out), "id"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int
) -> DataFrame:
    """(doc_id, text, label) of at most `per_class` documents of each class outside the held-out fold.

    Of the labels that have a document, those with the smallest hash of their id are taken, so that the sample does not
    depend on the order of rows. A document that is labelled twice takes the smallest label; of the rows of one id the
    one whose text has the smallest hash is taken.
    """
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    usable = _usable(labels, label, folds, held_out).join(texts.select("id"), "id", "left_semi")
    chosen = None
    for value in (0, 1):
        some = usable.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * per_class ids
    return _one_text(texts.join(F.broadcast(chosen), "id"))
