"""Token counts: totals by source, language and tokenizer version, kept by signed deltas.

A batch of changes becomes one signed row per group: inserted documents count plus, deleted ones minus, revised ones
minus as they were and plus as they are. Totals are the sums of all committed deltas, so that nothing is counted
twice or recounted. A batch is committed once: each attempt writes its deltas to a folder of its own, then the ledger
takes the batch and the attempt; a repeated commit finds the batch and does nothing, and an attempt that the ledger
doesn't name doesn't count. Many attempts are folded into one by a further ledger entry, so that totals are read from
few folders. One writer at a time: two that commit the same batch at the same moment would both enter it.

Defined results: a null text has no tokens but its document counts; null sources and languages are groups; every row
is a document, also a repeated one; groups whose documents and tokens are both zero are left out; an empty batch is
committed and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import bpe

# Patterns of the native tokenizers, in a form that reads alike in other engines.
WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"[A-Za-z]+|[0-9]{1,3}|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


# Tokenizer version -> count of a text.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {"words@1": _matches(WORDS), "pieces@1": _matches(PIECES)}
BPE_TOKENIZER: dict[str, Callable[[Column], Column]] = {"word_bpe_49k@1": bpe.token_counts}

GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, attempt string"
# An entry without a batch folds other attempts into its own.
LEDGER = "batch string, attempt string, folded array<string>"


def signed(docs: DataFrame, sign: int, tokenizers: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """A row of (source, lang, tokenizer, n_docs, n_tokens) for each document and tokenizer, all of one sign."""
    counted = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.array(*[F.struct(F.lit(k).alias("tokenizer"), f(F.col("text")).alias("n")) for k, f in tokenizers.items()])
        .alias("counts"),
    )
    rows = counted.select("source", "lang", F.explode("counts").alias("c"))
    return rows.select(
        "source",
        "lang",
        "c.tokenizer",
        F.lit(sign).cast("bigint").alias("n_docs"),
        (F.col("c.n") * sign).alias("n_tokens"),
    )


def deltas(
    inserted: DataFrame | None = None,
    deleted: DataFrame | None = None,
    revised: tuple[DataFrame, DataFrame] | None = None,
    tokenizers: Mapping[str, Callable[[Column], Column]] = TOKENIZERS,
) -> DataFrame:
    """The signed group rows of a batch; revised: the documents as they were, and as they are."""
    before, after = revised or (None, None)
    parts = [(inserted, 1), (deleted, -1), (before, -1), (after, 1)]
    rows = [signed(docs, sign, tokenizers) for docs, sign in parts if docs is not None]
    if not rows:
        raise ValueError("a batch needs at least one table of changes")
    together = rows[0]
    for more in rows[1:]:
        together = together.unionByName(more)
    return _sums(together)


def _sums(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.where("n_docs <> 0 OR n_tokens <> 0")


class Rollup:
    """Totals in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.ledger = spark, f"{path}/deltas", f"{path}/ledger"
        spark.createDataFrame([], SCHEMA).write.mode("ignore").partitionBy("attempt").parquet(self.deltas)
        spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(self.ledger)

    def _ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.ledger)

    def committed(self, batch: str) -> bool:
        return not self._ledger().where(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of deltas; False if it is already there."""
        if self.committed(batch):
            return False
        self._enter(batch, changes, [])
        return True

    def _enter(self, batch: str | None, rows: DataFrame, folded: list[str]) -> None:
        attempt = uuid.uuid4().hex
        rows.select(*GROUP, "n_docs", "n_tokens").write.parquet(f"{self.deltas}/attempt={attempt}")
        entry = self.spark.createDataFrame([(batch, attempt, folded)], LEDGER)
        entry.coalesce(1).write.mode("append").parquet(self.ledger)

    def _live(self) -> DataFrame:
        """The attempts that count: those of the ledger that are not folded into another one."""
        ledger = self._ledger()
        folded = ledger.select(F.explode("folded").alias("attempt"))
        return ledger.select("attempt").distinct().join(folded, "attempt", "left_anti")

    def fold(self) -> int:
        """Replace all attempts that count by one that holds their sums; their number. Old folders stay, unread."""
        attempts = [r["attempt"] for r in self._live().collect()]
        if len(attempts) > 1:
            self._enter(None, self.totals(), attempts)
        return len(attempts)

    def totals(self) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(self.deltas)
        return _sums(rows.join(self._live(), "attempt", "left_semi"))
