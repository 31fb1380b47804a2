"""Parquet tables under one warehouse folder.

A replaced table is written beside the old one and put in its place when it is whole. Tables that change by key lie in
parts, folders by a hash of the key, of which only the changed ones are replaced. What a broken run left half done is
put right by the next write, or by a read that finds the table missing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime
from math import gcd

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import remove_folder
from tillwright.sources.files import timestamp


BATCH = "batch_id"
PART = "hash_part"

# Rows of a part, and the least and largest number of parts of a table.
PART_ROWS = 1_000_000
LEAST_PARTS, MOST_PARTS = 8, 4096


def number_of_parts(rows: int) -> int:
    """A power of two, fixed when a table is written whole."""
    wanted = max(LEAST_PARTS, min(MOST_PARTS, -(-rows // PART_ROWS)))
    return 1 << (wanted - 1).bit_length()


def part_of(key: Column, parts: int) -> Column:
    """The name of a key's part, which tells the number of parts as well.

    The hash is the one that Spark shuffles rows by, so that rows joined by the key lie in few parts per task.
    """
    return F.concat(F.pmod(F.hash(key), F.lit(parts)).cast("string"), F.lit(f"_of_{parts}"))


# Parts by that hash; a table without this folder has others, or none, and is written whole.
EMPTY_PART = f"{PART}=empty_of_"

# Rows that lie by the key are shuffled to their parts once more if a task would have rows of more parts.
PARTS_OF_A_TASK = 16


# What rows get after they were shuffled to their parts.
Finish = Callable[[DataFrame], DataFrame]


class Tables:
    """A table fed by a stream holds one folder per micro-batch; a repeated batch replaces its own folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame | None:
        """None for a table that was never written; with ``parts`` only those folders are read."""
        path = self.path(name)
        try:
            rows = self.spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            if not self._restore(path):
                return None
            rows = self.spark.read.parquet(path)
        if parts is not None:
            rows = rows.where(F.col(PART).isin(*parts))
        return rows.drop(BATCH, PART)

    def stored(self, names: list[str]) -> dict[str, DataFrame]:
        found = {name: self.read(name) for name in names}
        return {name: df for name, df in found.items() if df is not None}

    def replace(
        self, name: str, rows: DataFrame, key: str | None = None, parts: int = 0, finish: Finish | None = None,
        lying: bool = False,
    ) -> None:
        """Put rows in the place of a table, with a ``key`` in parts; readers find the old rows until it is written.

        Rows that come from a join or sums by the key are ``lying``: they are not shuffled to their parts once more.
        """
        beside = f"{self.path(name)}.new-{uuid.uuid4().hex}"
        self._written(rows, key, parts, finish, lying).parquet(beside)
        if key is not None:  # a part without rows keeps the columns of a table that has none
            (finish(rows) if finish else rows).limit(0).write.parquet(f"{beside}/{EMPTY_PART}{parts}")
        self._swap(beside, self.path(name))

    def _rows_by_part(self, rows: DataFrame, key: str, parts: int, lying: bool) -> DataFrame:
        keyed = rows.withColumn(PART, part_of(F.col(key), parts))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if not lying or parts // gcd(parts, tasks) > PARTS_OF_A_TASK:
            # rows of a part come together, in several tasks where they are many
            keyed = keyed.hint("rebalance", F.col(PART))
        # within a file rows are in order of the key, so that a reader of few keys skips most of it
        return keyed.sortWithinPartitions(PART, key)

    def _written(self, rows: DataFrame, key: str | None, parts: int, finish: Finish | None = None, lying: bool = False):
        if key is None:
            return rows.write
        keyed = self._rows_by_part(rows, key, parts, lying)
        return (finish(keyed) if finish else keyed).write.partitionBy(PART)

    def parts(self, name: str) -> int | None:
        """The number of parts that a table was written in, None for a table without parts."""
        folders = [f for f in self._folders(self.path(name)) if f.startswith(EMPTY_PART)]
        return int(folders[0].removeprefix(EMPTY_PART)) if folders else None

    def batches(self, name: str) -> list[int]:
        """The numbered micro-batches that a stream has written to a table."""
        found = [f.removeprefix(f"{BATCH}=") for f in self._folders(self.path(name)) if f.startswith(f"{BATCH}=")]
        return [int(number) for number in found if number.isdigit()]

    def append_parts(
        self, name: str, rows: DataFrame, key: str, parts: int, finish: Finish | None = None, lying: bool = False
    ) -> None:
        self._written(rows, key, parts, finish, lying).mode("append").parquet(self.path(name))

    def replace_parts(
        self, name: str, rows: DataFrame, key: str, parts: int, changed: Iterable[str], finish: Finish | None = None
    ) -> None:
        """Put rows in the place of the changed parts; a part without rows goes, the files of others stay.

        All rows must belong to the changed parts. Parts that a broken run had set aside are put back before.
        """
        root = self.path(name)
        for folder in self._folders(f"{root}.old-parts"):
            self._swap_back(f"{root}.old-parts/{folder}", f"{root}/{folder}")
        beside = f"{root}.new-{uuid.uuid4().hex}"
        self._written(rows, key, parts, finish).parquet(beside)
        written = set(self._folders(beside))
        for part in sorted(changed):
            folder = f"{PART}={part}"
            aside = f"{root}.old-parts/{folder}"
            self._make(f"{root}.old-parts")
            self._rename(f"{root}/{folder}", aside)
            if folder in written:
                self._rename(f"{beside}/{folder}", f"{root}/{folder}")
            remove_folder(self.spark, aside)
        remove_folder(self.spark, beside)

    def _path(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        found, system = self._path(path)
        return system.exists(found)

    def _make(self, path: str) -> None:
        found, system = self._path(path)
        system.mkdirs(found)

    def _folders(self, path: str) -> list[str]:
        found, system = self._path(path)
        if not system.exists(found):
            return []
        return [f.getPath().getName() for f in system.listStatus(found) if f.isDirectory()]

    def file_count(self, name: str) -> int:
        """Data files directly in a table's folder."""
        found, system = self._path(self.path(name))
        return len([f for f in system.listStatus(found) if f.getPath().getName().startswith("part-")])

    def _rename(self, path: str, to: str) -> None:
        """A folder that is not there is left alone."""
        (found, system), (target, _) = self._path(path), self._path(to)
        if system.exists(found) and not system.rename(found, target):
            raise OSError(f"{path} can't be renamed to {to}")

    def _swap(self, beside: str, path: str) -> None:
        old = f"{path}.old"
        if self._exists(path):
            remove_folder(self.spark, old)
        self._rename(path, old)
        self._rename(beside, path)
        remove_folder(self.spark, old)

    def _swap_back(self, aside: str, path: str) -> None:
        """A folder set aside goes back unless its successor is there."""
        if self._exists(path):
            remove_folder(self.spark, aside)
        else:
            self._rename(aside, path)

    def _restore(self, path: str) -> bool:
        """Whether a table that is missing was found set aside, by a run that broke off between two renames."""
        if self._exists(path) or not self._exists(f"{path}.old"):
            return False
        self._rename(f"{path}.old", path)
        return True

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path(name))

    def put_batch(self, name: str, rows: DataFrame, batch_id: int | str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path(name)}/{BATCH}={batch_id}")

    def drop(self, name: str) -> None:
        """Remove a table's folder; a table that was never written is no error."""
        for path in (self.path(name), f"{self.path(name)}.old", f"{self.path(name)}.old-parts"):
            remove_folder(self.spark, path)

    def append_newer(self, name: str, rows: DataFrame) -> None:
        """Append the rows loaded after the newest row of the target."""
        self.append(name, newer(rows, watermark(self.read(name))))


def watermark(target: DataFrame | None) -> datetime | None:
    """Newest load timestamp; None for a target that is missing or empty, which then takes every row."""
    return None if target is None else target.agg(F.max("_load_timestamp")).first()[0]


def newer(rows: DataFrame, mark: datetime | None) -> DataFrame:
    """Strictly newer rows; the mark is a literal, so the filter reaches the file scan."""
    return rows if mark is None else rows.where(F.col("_load_timestamp") > timestamp(mark))
