"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. Joins carry no broadcast hints: a side is broadcast only when its
# size, estimated from files or measured by AQE, is below spark.sql.autoBroadcastJoinThreshold. Hot keys
# are split by the AQE skew join, also where that costs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows that lie by one of the join's keys are not shuffled again
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # tables and staged relations take about half the space that they take by default
    "spark.sql.parquet.compression.codec": "zstd",
    # what a query shuffled goes when it has ended, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a scratch folder only on a local master that names none."""
    global _local_dir
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tillwright-")
    return _local_dir


# The folder of the run that a thread is in.
_run: ContextVar[str] = ContextVar("run", default="")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tillwright/{_run.get()}{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, on whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end; relations that read it must have been written by then."""
    own = f"run-{uuid.uuid4().hex}/"
    outer = _run.set(own)
    try:
        yield
    finally:
        _run.reset(outer)
        remove_folder(spark, f"{shared_dir(spark)}/tillwright/{own}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a relation that several later steps read, and go on from the written files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Independent tables written at the same time, so that the tail of one job does not leave a cluster idle.
WRITERS = 4


def together(jobs: Iterable[Callable[[], object]]) -> list[object]:
    """Run independent Spark jobs side by side; the first failure is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return [running.result() for running in [pool.submit(copy_context().run, job) for job in jobs]]


def stage_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    written = together([lambda df=df, name=name: stage(df, name) for name, df in frames.items()])
    return dict(zip(frames, written))
