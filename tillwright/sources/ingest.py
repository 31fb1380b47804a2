"""Loading source files into the landing tables, in full or only the files not loaded before.

Which files a warehouse holds is told from a small table of loaded files. A load notes its time before it lands
anything, and its files afterwards: a load that broke off in between is found by its time, and only its rows are
looked up in the landing tables. Files are rows of tables throughout, from the listing to the report; after many loads
the notes are written together again.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.session import stage, together
from tillwright.sources import files
from tillwright.sources.landing import LANDING_SCHEMA
from tillwright.sources.tables import Tables

REPORT_SCHEMA = "entity string, source_file string, status string, message string"
REPORT_COLUMNS = ("entity", "source_file", "status", "message")
MODES = ("full", "incremental")

LOADED_FILES = "loaded_files"
LOADED_SCHEMA = "entity string, source_file string, _load_timestamp timestamp_ntz"
LOADS_STARTED = "loads_started"
STARTED_SCHEMA = "_load_timestamp timestamp_ntz"


def landing_name(entity: str) -> str:
    return f"landing_{entity}"


def ingest(
    spark: SparkSession,
    source_root: str,
    tables: Tables,
    mode: str = "full",
    load_time: datetime | None = None,
    routes: Mapping[str, str] = files.ROUTES,
    multiline: bool = False,
) -> DataFrame:
    """Land the files below ``source_root`` and report on each of them.

    ``full`` empties the landing tables and loads every file; ``incremental`` skips files loaded before, also
    those without rows. All rows of one call carry one load timestamp.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    listed = files.routed(files.list_files(spark, source_root), routes)
    if mode == "full":
        # without the table of files, a run after a broken one tells them from the landing tables
        forget_loads(tables)
        for entity in fv.ENTITIES:
            tables.replace(landing_name(entity), spark.createDataFrame([], LANDING_SCHEMA))
    new = missing(tables, listed)
    moment = load_time or files.now()
    found = {r["entity"] for r in new.select("entity").distinct().collect()}
    if found:
        start(tables, moment)
    status, message = ("warning", "no files found") if mode == "full" else ("skipped", "no new files")
    parts = [spark.createDataFrame([(e, None, status, message) for e in fv.ENTITIES if e not in found], REPORT_SCHEMA)]
    parts += land_all(new, sorted(found), source_root, tables, moment, multiline)
    entries = reduce(DataFrame.unionByName, [part.select(*REPORT_COLUMNS) for part in parts])
    if found:
        record(tables, moment, entries)
    return _with_counts(entries, tables, moment)


def land_all(
    new: DataFrame, entities: list[str], source_root: str, tables: Tables, moment: datetime, multiline: bool = False
) -> list[DataFrame]:
    """Load the files of several entities, a table of (path, source_file, entity), side by side."""
    of = {entity: new.where(F.col("entity") == entity) for entity in entities}
    return together([lambda e=e, own=own: land(e, own, source_root, tables, moment, multiline) for e, own in of.items()])


def land(
    entity: str, new: DataFrame, source_root: str, tables: Tables, moment: datetime, multiline: bool = False
) -> DataFrame:
    """Load one entity's files, a table of (path, source_file), and report (path, entity, source_file, status, message).

    Files are read together in one write. If that fails, each half of them is tried, and so on, so that only the
    bad ones are left out.
    """
    kind = fv.FILE_ROUTES[entity][1]
    judged = stage(_judged(new, kind), "new_files")
    good = judged.where("status = 'loaded'")

    def write(chosen: DataFrame) -> DataFrame | None:
        """The files that turn out to hold something else."""
        read = stage(files.read_json(chosen), "objects") if kind == "json" else files.read_csv(chosen, multiline)
        bad = None
        if kind == "json":
            bad = stage(read.where("raw_data is null").select("path").distinct(), "bad_files")
            read = read.join(bad, "path", "left_anti")
        landed = read.select(
            "raw_data",
            files.source_file(F.col("path"), source_root).alias("_source_file"),
            files.timestamp(moment).alias("_load_timestamp"),
        )
        tables.append(landing_name(entity), landed)
        return bad

    def tried(chosen: DataFrame, bit: int = 0) -> list[DataFrame]:
        """The outcome of files that are no longer as judged."""
        if chosen.isEmpty():
            return []
        try:
            bad = write(chosen)
            return [] if bad is None else [bad.withColumn("why", F.lit("holds something else than JSON objects"))]
        except files.SPARK_ERRORS as error:
            if bit == 64 or chosen.count() == 1:
                return [chosen.select("path", F.lit(str(error).splitlines()[0]).alias("why"))]
        half = F.shiftright(F.xxhash64("path"), bit).bitwiseAND(1)
        return tried(chosen.where(half == 0), bit + 1) + tried(chosen.where(half == 1), bit + 1)

    failed = tried(good)
    if failed:
        judged = judged.join(reduce(DataFrame.unionByName, failed), "path", "left").withColumns(
            {
                "status": F.when(F.col("why").isNotNull(), "error").otherwise(F.col("status")),
                "message": F.coalesce("why", "message"),
            }
        )
    return stage(judged.select("path", F.lit(entity).alias("entity"), "source_file", "status", "message"), "landed_files")


def _judged(new: DataFrame, kind: str) -> DataFrame:
    """The files with what a CSV header tells of them: names, and the status that they will have if they can be read."""
    if kind == "json":
        none = F.lit(None).cast("string")
        return new.select("path", "source_file", F.lit("loaded").alias("status"), none.alias("message"))
    known = new.join(files.with_names(files.headers(new)), "path", "left")
    unread = F.col("names").isNull()
    empty = ~F.exists("names", lambda name: name != "")
    twice = F.size(F.array_distinct("names")) < F.size("names")
    status = F.when(unread, "error").when(empty, "warning").when(twice, "error").otherwise("loaded")
    message = F.when(unread, "cannot be read").when(empty, "no columns").when(twice, "a column name occurs twice")
    return known.select("path", "source_file", "names", status.alias("status"), message.alias("message"))


def forget_loads(tables: Tables) -> None:
    for name in (LOADED_FILES, LOADS_STARTED):
        tables.drop(name)


def start(tables: Tables, moment: datetime) -> None:
    """Note that a load begins, before it lands anything."""
    _note(tables, LOADS_STARTED, tables.spark.createDataFrame([(moment,)], STARTED_SCHEMA))


def record(tables: Tables, moment: datetime, entries: DataFrame) -> None:
    """Note the files of a load that has ended; the row without a file ends a load that landed none."""
    rows = entries.where("status = 'loaded'").select("entity", "source_file", files.timestamp(moment).alias("_load_timestamp"))
    _note(tables, LOADED_FILES, rows.unionByName(_ends(tables, [moment])))


def _ends(tables: Tables, moments: list[datetime]) -> DataFrame:
    return tables.spark.createDataFrame([(None, None, moment) for moment in moments], LOADED_SCHEMA)


# A table of notes with more files is written together again.
NOTE_FILES = 64


def _note(tables: Tables, name: str, rows: DataFrame) -> None:
    tables.append(name, rows.coalesce(1))
    if tables.file_count(name) > NOTE_FILES:
        tables.replace(name, tables.read(name).hint("rebalance"))


def missing(tables: Tables, listed: DataFrame) -> DataFrame:
    """Of the listed (path, source_file, entity) those that were not loaded."""
    return stage(listed.join(_loaded(tables), ["entity", "source_file"], "left_anti"), "missing_files")


def _loaded(tables: Tables) -> DataFrame:
    """The table of loaded files, with the files of loads that broke off added to it."""
    if tables.read(LOADED_FILES) is None:
        tables.replace(LOADED_FILES, _landed(tables))
    started = tables.read(LOADS_STARTED)
    if started is not None:
        ended = tables.read(LOADED_FILES).select("_load_timestamp")
        broken = [r[0] for r in started.join(ended, "_load_timestamp", "left_anti").distinct().collect()]
        if broken:
            _note(tables, LOADED_FILES, _landed(tables, broken).unionByName(_ends(tables, broken)))
    return tables.read(LOADED_FILES).select("entity", "source_file")


def _landed(tables: Tables, moments: list[datetime] | None = None) -> DataFrame:
    """The files that the landing tables hold rows of, of all loads or of those at some times."""
    found = tables.spark.createDataFrame([], LOADED_SCHEMA)
    for entity in fv.ENTITIES:
        landed = tables.read(landing_name(entity))
        if landed is not None:
            if moments is not None:
                landed = landed.where(F.col("_load_timestamp").isin(*[files.timestamp(m) for m in moments]))
            names = landed.groupBy(F.col("_source_file").alias("source_file")).agg(
                F.max("_load_timestamp").alias("_load_timestamp")
            )
            found = found.unionByName(names.select(F.lit(entity).alias("entity"), "source_file", "_load_timestamp"))
    return found


def _with_counts(report: DataFrame, tables: Tables, moment: datetime) -> DataFrame:
    """Add the number of rows each file brought in this load."""
    counts = tables.spark.createDataFrame([], "entity string, source_file string, row_count bigint")
    for entity in fv.ENTITIES:
        landed = tables.read(landing_name(entity))
        if landed is not None:
            fresh = landed.where(F.col("_load_timestamp") == files.timestamp(moment))
            counts = counts.unionByName(
                fresh.groupBy(F.lit(entity).alias("entity"), F.col("_source_file").alias("source_file")).agg(
                    F.count("*").alias("row_count")
                )
            )
    return report.join(counts, ["entity", "source_file"], "left").select(
        "entity", "source_file", "status", F.coalesce("row_count", F.lit(0)).alias("row_count"), "message"
    )


def totals(report: DataFrame) -> DataFrame:
    """Rows loaded per entity, and over all with a NULL entity."""
    per_entity = report.groupBy("entity").agg(F.sum("row_count").alias("row_count"))
    return per_entity.unionByName(report.agg(F.lit(None).cast("string").alias("entity"), F.sum("row_count").alias("row_count")))


def row_counts(tables: Tables) -> DataFrame:
    """Rows of every landing table."""
    counts = tables.spark.createDataFrame([], "entity string, row_count bigint")
    for entity in fv.ENTITIES:
        landed = tables.read(landing_name(entity))
        if landed is not None:
            counts = counts.unionByName(landed.agg(F.lit(entity).alias("entity"), F.count("*").alias("row_count")))
    return counts
