"""Regional files to landed objects: CSV with a header of its own per file, JSON objects in any layout."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping
from datetime import datetime, timezone

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.parsing import one_of
from tillwright.session import stage
from tillwright.sources import json_objects

SPARK_ERRORS = (PySparkException, Py4JJavaError)

# The path of a row's file, spelled as in a file listing; Spark hands it out percent-encoded.
PATH_SQL = "url_decode(replace(_metadata.file_path, '+', '%2B')) as path"

ROUTES = {entity: pattern for entity, (pattern, _) in fv.FILE_ROUTES.items()}


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def timestamp(moment: datetime) -> Column:
    """Zone-less literal, whatever the session time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def source_file(path: Column, root: str) -> Column:
    """Path below the source root, which the listing may show with or without a scheme."""
    plain = root.split(":", 1)[-1].rstrip("/").lstrip("/")
    return F.element_at(F.split(path, rf"\Q{plain}/\E", 2), -1)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below the root; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", source_file(F.col("path"), root).alias("source_file"))


def routed(files: DataFrame, routes: Mapping[str, str] = ROUTES) -> DataFrame:
    """One row per file and entity whose pattern matches its whole name."""
    entities = [F.when(F.col("source_file").rlike(f"^(?:{p})$"), e) for e, p in routes.items()]
    return files.select("path", "source_file", F.explode(F.array_compact(F.array(*entities))).alias("entity"))


def _open(reader, kind: str, files: DataFrame) -> DataFrame:
    """A reader's relation of the files of a table; their paths go from the table to the reader inside the JVM."""
    spark = files.sparkSession
    paths = getattr(files.select("path")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING()).collectAsList()
    return DataFrame(getattr(reader._jreader, kind)(spark._jvm.PythonUtils.toSeq(paths)), spark)


# CSV


def headers(files: DataFrame) -> DataFrame:
    """(path, header): the first line of each file of a table, NULL for a file that cannot be read.

    Only the start of a file is read, by small tasks. Where no file can be opened this way, Spark reads the first
    block of each.
    """

    def first_line(path: str) -> str:
        from urllib.parse import quote

        from pyarrow import fs

        if path.startswith(("file:", "/")):
            system, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            system, name = fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/@+"))
        with system.open_input_stream(name) as stream:
            head = b""
            while b"\n" not in head and (chunk := stream.read(1 << 16)):
                head += chunk
        return head.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")

    def readable_line(path: str) -> str | None:
        try:
            return first_line(path)
        except (OSError, ValueError):
            return None

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "header": [readable_line(p) for p in batch["path"]]})

    spread = files.select("path").repartition("path")
    found = stage(spread.mapInPandas(first_lines, "path string, header string"), "headers")
    if found.where("header is not null").isEmpty():
        try:
            return stage(_headers_by_scan(files), "headers")
        except SPARK_ERRORS:
            pass
    return found


def _headers_by_scan(files: DataFrame) -> DataFrame:
    """For file systems that only Spark can open: the first line of each file's first block."""
    lines = _open(files.sparkSession.read, "text", files).selectExpr(
        "value", PATH_SQL, "_metadata.file_block_start", "monotonically_increasing_id() as n"
    )
    starts = lines.where("file_block_start = 0").groupBy("path")
    return starts.agg(F.regexp_replace(F.min_by("value", "n"), "^\ufeff", "").alias("header"))


def column_names(header: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([header]), [])]


def with_names(headers: DataFrame) -> DataFrame:
    """(path, names) of (path, header); each different header is taken apart once."""

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"header": batch["header"], "names": [column_names(h) for h in batch["header"]]})

    different = headers.where("header is not null").select("header").distinct()
    names = different.mapInPandas(named, "header string, names array<string>")
    return headers.join(names, "header", "left").select("path", "names")


def read_csv(files: DataFrame, multiline: bool = False) -> DataFrame:
    """The rows of all files of a table of (path, names), as objects keyed by the names of their own file.

    Every value is text and NULL keys are kept. Columns are read by position, so names may differ in case only.
    Short rows are filled with NULLs. ``multiline`` allows line breaks inside quotes; files are then not split over
    tasks.
    """
    width = files.agg(F.max(F.size("names"))).first()[0] or 1
    positions = [f"c{i}" for i in range(width)]
    reader = (
        files.sparkSession.read.schema(", ".join(f"{p} string" for p in positions))
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .option("mode", "PERMISSIVE")
        .option("multiLine", str(multiline).lower())
    )
    nulls = one_of(fv.CSV_NULL_TOKENS)
    cells = ", ".join(f"if({p} in {nulls}, null, {p})" for p in positions)
    rows = _open(reader, "csv", files).selectExpr(f"array({cells}) as cells", PATH_SQL)
    # the header of a row is found by its path
    named = rows.join(files.select("path", "names"), "path")
    return named.selectExpr("map_from_arrays(names, slice(cells, 1, size(names))) as raw_data", "path")


# JSON


def read_json(files: DataFrame) -> DataFrame:
    """(path, raw_data): the objects of the JSON files of a table, one row each, values as text.

    Objects may be laid out in any way: an object or several a line, an array over many lines, one after the other. A
    NULL stands for a piece of a file that is no object.
    """
    lines = _open(files.sparkSession.read, "text", files)
    return json_objects.objects(lines.selectExpr(PATH_SQL, "_metadata.file_block_start as start", "value"))
