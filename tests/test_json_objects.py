"""Objects of JSON files in any layout and over any splits, held against the json module."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tillwright.sources import files, ingest, json_objects
from tillwright.sources.tables import Tables

TRICKY = ['a } b', '{"x": [1, {"y": 2}]}', 'end "quote" \\', "\\\\", "]},\n{[", 'é 한 😀 "}', "", "\\\"}{"]


def _objects(rng, n):
    def value(depth):
        kind = rng.randrange(6 if depth < 3 else 3)
        if kind == 0:
            return rng.choice(TRICKY)
        if kind == 1:
            return rng.randrange(-5, 1000)
        if kind == 2:
            return None
        if kind == 3:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {f"k{i}{rng.choice(['', ' }', '\"'])}": value(depth + 1) for i in range(rng.randrange(4))}

    return [{"id": i, **{f"f{j}": value(1) for j in range(rng.randrange(6))}} for i in range(n)]


def _layouts(found):
    yield "pretty", json.dumps(found, indent=2)
    yield "pretty_ascii", "﻿\n\n" + json.dumps(found, indent=1, ensure_ascii=False)
    yield "one_line", json.dumps(found)
    yield "lines", "\n".join(map(json.dumps, found))
    yield "lines_array", "[\n" + ",\n".join(map(json.dumps, found)) + "\n]\n"
    yield "leading_commas", "[" + "\n,".join(json.dumps(o, indent=4) for o in found) + "]"
    yield "side_by_side", " ".join(json.dumps(o, indent=2) for o in found)
    yield "windows", json.dumps(found, indent=2).replace("\n", "\r\n")


def _plain(value):
    """As raw_data holds it: text as it is, everything else as JSON."""
    return value if value is None or isinstance(value, str) else json.loads(json.dumps(value))


def _check(rows, found):
    assert len(rows) == len(found)
    by_id = {int(r["raw_data"]["id"]): r["raw_data"] for r in rows}
    for o in found:
        raw = by_id[o["id"]]
        assert raw.keys() == o.keys()
        for key, value in o.items():
            assert raw[key] == value if value is None or isinstance(value, str) else json.loads(raw[key]) == value


@pytest.mark.parametrize("split", [None, 64, 700])
def test_layouts_and_splits(spark, tmp_path, split):
    rng = random.Random(split)
    expected = {}
    for i, n in enumerate((2, 12) if split else (0, 1, 2, 300)):
        found = _objects(rng, n)
        for name, text in _layouts(found):
            (tmp_path / f"{name}_{i}.json").write_text(text, encoding="utf-8", newline="")
            expected[f"{name}_{i}.json"] = found
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        listed = files.list_files(spark, str(tmp_path))
        rows = files.read_json(listed).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {name: [] for name in expected}
    for r in rows:
        by_file[r["path"].rsplit("/", 1)[-1]].append(r)
    for name, found in expected.items():
        _check(by_file[name], found)


def test_a_multi_line_array_is_read_by_several_tasks(spark, tmp_path):
    found = [{"id": i, "t": {"x": ["}" * 20, {"y": i}]}} for i in range(500)]
    (tmp_path / "big.json").write_text(json.dumps(found, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        listed = files.list_files(spark, str(tmp_path))
        lines = files._open(spark.read, "text", listed).selectExpr(files.PATH_SQL, "_metadata.file_block_start as start", "value")
        tasks = lines.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 8
        rows = json_objects.objects(lines).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    _check(rows, found)


@pytest.mark.parametrize(
    "text", ['[{"id": 1}, {"id": ]', '{"id": 1}\n{"id": 2', "plain words", '[{"id": 1}] {"id"', '{"id": 1}\nnoise\n', "[1, 2]"]
)
def test_what_is_no_object_is_reported(spark, tmp_path, text):
    (tmp_path / "returns_1.json").write_text(text)
    (tmp_path / "returns_2.json").write_text('[{"OrderId": "O1"}]')
    tables = Tables(spark, str(tmp_path / "wh"))
    report = {r["source_file"]: r["status"] for r in ingest.ingest(spark, str(tmp_path), tables).where("source_file is not null").collect()}
    assert report == {"returns_1.json": "error", "returns_2.json": "loaded"}
    assert tables.read("landing_returns").count() == 1


@pytest.mark.parametrize("text", ["", "\n \n", "[]", "[\n]\n", " [ ] "])
def test_files_without_objects(spark, tmp_path, text):
    (tmp_path / "products.json").write_text(text)
    assert files.read_json(files.list_files(spark, str(tmp_path))).count() == 0
