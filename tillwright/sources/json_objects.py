"""The objects of JSON files of any layout, read once and by as many tasks as the files have splits.

A line break is never inside a JSON string, so every line begins outside of one, and the depth of brackets can be
followed through a split from its first line on. What is unknown is the depth at which a split begins. A task therefore
cuts its text wherever a closing brace is at the least depth so far: all ends of whole objects are among these places,
and others only before the first of them. The depths that the splits add up to, a small table, then tell which cuts
are real. An object that lies on several splits is put together again; a line break ends no object, so that an array
on a single line is one record of one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import stage

OBJECT = "map<string,string>"

_FRAGMENT = {
    "path": pa.string(),
    "start": pa.int64(),
    "seq": pa.int64(),
    "before": pa.int64(),
    "after": pa.int64(),
    "total": pa.int64(),
    "text": pa.large_string(),
}
_FRAGMENT_SQL = "path string, start bigint, seq bigint, before bigint, after bigint, total bigint, text string"
_HELD_ROWS = 2000
_QUOTE, _OPEN, _CLOSE = ord('"'), (ord("{"), ord("[")), (ord("}"), ord("]"))


class Cutter:
    """The fragments of one split: its text cut where a closing brace is at the least depth so far, 0 to begin with."""

    def __init__(self, first: bool) -> None:
        self.at_start, self.depth, self.least, self.seq = first, 0, 0, 0
        self.before: int | None = None
        self.pending: list[bytes] = []

    def add(self, data: bytes) -> Iterator[dict]:
        """data: whole lines."""
        if self.at_start and data.strip(b"\xef\xbb\xbf \t\r\n"):
            self.at_start = False
            lead = data.lstrip(b"\xef\xbb\xbf \t\r\n")
            data = lead[1:] if lead[:1] == b"[" else lead  # the array of the whole file is not counted
        plain = data.replace(b"\\\\", b"  ").replace(b'\\"', b"  ") if b"\\" in data else data
        points = np.frombuffer(plain, np.uint8)
        kinds = np.zeros(256, dtype=np.int8)
        kinds[list(_OPEN)], kinds[list(_CLOSE)], kinds[_QUOTE] = 1, -1, 2
        at = np.flatnonzero(kinds[points])
        kind = kinds[points[at]].astype(np.int64)
        inside = np.cumsum(kind == 2) % 2 == 1
        depth = self.depth + np.cumsum(np.where(inside | (kind == 2), 0, kind))
        ends = np.flatnonzero(~inside & (points[at] == _CLOSE[0]))
        least = np.minimum.accumulate(np.append(self.least, depth[ends]))
        cuts = ends[depth[ends] == least[1:]]
        done = 0
        for place, after in zip((at[cuts] + 1).tolist(), depth[cuts].tolist()):
            yield self._fragment(data[done:place], after)
            done = place
        self.pending.append(data[done:])
        self.depth, self.least = int(depth[-1]) if len(depth) else self.depth, int(least[-1])

    def _fragment(self, data: bytes, after: int | None) -> dict:
        text = b"".join([*self.pending, data])
        self.pending.clear()
        found = {"seq": self.seq, "before": self.before, "after": after, "text": text.decode()}
        self.seq, self.before = self.seq + 1, after
        return found

    def rest(self) -> dict:
        return self._fragment(b"", None) | {"total": self.depth}


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []

    def out() -> pa.RecordBatch:
        columns = [pa.array([row.get(name) for row in held], kind) for name, kind in _FRAGMENT.items()]
        held.clear()
        return pa.record_batch(columns, list(_FRAGMENT))

    current, cutter = None, None
    for batch in batches:
        paths, starts, values = (batch[c].to_pylist() for c in ("path", "start", "value"))
        split = list(zip(paths, starts))
        first = 0
        while first < len(split):
            last = first
            while last < len(split) and split[last] == split[first]:
                last += 1
            if split[first] != current:
                if cutter:
                    held.append(cutter.rest() | {"path": current[0], "start": current[1]})
                current, cutter = split[first], Cutter(split[first][1] == 0)
            lines = "\n".join([*values[first:last], ""]).encode()
            for fragment in cutter.add(lines):
                held.append(fragment | {"path": current[0], "start": current[1]})
                if len(held) >= _HELD_ROWS:
                    yield out()
            first = last
    if cutter:
        held.append(cutter.rest() | {"path": current[0], "start": current[1]})
    if held:
        yield out()


def objects(lines: DataFrame) -> DataFrame:
    """(path, raw_data) of all objects; raw_data is NULL for a piece of a file that is no object.

    lines: (path, start, value) in the order of each split, start being the split's first byte.
    """
    found = stage(lines.select("path", "start", "value").mapInArrow(_fragments, _FRAGMENT_SQL), "json_fragments")
    splits = found.groupBy("path", "start").agg(F.max("total").alias("total"), F.min("after").alias("least"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("end", -F.coalesce(F.sum("total").over(before), F.lit(0)))
    splits = splits.withColumn("ends", F.coalesce(F.col("least") <= F.col("end"), F.lit(False)).cast("int"))
    splits = splits.withColumn("ordinal", F.coalesce(F.sum("ends").over(before), F.lit(0))).drop("total", "least")
    known = found.join(splits, ["path", "start"])
    begins = (F.col("before") == F.col("end")) | ((F.col("seq") == 0) & (F.col("start") == 0))
    whole = F.coalesce(begins & (F.col("after") == F.col("end")), F.lit(False))
    # the rest of an object that began in an earlier split, or the beginning of one that ends in a later split
    follows = F.coalesce(F.col("before") <= F.col("end"), F.lit(False))
    part = F.col("ordinal") + F.when(follows, F.col("ends")).otherwise(0)
    parts = known.where(~whole).groupBy("path", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("parts")
    )
    joined = parts.select("path", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    texts = known.where(whole).select("path", "text").unionByName(joined)
    texts = texts.select("path", F.regexp_replace("text", r"^[\s,]+", "").alias("text"))
    return texts.where(~F.rlike("text", F.lit(r"^\s*\]?\s*$"))).select("path", F.from_json("text", OBJECT).alias("raw_data"))
