"""Runs a registered query and its SQL text side by side."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when columns, row count and all values agree."""
    columns, rows = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    con.execute(sql)
    names = [d[0] for d in con.description]
    other_columns, other = _sorted_rows(names, con.fetchall())
    if columns != other_columns:
        return f"columns {columns} <> {other_columns}"
    if len(rows) != len(other):
        return f"row counts {len(rows)} <> {len(other)}"
    if rows != other:
        mine, theirs = set(rows) - set(other), set(other) - set(rows)
        return f"{len(mine)} rows differ of {len(rows)}; e.g.\n  {sorted(mine)[:2]}\n  {sorted(theirs)[:2]}"
    return None
