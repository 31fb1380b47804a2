"""The landed object: one map per row, keys spelled as in the file, NULL values kept."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwright import fixed_values as fv

LANDING_SCHEMA = "raw_data map<string,string>, _source_file string, _load_timestamp timestamp_ntz"
LINEAGE = ("_source_file", "_load_timestamp")


def pack(rows: DataFrame, entity: str) -> DataFrame:
    """Flat bronze-named columns to landed objects."""
    entries = ", ".join(f"'{key}', {column}" for column, key in fv.BRONZE_KEYS[entity].items())
    return rows.selectExpr(f"map({entries}) as raw_data", *LINEAGE)


def extract(landed: DataFrame, entity: str) -> DataFrame:
    """Bronze: one text column per known key; a key the file lacks is NULL."""
    fields = [f"raw_data['{key}'] as {column}" for column, key in fv.BRONZE_KEYS[entity].items()]
    return landed.selectExpr(*fields, *LINEAGE)
