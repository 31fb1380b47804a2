"""Surrogate keys and text templates."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright import fixed_values as fv


def surrogate_key(*columns: str) -> Column:
    """Hash of the business key, so a rebuilt dimension keeps its keys."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(fv.SURROGATE_KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(fv.SURROGATE_KEY_SEPARATOR, *parts))


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """Template text with its {fields} replaced; NULL when any field is NULL."""
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{"):
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
