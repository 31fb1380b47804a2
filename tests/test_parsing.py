from __future__ import annotations

from datetime import date, datetime

import pytest

from tillwright import fixed_values as fv
from tillwright.functions import parsing as p
from tillwright.functions.keys import fill, surrogate_key
from pyspark.sql import functions as F


def values(spark, expression: str, texts: list[str | None]):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    return [r[0] for r in rows.orderBy("i").selectExpr(expression).collect()]


@pytest.mark.parametrize(
    "expression, pairs",
    [
        (
            p.code_label("c", fv.SEGMENT_CODES),
            {"CONS": "Consumer", " corp ": "Corporate", "HO": "Home Office", "Cosumer": "Consumer",
             "home office": "Home Office", "Gov": "Gov", " Gov ": "Gov", None: None},
        ),
        (
            p.code_label("c", fv.REGION_CODES),
            {"W": "West", "s": "South", "EAST": "East", " Central ": "Central", "X": "X", None: None},
        ),
        (
            p.code_label("c", fv.SHIP_MODE_CODES, ignore_case=False),
            {"1st": "First Class", "2nd Class": "Second Class", " Std ": "Standard Class", "Same Day": "Same Day",
             "1ST": "1ST", None: None},
        ),
        (
            p.code_label("c", fv.RETURN_STATUS_CODES),
            {"APPRVD": "Approved", "pendg": "Pending", "RJCTD": "Rejected", "Lost": "Lost", None: None},
        ),
        (
            p.order_time("c"),
            {"01/05/2018 09:05": datetime(2018, 1, 5, 9, 5), "2018-01-05 09:05": datetime(2018, 1, 5, 9, 5),
             "01/05/2018": datetime(2018, 1, 5), "2018-01-05": datetime(2018, 1, 5), "1/5/2018": datetime(2018, 1, 5),
             "2018-01-05T09:05:00": datetime(2018, 1, 5, 9, 5), "not a date": None, "2018-02-30": None, "13/01/2018": None,
             "2018": None, "2018-01": None, "2018-01-05 25:00": None, "2018-01-05 09:05:07": None, "": None, None: None,
             # An hour that the session's time zone skips.
             "03/11/2018 02:30": datetime(2018, 3, 11, 2, 30)},
        ),
        (
            p.return_day("c"),
            {"2018-01-05": date(2018, 1, 5), "01-05-2018": date(2018, 1, 5), "01/05/2018": date(2018, 1, 5),
             "2018-01-05T23:30:00": date(2018, 1, 5), "soon": None, "01-05/2018": None, "2018-01-05 10:00": None, None: None},
        ),
        (
            p.currency_amount("c"),
            {"$1,234.50": 1234.5, "12.00 USD": 12.0, "-5": -5.0, "1234.50-": None, "1e3": 13.0, "(5)": 5.0, "": None, None: None},
        ),
        (p.safe_whole_number("c"), {"3": 3, "2.5": 3, "-2.5": -3, "abc": None, "0": 0, "9" * 30: None, None: None}),
        (
            p.discount_ratio("c"),
            {"20%": 0.2, "0.2": 0.2, "1.5": 1.5, "x": None, "x%": None, "%": None, None: None},
        ),
        (
            p.safe_double("c"),
            {"1.5": 1.5, " 2 ": 2.0, "1e3": 1000.0, "-.5": -0.5, "5.": 5.0, "1d": None, "NaN": None, "Infinity": None, "?": None,
             "1 2": None, "": None, None: None},
        ),
        (
            p.digits_of_number("c"),
            {"1.23456E+11": "123456000000", "123456789012": "123456789012", "2.5": "3", "bad": None, "1e300": None, None: None},
        ),
    ],
)
def test_parsing(spark, expression, pairs):
    assert values(spark, expression, list(pairs)) == list(pairs.values())


def test_surrogate_key(spark):
    row = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    keys = row.select(surrogate_key("x"), surrogate_key("x", "y", "z"), surrogate_key("y")).first()
    assert list(keys) == [md5("a"), md5(f"a-{fv.SURROGATE_KEY_NULL}-1"), md5(fv.SURROGATE_KEY_NULL)]


def test_fill_passes_null_on(spark):
    row = spark.createDataFrame([("a", None)], "x string, y string")
    filled = row.select(fill("<{v}>", {"v": F.col("x")}), fill("<{v}>", {"v": F.col("y")})).first()
    assert list(filled) == ["<a>", None]
