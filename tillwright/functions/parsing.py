"""SQL expressions that turn messy text into typed values; unparsable text becomes NULL.

Each function takes the SQL text of a string expression and returns the SQL text of its value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from tillwright import fixed_values as fv


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(texts: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(t) for t in texts) + ")"


def code_label(text: str, codes: Mapping[str, str], ignore_case: bool = True) -> str:
    """The label of a code; text that is no known code is kept, trimmed."""
    trimmed = f"trim({text})"
    key = f"upper({trimmed})" if ignore_case else trimmed
    labels = ", ".join(f"{quoted(code)}, {quoted(label)}" for code, label in codes.items())
    return f"coalesce(map({labels})[{key}], {trimmed})"


def safe_double(text: str) -> str:
    """Plain and scientific numbers only: Spark's own cast would also take '1d', 'NaN' or 'Infinity'."""
    return f"if(trim({text}) rlike {quoted(fv.NUMBER_PATTERN)}, try_cast({text} as double), null)"


def safe_whole_number(text: str) -> str:
    """Rounds fractions half away from zero; a number too long for bigint is NULL."""
    return f"try_cast(try_cast({text} as decimal(38,0)) as bigint)"


def currency_amount(text: str) -> str:
    return f"try_cast(regexp_replace({text}, {quoted(fv.NOT_AMOUNT_PATTERN)}, '') as double)"


def discount_ratio(text: str) -> str:
    percent = safe_double(f"replace({text}, '%', '')")
    return f"if(contains({text}, '%'), {percent} / 100.0D, {safe_double(text)})"


def digits_of_number(text: str) -> str:
    """'1.23456E+11' -> '123456000000'."""
    return f"cast(try_cast({safe_double(text)} as decimal(38,0)) as string)"


def _year_first(text: str) -> str:
    return f"regexp_replace({text}, {quoted(fv.MONTH_FIRST_PATTERN)}, '$3-$1-$2')"


def order_time(text: str) -> str:
    """One format test and one cast: no session time zone and no failed parses on the way."""
    return f"if({text} rlike {quoted(fv.ORDER_TIME_PATTERN)}, try_cast({_year_first(text)} as timestamp_ntz), null)"


def return_day(text: str) -> str:
    time = f"try_cast({_year_first(text)} as timestamp_ntz)"
    return f"if({text} rlike {quoted(fv.RETURN_DATE_PATTERN)}, cast({time} as date), null)"
