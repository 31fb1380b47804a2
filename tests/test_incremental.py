"""Marks reach the stored files, and a bad date does not cut the calendar."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from tillwright import fixed_values as fv
from tillwright.operators import dimensions, rules
from tillwright.plans import pipeline
from tillwright.session import new_path
from tillwright.sources import driver_tables, ingest
from tillwright.sources.landing import extract
from tillwright.sources.tables import Tables, newer, watermark


@pytest.fixture(scope="module")
def loaded(spark):
    tables = Tables(spark, new_path(spark, "warehouse"))
    for entity in fv.ENTITIES:
        tables.append(ingest.landing_name(entity), driver_tables.landing(spark, SMALL, entity))
    pipeline.refresh_silver(tables, "full")
    return tables


def pushed(rows) -> list[str]:
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and "GreaterThan(_load_timestamp" in line]


@pytest.mark.parametrize("entity", fv.ENTITIES)
def test_rows_are_chosen_before_they_are_parsed(loaded, entity):
    mark = watermark(loaded.read(f"clean_{entity}"))
    assert pushed(newer(extract(loaded.read(ingest.landing_name(entity)), entity), mark))
    layer = pipeline.newer_layer(loaded, {entity: mark})
    assert pushed(layer.clean_anew(entity))
    assert pushed(rules.rejected(layer.harmonized(entity), entity))


def test_an_extra_run_adds_nothing(loaded):
    counts = {n: loaded.read(n).count() for n in [*[f"clean_{e}" for e in fv.ENTITIES], "rejected_records"]}
    pipeline.refresh_silver(loaded, "incremental")
    assert {n: loaded.read(n).count() for n in counts} == counts


def test_calendar_from_a_bad_date(spark):
    orders = spark.sql("select timestamp_ntz'0101-05-06 00:00:00' as order_purchase_date union all select timestamp_ntz'2019-02-03 10:00:00'")
    returns = spark.sql("select date'2018-01-09' as return_date where false")
    days = dimensions.dates(orders, returns)
    first, last, n, keys = days.selectExpr("min(date_key)", "max(date_key)", "count(*)", "count(distinct date_sk)").first()
    assert (str(first), str(last)) == ("0101-01-01", "2020-01-01")
    assert n == keys == (last - first).days + 1
    assert dimensions.dates(orders.where("false"), returns).count() == 0
    end = spark.sql("select timestamp_ntz'9999-12-31 00:00:00' as order_purchase_date")
    assert str(dimensions.dates(end, returns).selectExpr("cast(max(date_key) as string)").first()[0]).endswith("10000-01-01")
