from __future__ import annotations

import json
import random

import pytest

from tests.conftest import MEDIUM
from tillwright import catalogue
from tillwright import fixed_values as fv
from tillwright.operators import checks, harmonize, rules
from tillwright.plans.mart import Mart
from tillwright.sources.landing import LANDING_SCHEMA, extract

# Offending rows per rule in the medium data.
GOLDEN = {
    1: 24, 2: 25, 3: 28, 4: 29, 5: 149, 6: 146, 7: 141, 8: 138, 9: 133, 10: 458, 11: 394, 12: 440,
    13: 791, 14: 401, 15: 157, 16: 213, 17: 136, 18: 1504, 19: 87, 20: 11, 21: 11, 22: 1, 23: 1,
}


def landed(spark, rows):
    return spark.createDataFrame([(r, "f.csv", None) for r in rows], LANDING_SCHEMA)


def flagged(spark, entity, rows):
    return rules.flag(harmonize.HARMONIZERS[entity](extract(landed(spark, rows), entity)), entity)


def test_golden_counts(spark):
    counts = catalogue.QUERIES["rejected_by_rule"](spark, MEDIUM).collect()
    assert {r["rule"]: r["rejected_count"] for r in counts} == GOLDEN


def test_rule_numbers_and_names():
    assert [r.number for r in rules.RULES] == list(range(1, 24))
    assert {r.issue for r in rules.RULES} == {"missing_value", "invalid_value", "out_of_range", "parse_failure"}


@pytest.mark.parametrize("entity", fv.ENTITIES)
def test_flags_are_never_null(spark, entity):
    """A row of NULLs, an empty object and junk are either clean or rejected."""
    junk = {key: "?" for key in fv.BRONZE_KEYS[entity].values()}
    nulls = {key: None for key in fv.BRONZE_KEYS[entity].values()}
    df = flagged(spark, entity, [nulls, {}, junk])
    names = [r.flag for r in rules.rules_for(entity)] + [rules.ANY_FAILURE]
    assert all(row[name] is not None for row in df.collect() for name in names)


REFUNDS = {"?": False, "n/a": True, "-5": True, "0": False, "12.5": False, None: False}


@pytest.mark.parametrize("refund, fails", REFUNDS.items())
def test_refund_rule(spark, refund, fails):
    row = {"order_id": "O", "return_reason": "Late", "return_status": "Approved", "refund_amount": refund}
    found = flagged(spark, "returns", [row]).first()
    assert found["_fail_negative_refund"] is fails
    assert found[rules.ANY_FAILURE] is fails


def test_missing_raw_date_passes(spark):
    row = {"order_id": "O", "customer_id": "C", "ship_mode": "1st", "order_status": "SHIPPED "}
    assert flagged(spark, "orders", [row]).first()[rules.ANY_FAILURE] is False
    assert flagged(spark, "orders", [{**row, "order_purchase_date": "x"}]).first()["_fail_unparseable_date"] is True


def test_city_and_state_swap(spark):
    row = {"customer_id": "C", "city": "a", "state": "b"}
    cells = [(row, "Region4/customers_4.csv", None), (row, "Region1/customers_1.csv", None), (row, "region1/customers_14.csv", None)]
    df = spark.createDataFrame(cells, LANDING_SCHEMA)
    found = harmonize.customers(extract(df, "customers")).select("city", "state").collect()
    assert [tuple(r) for r in found] == [("b", "a"), ("a", "b"), ("b", "a")]
    exact = harmonize.customers(extract(df, "customers"), "Region4/%").select("city").collect()
    assert [r[0] for r in exact] == ["b", "a", "a"]


def test_record_with_two_failures_gives_two_rows(spark):
    df = flagged(spark, "products", [{"brand": "b", "upc": "7"}])
    rows = rules.rejected(df, "products").collect()
    assert sorted(r["affected_field"] for r in rows) == ["product_id", "product_name"]
    data = json.loads(rows[0]["record_data"])
    assert data["brand"] == "b" and data["_has_any_failure"] is True and "product_id" not in data


def test_audit_balances_on_random_rows(spark):
    rng = random.Random(5)
    words = [None, "", "?", "1st", "SHIPPED", "2018-01-05", "C-1", "0.5", "-3", "abc", "Consumer", "W", "APPRVD", "20%"]

    def rows(entity):
        return [{k: rng.choice(words) for k in fv.BRONZE_KEYS[entity].values() if rng.random() < 0.8} for _ in range(200)]

    data = {e: landed(spark, rows(e)) for e in fv.ENTITIES}
    mart = Mart(lambda e: data[e])
    audit = mart.pipeline_audit_log
    assert checks.audit_balanced(audit).count() == 0
    assert {r["bronze_count"] for r in audit.collect()} == {200}
    for entity in fv.ENTITIES:
        counts = audit.where(f"entity = '{entity}'").first()
        assert mart.clean(entity).count() == counts["silver_count"]


def test_in_range(spark):
    df = spark.createDataFrame([(None,), (-1,), (0,), (1,), (2,)], "v int")

    def bad(**bounds):
        return [r[0] for r in checks.in_range(df, "v", **bounds).collect()]

    assert bad(min_value=0, max_value=1) == [-1, 2]
    assert bad(min_value=0) == [-1]
    assert bad(min_value=0, max_value=2, inclusive=False) == [-1, 0, 2]
    with pytest.raises(ValueError):
        checks.in_range(df, "v")


def test_other_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "v string")
    assert checks.not_null(df, "v").count() == 2
    assert [tuple(r) for r in checks.unique(df, "v").collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.accepted_values(df, "v", ["a"]).collect()] == [("b", 1)]
    bridge = spark.createDataFrame([("x", 0.5), ("x", 0.4), ("y", 1.0)], "order_id string, allocation_weight double")
    assert [r["order_id"] for r in checks.allocation_sums(bridge).collect()] == ["x"]
