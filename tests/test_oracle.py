"""Every query of the catalogue against its SQL text on another engine; the text operators have tests of their own."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle.sql import oracle
from tests.compare import connect, differences
from tests.conftest import SMALL
from tillwright import catalogue

QUERIES = entry.queries()
ORACLE = oracle()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


# Held against a plain version in tests/test_insights.py.
WITHOUT_SQL = {"dq_audit_report"}


def test_every_query_has_a_check():
    assert set(catalogue.QUERIES) - WITHOUT_SQL == set(ORACLE)
    assert set(catalogue.QUERIES) <= set(QUERIES)
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["year", "month", "month_name", "region"]
