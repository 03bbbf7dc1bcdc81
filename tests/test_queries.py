"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as driver

SMALL = driver.SMALL
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_flagship_runs(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
