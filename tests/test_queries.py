"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    problem = compare(spark, con, sf, QUERIES[name], ORACLES.get(name))
    if problem == "oracle gives no rows":
        pytest.skip("no such rows in the smallest tables")
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "category", "metric_name", "month", "metric_value", "expected_value", "z_score", "severity"]
    assert df.count() > 0
