"""Every registered query with a SQL counterpart gives the same result on both engines."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with duck(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])[:3] == []


def test_entry(spark):
    shares = {r.customer_action: r.n for r in entry_points.entry(spark).collect()}
    assert shares == {0: 384, 1: 234, 2: 817}
