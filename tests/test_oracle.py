"""Every query with a SQL twin gives the same rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import DATA
from tests.oracle import compare, connect

SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    assert compare(df, con, SQL[name]) is None
