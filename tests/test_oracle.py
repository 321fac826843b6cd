"""Every query with a SQL counterpart gives exactly its rows; the others give rows."""

import oracle
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 1000
    assert len(set(df.columns)) == len(df.columns)
