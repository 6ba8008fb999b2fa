"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == contract.entry(spark).columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
