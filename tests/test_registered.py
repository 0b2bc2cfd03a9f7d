"""Every registered query with SQL must agree with it on the smallest tables."""

import os

import pytest
from conftest import TESTDATA
from oracle_check import compare, connect

import __spark_entry__ as entry

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="test tables not present")
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(con, SQL[name], QUERIES[name](spark, TESTDATA)) is None


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["n"] > 0 and row["n_null"] == 0
