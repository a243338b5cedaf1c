"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_file

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
