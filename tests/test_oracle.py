"""Every registered query against its SQL form."""

import pytest

import __spark_entry__ as contract
from compare import difference, sql_connection
from conftest import SF_DIR

SQL = contract.oracle_sql()
QUERIES = contract.REGISTERED


@pytest.fixture(scope="module")
def connection():
    return sql_connection(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR), connection, SQL[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert "quality_score" in result.columns
