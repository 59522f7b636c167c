"""Every bound query against its SQL on the smallest data."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as contract
from pulsemill.bindings import bound_queries, bound_sql

FOLDER = contract.SMOKE_DATA
QUERIES, SQL = bound_queries(), bound_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    message, _, _ = compare(spark, con, name, QUERIES[name], SQL.get(name), FOLDER)
    assert message is None, message


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
