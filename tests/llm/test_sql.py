"""The queries that SQL can express, against it; and what is registered."""

import re

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as contract
from pulsemill.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    message, rows, _ = compare(spark, con, name, QUERIES[name], SQL[name], FOLDER)
    assert message is None and rows, message


def test_all_are_registered():
    named = set(contract.queries())
    assert {int(m[1]) for n in named if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in named and set(SQL) <= set(contract.oracle_sql())
