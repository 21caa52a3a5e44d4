"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from oracles import ORACLE_SQL
from queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, FOLDER)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
