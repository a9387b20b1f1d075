"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

DIRECTORY = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, con, name):
    assert compare(entry.queries()[name](spark, DIRECTORY), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_rows_only(spark, name):
    frame = entry.queries()[name](spark, DIRECTORY)
    assert frame.count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["rank"] for r in rows} == set(range(1, 11))
