"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from compare import compare, duck
from gridpulse.checks.registry import oracle_sql, queries

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries(), oracle_sql()
ROWS_ONLY: set[str] = set()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_names_match():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= SQL.keys()
