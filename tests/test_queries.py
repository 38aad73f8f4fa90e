"""Every registered query against its SQL on the given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from reviewloom.workbook.oracle import SQL
from reviewloom.workbook.queries import all_queries
from tests.oracle_check import compare, oracle_connection

FOLDER = os.environ.get("REVIEWLOOM_TABLES", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@needs_tables
@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, connection, name):
    assert compare(all_queries()[name](spark, FOLDER), connection, SQL[name]) == ""


def test_every_query_has_sql():
    assert set(all_queries()) == set(SQL)
    assert set(all_queries()) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@needs_tables
def test_entry(spark):
    assert entry(spark).columns == ["catalog", "rank", "term", "n"]
