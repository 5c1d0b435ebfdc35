"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, spark_rows, sql_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no bundled tables")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    columns, rows = spark_rows(entry.queries()[name](spark, FOLDER))
    assert columns and rows
    if name in SQL:
        assert (columns, rows) == sql_rows(con, SQL[name])


def test_entry(spark):
    assert entry.entry(spark).columns == ["id_a", "id_b", "sim"]
