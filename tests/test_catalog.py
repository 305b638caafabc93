"""Every registered query against its DuckDB query, on whole tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
