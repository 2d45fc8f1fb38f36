"""Every query next to its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from check import TABLES, normalised

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, engine, name):
    mine = entry_module.queries()[name](spark, SF).toPandas()
    theirs = engine.sql(entry_module.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normalised(mine) == normalised(theirs)
