"""Every registered query against its SQL, on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import rows_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, FOLDER)
    result = db.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(result.columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 20
