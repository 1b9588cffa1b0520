"""Every registered query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def plain(frame):
    def text(value):
        return "NULL" if pd.isna(value) else str(value)

    frame = frame[sorted(frame.columns)].map(text)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, db, name):
    found = registry.queries()[name](spark, SF_DIR).toPandas()
    assert len(found) > 0
    if name in registry.oracle_sql():
        expected = plain(db.execute(registry.oracle_sql()[name]).df())
        found = plain(found)
        assert list(found.columns) == list(expected.columns)
        assert len(found) == len(expected)
        pd.testing.assert_frame_equal(found, expected)


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["batch_id", "poll_seq", "pos", "line"]
    assert result.count() > 0


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
