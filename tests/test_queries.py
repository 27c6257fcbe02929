"""Every registered query against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.suite.oracle import compose
from tidemark.suite.registry import ORACLES, QUERIES
from verify import SAME_TYPE, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, db, name):
    frame = QUERIES[name](spark, SF)
    result = db.execute(compose(ORACLES[name]))
    types = {item[0]: str(item[1]) for item in result.description}
    assert {column: SAME_TYPE[kind] for column, kind in frame.dtypes} == types
    got = rows_of(frame.columns, frame.collect())
    assert got == rows_of([item[0] for item in result.description], result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
