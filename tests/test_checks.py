"""Every registered query against its DuckDB SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from parceltrail import checks

QUERIES, SQL = checks.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = ordered(tuple(row[c] for c in columns) for row in df.collect())
    answer = duck.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = ordered(tuple(row[i] for i in places) for row in answer.fetchall())
    assert got == want
    assert got, "a check without rows proves nothing"


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.count() > 0
