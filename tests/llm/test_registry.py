"""Registered queries: they run, and SQL agrees where there is some."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from parceltrail.llm import registry


def test_all_are_registered():
    names = driver.queries()
    assert set(registry.QUERIES) | {"pipeline"} <= set(names)
    assert sorted({int(n[2:].split("_")[0]) for n in registry.QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    df = driver.queries()[name](spark, sf_dir)
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    columns = ", ".join(sorted(df.columns))
    want = duck.execute(f"SELECT {columns} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect()) == sorted(want)
