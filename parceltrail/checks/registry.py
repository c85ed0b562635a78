"""Registry of checkable queries: a Spark query and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parceltrail.checks.compare import comparable
from parceltrail.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


class Source:
    """The test tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, sql: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(sql, **frames)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def check(self, sql: str, name: str | None = None) -> Callable:
        def add(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
            key = name or build.__name__
            self.queries[key] = lambda spark, sf_dir: comparable(build(Source(prepare(spark), sf_dir)))
            self.sql[key] = sql
            return build

        return add
