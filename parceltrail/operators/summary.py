"""One-pass summaries: everything a report needs per key from an event log, in a single grouped aggregate.

Each helper is an aggregate expression, so a log is read once and pre-aggregated map-side, however many summaries a
report takes from it and however many rows one key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_latest(time: Column, value: Column, where: Column | None = None) -> Column:
    """Largest value among the rows at the latest time. NULL values count only when there is nothing else."""
    pair = F.struct(time.alias("t"), value.alias("v"))
    return F.max(pair if where is None else F.when(where, pair))["v"]


def at_earliest(time: Column, value: Column, where: Column | None = None) -> Column:
    """Smallest value among the rows at the earliest time; NULL values sort after real ones."""
    pair = F.struct(time.alias("t"), value.isNull().alias("missing"), value.alias("v"))
    return F.min(pair if where is None else F.when(where, pair))["v"]


def count_where(where: Column, value: Column | None = None) -> Column:
    return F.count(F.when(where, F.lit(1) if value is None else value))


def summarise(df: DataFrame, keys: Sequence[str], outputs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(out) for out, c in outputs.items()])


def attach(base: DataFrame, summaries: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join per-key summaries to their base rows; all sides shuffle on the same key."""
    for part in summaries:
        base = base.join(part, key, "left")
    return base
