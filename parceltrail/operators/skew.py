"""Keys too large for one task: rows are dealt out by key and time bucket.

A window needs all rows of its partition in one task. The window operators therefore work on (key, time bucket), a whole
hour unless another bucket is given, and carry what crosses the buckets' borders in tables of a few rows per bucket. This is
their only path: nothing is counted first, and a key that holds a third of a log is no task of its own.

What is left is a single bucket that is hot itself, as when all times of a key are equal or NULL. With `hot_rows`, one
pre-aggregated pass counts rows per (key, bucket), and only buckets of at least so many rows are treated apart: the operators
either cut them along the rest of their order (`cut_hot`) or fold rows of equal time (`keyed`). All paths return the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, CUT = "__bucket", "__cut"
#: Borders sampled in a hot bucket, on average, and the steps of the search among them (1023 at most).
BORDERS = 255
STEPS = [1 << k for k in range(9, -1, -1)]


def with_bucket(df: DataFrame, order: str, bucket: Column | None = None) -> DataFrame:
    """Rows with their time bucket. A bucket must be a function of the time that never falls as the time grows."""
    return df.withColumn(BUCKET, F.date_trunc("HOUR", F.col(order).cast("timestamp")) if bucket is None else bucket)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, NULLs too, where `right` has them under a prefix."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys))


def hot_groups(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Keys (under `__hot_`) with at least `min_rows` rows, and their number of rows."""
    counts = df.groupBy(*[F.col(k).alias(f"__hot_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") >= min_rows)


def split_hot(df: DataFrame, keys: Sequence[str], min_rows: int) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of keys with at least `min_rows` rows); NULL keys are keys as well.

    Spark broadcasts the list by its measured size; otherwise both joins shuffle, where AQE splits partitions of hot keys.
    """
    hot = hot_groups(df, keys, min_rows)
    test = same_keys(df, hot, keys, "__hot_")
    return df.join(hot, test, "left_anti"), df.join(hot, test, "left_semi")


def cut_hot(df: DataFrame, by: Sequence[str], order: Sequence[str], min_rows: int) -> DataFrame:
    """Rows with CUT, which splits groups of at least `min_rows` rows along the order into about BORDERS parts.

    A sample of a hot group's rows gives the borders, and a row's cut is the number of borders up to it. Rows that tie in
    the order follow a hash of the whole row, so only rows that are equal in every column must stay together.
    """
    tie = F.xxhash64(*df.columns)
    place = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], tie.alias("tie"))
    hot = hot_groups(df, by, min_rows)
    drawn = F.pmod(F.xxhash64(tie, F.lit(BORDERS)), F.lit(1 << 31)) < BORDERS / F.col("__n") * (1 << 31)
    sample = df.join(hot, same_keys(df, hot, by, "__hot_")).where(drawn)
    borders = sample.groupBy(*[f"__hot_{k}" for k in by]).agg(F.sort_array(F.collect_set(place)).alias("__borders"))
    rows = df.join(borders, same_keys(df, borders, by, "__hot_"), "left")
    upto = F.aggregate(
        F.array(*map(F.lit, STEPS)),
        F.lit(0),
        lambda at, step: F.when(F.get("__borders", at + step - 1) <= place, at + step).otherwise(at),
    )
    cut = F.when(F.col("__borders").isNull(), 0).otherwise(upto)
    return rows.withColumn(CUT, cut).drop("__borders", *[f"__hot_{k}" for k in by])
