"""Stays of a parcel at a branch, from its scan log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parceltrail.functions.clock import hours_crossed, seconds_crossed


def branch_stays(
    scans: DataFrame,
    keys: Sequence[str],
    branch: str,
    time: str,
    first: Sequence[str],
    last: Sequence[str],
    halves: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """One row per key, branch and half of the journey that has a first scan.

    `halves` maps a name to (which scans may open the stay, which may close it). The row has the half's name, the
    first scan's time and `first` columns, the closing scan's time and `last` columns (prefixed `last_`, NULL when
    no scan may close the stay), and the key's latest branch and time over all scans.
    """
    opening = F.struct(F.col(time).alias("at"), *first)
    closing = F.struct(F.col(time).alias("at"), *last)
    aggregates = [F.max(time).alias("__latest")]
    for i, (may_open, may_close) in enumerate(halves.values()):
        aggregates.append(F.min(F.when(may_open, opening)).alias(f"__open{i}"))
        aggregates.append(F.max(F.when(may_close, closing)).alias(f"__close{i}"))
    per_branch = scans.groupBy(*keys, branch).agg(*aggregates)

    newest = F.max(F.struct(F.col("__latest").alias("at"), F.col(branch).alias("branch")))
    per_branch = per_branch.withColumn("__newest", newest.over(Window.partitionBy(keys[0])))
    stays = [
        F.struct(
            F.lit(name).alias("half"),
            F.col(f"__open{i}").alias("open"),
            F.when(F.col(branch).isNotNull(), F.col(f"__close{i}")).alias("close"),
        )
        for i, name in enumerate(halves)
    ]
    rows = per_branch.withColumn("__stay", F.explode(F.array(*stays))).where(F.col("__stay.open").isNotNull())
    return rows.select(
        *keys,
        branch,
        F.col("__stay.half").alias("half"),
        F.col("__stay.open.at").alias("first_time"),
        *[F.col(f"__stay.open.{c}").alias(c) for c in first],
        F.col("__stay.close.at").alias("last_time"),
        *[F.col(f"__stay.close.{c}").alias(f"last_{c}") for c in last],
        F.col("__newest.branch").alias("newest_branch"),
        F.col("__newest.at").alias("newest_time"),
    )


def longest_stays(stays: DataFrame, key: str, first: str, last: str, top: int, min_days: int) -> DataFrame:
    """The longest stays of every key, ties included, that last at least `min_days` started days.

    Adds hours and seconds (boundaries crossed), the rank, and hours as exact and rounded-up days. The rank covers
    all stays of a key; the day limit comes after it.
    """
    timed = stays.withColumns(
        {
            "scan_record_duration_hour": hours_crossed(last, first),
            "scan_record_duration_sec": seconds_crossed(last, first),
        }
    )
    window = Window.partitionBy(key).orderBy(F.col("scan_record_duration_sec").desc_nulls_last())
    ranked = timed.where(F.col(key).isNotNull()).withColumn("ranking", F.rank().over(window))
    days = F.col("scan_record_duration_hour") / 24
    return (
        ranked.where(F.col("ranking") <= top)
        .withColumns({"scan_record_duration_day_1": days, "rounded_duration_day": F.ceil(days).cast("double")})
        .where(F.col("rounded_duration_day") >= min_days)
    )
