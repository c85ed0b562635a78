"""Operators per key: row picks, counts, running values, neighbours, attempts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from parceltrail.operators.skew import BUCKET, CUT, cut_hot, same_keys, split_hot, with_bucket


def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first `k` rows of every key in the given order.

    The row number is filtered on its own, so Spark cuts each map partition down to `k` rows per key before the
    shuffle; a hot key reaches one task as at most `k` rows per map partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= k).drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest version of every key; equal times are decided by the tie-break columns, largest first."""
    return pick_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (by, *tiebreak)])


def merge_latest(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Newest versions after more rows came in, from the stored newest versions (one row per key) and the new rows alone.

    Equal to `latest_per_key` over the whole history, in whatever order it came in: late rows lose to newer stored ones.
    Keys without new rows pass by the pick: Spark broadcasts the list of changed keys by its measured size, and then only
    those keys' rows are shuffled. Changes may be repeated.
    """
    changed = changes.select(*[F.col(k).alias(f"__changed_{k}") for k in keys]).distinct()
    test = same_keys(current, changed, keys, "__changed_")
    rivals = current.join(changed, test, "left_semi").unionByName(changes)
    return current.join(changed, test, "left_anti").unionByName(latest_per_key(rivals, keys, by, tiebreak))


def first_per_key(df: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    return pick_per_key(df, keys, [F.col(c).asc_nulls_first() for c in (by, *tiebreak)])


def any_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key. The order columns make the choice repeatable; without them any row may come."""
    if not order:
        return df.dropDuplicates(list(keys))
    return first_per_key(df, keys, order[0], order[1:])


def count_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Non-NULL values per key, one row per key."""
    return df.groupBy(*keys).agg(F.count(value).alias(out))


def group_once(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Collapse repeated rows: every non-measure column is a key, measures are summed."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in sums.items()])


def _carried(rows: DataFrame, carried: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with the carried columns of their group."""
    right = carried.withColumnsRenamed({k: f"__r_{k}" for k in on})
    return rows.join(right, same_keys(rows, right, on, "__r_"), "left").drop(*[f"__r_{k}" for k in on])


def running_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    outputs: Mapping[str, tuple[str, str]],
    bucket: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Running minimum (rows in ascending order) or maximum (descending order) of columns, peers included.

    `outputs` maps a new column to (column, "min" | "max"). Extremes of whole buckets come first: each bucket starts from
    the extreme of the buckets before it. In buckets of `hot_rows` rows, rows of equal time are folded before any window.
    """
    order_of = {"min": F.col(order).asc_nulls_first(), "max": F.col(order).desc_nulls_last()}
    bucket_order = {"min": F.col(BUCKET).asc_nulls_first(), "max": F.col(BUCKET).desc_nulls_last()}
    function = {"min": F.min, "max": F.max}
    pick = {"min": F.least, "max": F.greatest}
    by = [*keys, BUCKET]

    def extremes(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        return rows.groupBy(*groups).agg(*[function[kind](c).alias(f"__t_{out}") for out, (c, kind) in outputs.items()])

    def running(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        inside = {kind: Window.partitionBy(*by).orderBy(order_of[kind]) for kind in function}
        return rows.withColumns({out: function[kind](columns[out]).over(inside[kind]) for out, (_, kind) in outputs.items()})

    df = with_bucket(df, order, bucket)
    # The exchange is asked for: rows that come partitioned by the key alone would satisfy a window by key and bucket.
    rows = df.repartition(*by)
    earlier = {
        f"__c_{out}": function[kind](f"__t_{out}").over(
            Window.partitionBy(*keys).orderBy(bucket_order[kind]).rowsBetween(Window.unboundedPreceding, -1)
        )
        for out, (_, kind) in outputs.items()
    }
    carried = extremes(rows if hot_rows is None else df, by).withColumns(earlier).drop(*[f"__t_{out}" for out in outputs])
    plain = {out: c for out, (c, _) in outputs.items()}
    if hot_rows is None:
        spread = running(_carried(rows, carried, by), plain)
    else:
        cold, hot = split_hot(df, by, hot_rows)
        at_time = running(extremes(hot, [*by, order]), {out: f"__t_{out}" for out in outputs})
        known = _carried(hot, at_time.drop(*[f"__t_{out}" for out in outputs]), [*by, order])
        spread = running(cold.repartition(*by), plain).unionByName(known)
        spread = _carried(spread, carried, by)
    return spread.withColumns(
        {out: pick[kind](F.col(out), F.col(f"__c_{out}")) for out, (_, kind) in outputs.items()}
    ).drop(BUCKET, *[f"__c_{out}" for out in outputs])


def attempt_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    bucket: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Attempt number by ascending time; equal times share a number and leave a gap.

    The number is the rank inside the time bucket plus the rows of earlier buckets. In buckets of `hot_rows` rows, rows are
    counted by time before any window.
    """
    by_time, by = F.col(order).asc_nulls_first(), [*keys, BUCKET]
    df = with_bucket(df, order, bucket)
    rows = df.repartition(*by)
    before = Window.partitionBy(*keys).orderBy(F.col(BUCKET).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows if hot_rows is None else df).groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    carried = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(*by).orderBy(by_time)
    if hot_rows is None:
        ranked = _carried(rows, carried, by).withColumn("__rank", F.rank().over(inside))
    else:
        cold, hot = split_hot(df, by, hot_rows)
        at_time = hot.groupBy(*by, order).agg(F.count(F.lit(1)).alias("__n"))
        smaller = F.coalesce(F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        at_time = at_time.withColumn("__rank", smaller + 1).drop("__n")
        ranked = cold.repartition(*by).withColumn("__rank", F.rank().over(inside).cast("bigint"))
        ranked = _carried(ranked.unionByName(_carried(hot, at_time, [*by, order])), carried, by)
    return ranked.withColumn(out, F.col("__rank") + F.col("__before")).drop(BUCKET, "__rank", "__before")


def attempt_pivot(
    df: DataFrame, keys: Sequence[str], order: str, attempts: int, outputs: Mapping[str, str]
) -> DataFrame:
    """Columns for the first attempts of every key: `<prefix>_1` .. `<prefix>_<attempts>`, the maximum over ties.

    `outputs` maps a prefix to a column. Attempts sharing a time are folded before any row is ranked, and only the
    first distinct times of a key can hold one of the wanted numbers, so a hot key is cut down map-side.
    """
    folded = df.groupBy(*keys, order).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max(c).alias(f"__m_{prefix}") for prefix, c in outputs.items() if c != order],
    )
    early = pick_per_key(folded, keys, [F.col(order).asc_nulls_first()], attempts)
    before = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
    ranked = early.withColumn(
        "__id", F.coalesce(F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    )
    cells = [
        F.max(F.when(F.col("__id") == i, F.col(order if c == order else f"__m_{prefix}"))).alias(f"{prefix}_{i}")
        for prefix, c in outputs.items()
        for i in range(1, attempts + 1)
    ]
    return ranked.groupBy(*keys).agg(*cells)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lags: Mapping[str, tuple[str, int]],
    leads: Mapping[str, tuple[str, int]],
    bucket: Column | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Values of earlier and later rows of the same key.

    `lags` and `leads` map a new column to (column, distance). `order` starts with the time column and should be a total
    order. A first window looks around inside each time bucket. Rows within reach of a bucket's border take what lies
    beyond it from a second window over such rows alone; the others keep their bucket there. Buckets of `hot_rows` rows are
    cut along the rest of the order, and the cuts are buckets of their own.
    """
    parts = [BUCKET]
    rows = with_bucket(df, order[0], bucket)
    if hot_rows is not None:
        rows, parts = cut_hot(rows, [*keys, BUCKET], order, hot_rows), [BUCKET, CUT]
    # The exchange is asked for: rows that come partitioned by the key alone would satisfy a window by key and bucket.
    rows = rows.repartition(*keys, *parts)
    reach = max(n for _, n in [*lags.values(), *leads.values()])
    inside = Window.partitionBy(*keys, *parts).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = _shifted(rows, inside, lags, leads).withColumns(
        {"__pos": F.row_number().over(inside), "__left": F.count(F.lit(1)).over(inside.rowsBetween(1, reach))}
    )
    middle = (F.col("__pos") > reach) & (F.col("__left") >= reach)
    placed = placed.withColumn("__middle", F.when(middle, F.struct(*parts)))
    across = Window.partitionBy(*keys, "__middle").orderBy(*[F.col(c).asc_nulls_first() for c in parts], F.col("__pos"))
    beyond = _shifted(
        placed,
        across,
        {f"__x_{out}": shift for out, shift in lags.items()},
        {f"__x_{out}": shift for out, shift in leads.items()},
    )
    known = {out: F.col("__pos") > n for out, (_, n) in lags.items()} | {out: F.col("__left") >= n for out, (_, n) in leads.items()}
    picked = {out: F.when(there, F.col(out)).otherwise(F.col(f"__x_{out}")) for out, there in known.items()}
    return beyond.withColumns(picked).drop(*parts, "__pos", "__left", "__middle", *[f"__x_{out}" for out in known])


def _shifted(
    rows: DataFrame, window: WindowSpec, lags: Mapping[str, tuple[str, int]], leads: Mapping[str, tuple[str, int]]
) -> DataFrame:
    return rows.withColumns(
        {
            **{out: F.lag(c, n).over(window) for out, (c, n) in lags.items()},
            **{out: F.lead(c, n).over(window) for out, (c, n) in leads.items()},
        }
    )
