"""The window operators give the rows of a plain window, on logs of hot keys and of hot time buckets."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parceltrail.checks import domain
from parceltrail.operators import keyed
from parceltrail.operators.skew import CUT, cut_hot, hot_groups, split_hot, with_bucket
from parceltrail.plans import longest_dwell


def log_of(spark, rows, times):
    """One key holds a third of the rows, times tie, keys and values are sometimes NULL."""
    rng = random.Random(7)
    out = []
    for i in range(rows):
        key = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", "d"])
        out.append((i, key, times(rng), rng.choice([None, "x", "y", "z"]), rng.randrange(100)))
    return spark.createDataFrame(out, "id int, key string, at timestamp_ntz, label string, value int").cache()


START = datetime(2024, 1, 1)
LOGS = {
    "spread": (900, lambda rng: START + timedelta(minutes=rng.randrange(0, 60 * 24 * 3, 10))),
    "one_time": (500, lambda rng: START),
    "no_times": (500, lambda rng: None),
    "some_times": (600, lambda rng: rng.choice([None, None, START, START, START + timedelta(minutes=5), START + timedelta(hours=1)])),
    "borders": (600, lambda rng: START + timedelta(minutes=59, seconds=59) + timedelta(seconds=rng.randrange(3))),
}


@pytest.fixture(scope="module", params=sorted(LOGS))
def log(spark, request):
    return log_of(spark, *LOGS[request.param])


@pytest.fixture(scope="module")
def one_key(spark):
    return spark.range(3_000).selectExpr(
        "CAST(id AS INT) AS id", "'k' AS key", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id * id % 4000 AS INT)) AS at",
        "CASE WHEN id % 5 > 0 THEN CAST(id % 13 AS STRING) END AS label", "CAST(id % 31 AS INT) AS value",
    ).cache()


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_hot_groups_are_the_large_ones(spark):
    log = log_of(spark, *LOGS["spread"])
    assert {row["__hot_key"] for row in hot_groups(log, ["key"], 200).collect()} == {"hot"}
    cold, hot = split_hot(log, ["key"], 100)
    assert cold.count() + hot.count() == log.count()
    assert cold.where("key IS NULL").count() + hot.where("key IS NULL").count() == log.where("key IS NULL").count()


HOT = pytest.mark.parametrize("hot_rows", [None, 40])


def check_neighbours(log, hot_rows):
    order = ["at", "label", "id"]
    lags, leads = {"p1": ("label", 1), "p2": ("label", 2)}, {"n1": ("label", 1), "n2": ("value", 3)}
    got = keyed.neighbours(log, ["key"], order, lags, leads, hot_rows=hot_rows)
    assert got.columns == [*log.columns, "p1", "p2", "n1", "n2"]
    window = Window.partitionBy("key").orderBy(*order)
    want = log.withColumns(
        {
            "p1": F.lag("label", 1).over(window),
            "p2": F.lag("label", 2).over(window),
            "n1": F.lead("label", 1).over(window),
            "n2": F.lead("value", 3).over(window),
        }
    )
    columns = ["id", "p1", "p2", "n1", "n2"]
    assert rows_of(got, *columns) == rows_of(want, *columns)


def check_rank(log, hot_rows):
    got = keyed.attempt_rank(log, ["key"], "at", "n", hot_rows=hot_rows)
    assert got.columns == [*log.columns, "n"]
    want = log.withColumn("n", F.rank().over(Window.partitionBy("key").orderBy("at")).cast("bigint"))
    assert rows_of(got, "id", "n") == rows_of(want, "id", "n")


def check_extreme(log, hot_rows):
    outputs = {"low": ("label", "min"), "high": ("label", "max"), "least": ("value", "min")}
    got = keyed.running_extreme(log, ["key"], "at", outputs, hot_rows=hot_rows)
    assert got.columns == [*log.columns, *outputs]
    up, down = Window.partitionBy("key").orderBy("at"), Window.partitionBy("key").orderBy(F.desc("at"))
    want = log.withColumns({"low": F.min("label").over(up), "high": F.max("label").over(down), "least": F.min("value").over(up)})
    assert rows_of(got, "id", *outputs) == rows_of(want, "id", *outputs)


@HOT
@pytest.mark.parametrize("check", [check_neighbours, check_rank, check_extreme])
def test_plain_windows(log, check, hot_rows):
    check(log, hot_rows)


@pytest.mark.parametrize("hot_rows", [None, 500])
@pytest.mark.parametrize("check", [check_neighbours, check_rank, check_extreme])
def test_one_key(one_key, check, hot_rows):
    check(one_key, hot_rows)


def test_other_buckets(one_key):
    days = one_key.withColumn("day", F.to_date("at"))
    got = keyed.attempt_rank(days, ["key"], "day", "n", bucket=F.date_trunc("MONTH", "day"))
    want = days.withColumn("n", F.rank().over(Window.partitionBy("key").orderBy("day")).cast("bigint"))
    assert rows_of(got, "id", "n") == rows_of(want, "id", "n")


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\), (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_by_default_rows_are_dealt_out_by_key_and_bucket(spark):
    """No row-wise exchange by the key alone, in the default plans; nothing is counted for the list of hot keys."""
    log = log_of(spark, *LOGS["spread"])
    plans = [
        keyed.neighbours(log, ["key"], ["at", "id"], {"p": ("label", 1)}, {"n": ("label", 1)}),
        keyed.attempt_rank(log, ["key"], "at", "n"),
        keyed.running_extreme(log, ["key"], "at", {"low": ("label", "min")}),
    ]
    for df in plans:
        kinds = [re.sub(r"#\d+", "", columns) for columns, _ in exchanges(df)]
        assert kinds[-1] == "key, __bucket, 4" and "__hot_key" not in "".join(kinds)
    assert re.sub(r"#\d+", "", exchanges(plans[0])[0][0]) == "key, __middle, 4"


def test_cuts_split_a_hot_bucket_evenly_and_in_order(spark):
    """One time for all: cuts follow the rest of the order, ties a hash of the row."""
    log = spark.range(20_000).selectExpr("'k' AS key", "timestamp_seconds(0) AS at", "CAST(id % 3 AS INT) AS kind", "id")
    cut = cut_hot(with_bucket(log, "at"), ["key", "__bucket"], ["at", "kind"], 1_000)
    sizes = cut.groupBy(CUT).count().collect()
    assert 150 < len(sizes) < 400 and max(r["count"] for r in sizes) < 2_000
    kinds = [r.kinds for r in cut.groupBy(CUT).agg(F.sort_array(F.collect_set("kind")).alias("kinds")).orderBy(CUT).collect()]
    assert all(a[-1] <= b[0] for a, b in zip(kinds, kinds[1:]))
    small = cut_hot(with_bucket(log, "at"), ["key", "__bucket"], ["at", "kind"], 30_000)
    assert [r[0] for r in small.select(CUT).distinct().collect()] == [0]


def test_attempt_pivot_counts_ties_like_rank(spark):
    log = log_of(spark, *LOGS["spread"])
    got = keyed.attempt_pivot(log.where("key IS NOT NULL"), ["key"], "at", 3, {"at": "at", "worth": "value"})
    ranked = log.where("key IS NOT NULL").withColumn("n", F.rank().over(Window.partitionBy("key").orderBy("at")))
    want = ranked.groupBy("key").agg(
        *[F.max(F.when(F.col("n") == i, F.col("at"))).alias(f"at_{i}") for i in (1, 2, 3)],
        *[F.max(F.when(F.col("n") == i, F.col("value"))).alias(f"worth_{i}") for i in (1, 2, 3)],
    )
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("returned", [False, True])
def test_dwell_is_the_same_with_every_key_hot(spark, sf_dir, returned):
    t = domain.tables(spark, sf_dir)
    usual = longest_dwell(t, domain.CLOCK, returned)
    split = longest_dwell(t, domain.CLOCK, returned, hot_rows=1)
    assert rows_of(usual, *usual.columns) == rows_of(split, *usual.columns)


def test_more_tied_hot_keys_than_any_list_would_hold(spark):
    log = spark.range(6_000).selectExpr("id", "id % 1500 AS key", "timestamp_seconds(id * 60) AS at", "CAST(id % 7 AS INT) AS value")
    assert hot_groups(log, ["key"], 4).count() == 1500
    got = keyed.neighbours(log, ["key"], ["at", "id"], {"p": ("value", 1)}, {"n": ("value", 1)}, hot_rows=4)
    window = Window.partitionBy("key").orderBy("at", "id")
    want = log.withColumns({"p": F.lag("value", 1).over(window), "n": F.lead("value", 1).over(window)})
    assert rows_of(got, "id", "p", "n") == rows_of(want, "id", "p", "n")
