"""One-pass summaries equal the running-window form they replace."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parceltrail.operators.keyed import latest_per_key
from parceltrail.operators.summary import at_earliest, at_latest, count_where, summarise


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = [
        (
            rng.randrange(30),
            start + timedelta(hours=rng.randrange(6)),
            rng.choice([None, None, "a", "b", "c"]),
            rng.choice(["09", "18", "05"]),
        )
        for _ in range(600)
    ]
    return spark.createDataFrame(rows, "key int, at timestamp_ntz, label string, code string").cache()


def test_latest_and_earliest_take_extremes_over_ties(log):
    got = summarise(
        log, ["key"], {"last": at_latest(F.col("at"), F.col("label")), "first": at_earliest(F.col("at"), F.col("label"))}
    )
    down = Window.partitionBy("key").orderBy(F.desc("at"))
    up = Window.partitionBy("key").orderBy("at")
    edges = log.withColumns(
        {
            "last": F.max("label").over(down),
            "first": F.min("label").over(up),
            "d": F.rank().over(down),
            "u": F.rank().over(up),
        }
    )
    want_last = {(r["key"], r["last"]) for r in edges.where("d = 1").collect()}
    want_first = {(r["key"], r["first"]) for r in edges.where("u = 1").collect()}
    rows = got.collect()
    assert {(r["key"], r["last"]) for r in rows} == want_last
    assert {(r["key"], r["first"]) for r in rows} == want_first


def test_condition_limits_the_rows(log):
    got = summarise(
        log,
        ["key"],
        {
            "n": count_where(F.col("code") == "18", F.col("label")),
            "last": at_latest(F.col("at"), F.col("label"), F.col("code") == "18"),
        },
    )
    part = log.where("code = '18'")
    want = {r["key"]: r["n"] for r in part.groupBy("key").agg(F.count("label").alias("n")).collect()}
    newest = {r["key"]: r["last"] for r in summarise(part, ["key"], {"last": at_latest(F.col("at"), F.col("label"))}).collect()}
    for row in got.collect():
        assert row["n"] == want.get(row["key"], 0)
        assert row["last"] == newest.get(row["key"])


def test_latest_per_key_keeps_one_row_per_key_and_null(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "p"), (None, 6, "q")], "k string, v int, t string"
    )
    got = {(r["k"], r["v"], r["t"]) for r in latest_per_key(rows, ["k"], "v", ["t"]).collect()}
    assert got == {("a", 2, "z"), (None, 6, "q")}
