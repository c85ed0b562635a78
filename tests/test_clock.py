from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import utc
from parceltrail.functions import clock
from parceltrail.functions.clock import Clock
from parceltrail.functions.values import exactly_one, joined, safe_int, sentinel_pick


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()
    return row["x"]


def test_today_depends_on_the_zone():
    early, late = Clock.at("2024-01-31T03:00:00Z"), Clock.at("2024-01-31T18:00:00Z")
    assert (early.utc_today, early.local_today) == (date(2024, 1, 31), date(2024, 1, 31))
    assert (late.utc_today, late.local_today) == (date(2024, 1, 31), date(2024, 2, 1))


@pytest.mark.parametrize(("text", "day"), [("2024-01-10 16:59:59", date(2024, 1, 10)), ("2024-01-10 17:00:00", date(2024, 1, 11))])
def test_local_date_turns_at_17_utc(spark, text, day):
    assert one(spark, clock.local_date("t"), t=utc(text)) == day


@pytest.mark.parametrize(
    ("text", "flags"),
    [
        ("2024-01-10 06:59:59", (0, 0)),
        ("2024-01-10 07:00:00", (1, 0)),
        ("2024-01-10 07:59:59", (1, 0)),
        ("2024-01-10 08:00:00", (1, 1)),
    ],
)
def test_cutoffs(spark, text, flags):
    got = tuple(one(spark, clock.past_cutoff("t", c), t=utc(text)) for c in ("14:00:00", "15:00:00"))
    assert got == flags


def test_hours_count_boundaries(spark):
    assert one(spark, clock.hours_crossed("b", "a"), a=utc("2024-01-01 00:59:00"), b=utc("2024-01-01 01:01:00")) == 1
    assert one(spark, clock.hours_crossed("b", "a"), a=utc("2024-01-01 00:00:00"), b=utc("2024-01-01 00:59:59")) == 0
    assert one(spark, clock.seconds_crossed("b", "a"), a=utc("2024-01-01 00:59:00"), b=utc("2024-01-01 01:01:00")) == 120


def test_days_count_boundaries(spark):
    assert one(spark, clock.days_between("b", "a"), a=utc("2024-01-01 23:59:00"), b=utc("2024-01-02 00:01:00")) == 1


def test_recent_includes_the_first_local_day(spark):
    now = Clock.at("2024-01-31T03:00:00Z")
    rows = spark.createDataFrame([(utc("2024-01-28 16:59:59"),), (utc("2024-01-28 17:00:00"),)], "t timestamp")
    kept = [r["t"] for r in rows.where(clock.recent("t", 2, now)).collect()]
    assert len(kept) == 1 and kept[0].hour == 17


def test_utc_range_has_closed_ends(spark):
    rows = spark.createDataFrame(
        [(utc("2023-06-30 23:59:59"),), (utc("2023-07-01 00:00:00"),), (utc("2023-07-31 23:59:59"),), (utc("2023-08-01 00:00:00"),)],
        "t timestamp",
    )
    assert rows.where(clock.utc_range("t", "2023-07-01", "2023-07-31")).count() == 2


def test_sheet_dates_accept_one_digit(spark):
    assert one(spark, clock.sheet_date("t"), t="7/1/2023") == date(2023, 7, 1)
    assert one(spark, clock.sheet_date("t"), t="07/01/2023") == date(2023, 7, 1)


@pytest.mark.parametrize(("text", "number"), [("3", 3), ("3 hari", None), ("3.5", None), ("999", 999), (None, None)])
def test_safe_int(spark, text, number):
    assert one(spark, safe_int(F.col("t")), t=text) == number if text else True


def test_small_values(spark):
    assert one(spark, sentinel_pick(F.col("a"), 0, F.lit(7)), a=0) == 7
    assert one(spark, sentinel_pick(F.col("a"), "", F.lit("b")), a="c") == "c"
    assert one(spark, joined("a", "b"), a="x", b="y") == "x - y"
    assert one(spark, joined("a", F.lit(None).cast("string")), a="x") is None
    assert one(spark, exactly_one(F.col("a"), F.lit(None).cast("string")), a="x") == "x"
    assert one(spark, exactly_one(F.col("a"), F.lit("y")), a="x") is None
