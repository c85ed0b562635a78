"""Rule order and arms, on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parceltrail.functions import courier, delivery, pickup, reasons, status
from parceltrail.functions.rules import buckets, first_match

TODAY = date(2024, 1, 31)


def results(spark, schema, rows, column):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r["x"] for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


def test_first_match_and_buckets(spark):
    rule = first_match([(F.col("n") > 5, "big"), (F.col("n") > 1, "some")], "none")
    assert results(spark, "n int", [(9,), (3,), (0,), (None,)], rule) == ["big", "some", "none", "none"]
    ranges = buckets(F.col("n"), [(None, 2, "low"), (3, 7, "mid"), (8, None, "high")])
    assert results(spark, "n int", [(-1,), (2,), (3,), (7,), (8,), (None,)], ranges) == ["low", "low", "mid", "mid", "high", None]
    with pytest.raises(ValueError):
        first_match([])


def test_every_reason_has_its_category(spark):
    listed = [(reason, name) for name, group in reasons.PROBLEM_CATEGORIES.items() for reason in group]
    got = results(spark, "r string", [(r,) for r, _ in listed], reasons.problem_category(F.col("r")))
    assert got == [name for _, name in listed]
    odd = [("ditolak bea cukai",), ("Rejected by customs",), ("unknown",), (None,)]
    assert results(spark, "r string", odd, reasons.problem_category(F.col("r"))) == [reasons.CUSTOMS_CATEGORY] * 2 + [None] * 2


def test_courier_missing_is_in_the_factor_list_only(spark):
    rows = [("Kurir tidak available",), (None,), ("Late scan POD",)]
    assert results(spark, "r string", rows, reasons.delivery_factor(F.col("r"))) == ["IDE", "IDE", "IDE"]
    assert results(spark, "r string", rows, reasons.delivery_control(F.col("r"))) == [None, "Controllable", "Controllable"]


def test_late_reason(spark):
    rows = [("Paket pre order", "p"), (None, "p"), (None, None), ("Paket rusak/pecah", "p")]
    got = results(spark, "r string, p string", rows, reasons.late_reason(F.col("r"), F.col("p")))
    assert got == [None, "p", None, "Paket rusak/pecah"]


def test_pickup_against_slot(spark):
    day = datetime(2024, 1, 30)
    rows = [
        ("Pick up", day, day),
        ("Pick up", datetime(2024, 1, 30, 1), day),
        ("Pick up", None, datetime(2024, 1, 31)),
        ("Pick up", None, day),
        ("Drop off", None, day),
        ("Pick up", None, None),
    ]
    sla = pickup.generic_sla(F.col("s"), F.col("p"), F.col("e"), TODAY)
    got = results(spark, "s string, p timestamp_ntz, e timestamp_ntz", rows, sla)
    assert got == ["On Time", "Late", "Not Pick up Yet", "Late", None, None]


def test_cancelled_orders(spark):
    rows = [("Blibli", "Cancel Order", None), ("Blibli", None, None), ("Other", "Cancel Order", None), (None, "Cancel Order", None)]
    placed = F.lit(datetime(2024, 1, 30)).cast("timestamp_ntz")
    args = (F.col("s"), F.col("o"), F.col("p"), placed, F.lit(0), TODAY)
    schema = "s string, o string, p timestamp_ntz"
    assert results(spark, schema, rows, pickup.blibli_sla(*args)) == ["Cancel Order", "Late", None, None]
    assert results(spark, schema, rows, pickup.other_sla(*args)) == [None, None, "Cancel Order", None]
    shopee = [("Shopee platform", "Cancel Order", None), ("Shopee platform", "x", None), ("Shopee platform", None, None)]
    sla = pickup.shopee_sla(F.col("s"), F.col("o"), F.col("p"), placed, TODAY)
    assert results(spark, schema, shopee, sla) == [None, "Not Pick Up Yet", None]


def test_delivery_performance(spark):
    shipped = datetime(2024, 1, 10, 18)
    rows = [
        ("Other", "999", None),
        ("Other", None, None),
        ("Other", "3", datetime(2024, 1, 13, 16)),
        ("Other", "3", datetime(2024, 1, 13, 17)),
        ("Other", "30", None),
        ("Other", "3", None),
        (None, "3", None),
        ("Blibli", None, None),
    ]
    result = delivery.sla_performance(
        F.col("s"), F.lit(shipped).cast("timestamp_ntz"), F.col("d"), F.lit(None).cast("bigint"), F.col("sla").cast("bigint"), TODAY
    )
    got = results(spark, "s string, sla string, d timestamp_ntz", rows, result)
    assert got == ["No SLA (OoC)", "Hit SLA", "Hit SLA", "Not Hit", None, "Not Hit", None, None]


def test_return_state_and_negative_aging(spark):
    t = datetime(2024, 1, 1)
    rows = [(t, None, None), (t, t, None), (t, t, t), (None, t, t)]
    state = status.return_state(F.col("a"), F.col("b"), F.col("c"))
    got = results(spark, "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz", rows, state)
    assert got == ["Backlog Confirm Return", "Backlog Return", "POD Return", None]
    bucket = status.backlog_bucket(F.lit("Backlog Return"), "Backlog Return", F.col("n"))
    edges = [(-1,), (2,), (3,), (7,), (8,), (14,), (15,), (30,), (31,)]
    assert results(spark, "n int", edges, bucket) == ["<3 Days", "<3 Days", "3-7 Days", "3-7 Days", "8-14 Days", "8-14 Days", "15-30 Days", "15-30 Days", ">30 Days"]


def test_customs_on_a_delivered_parcel(spark):
    void = F.lit(None).cast("string")
    rows = [("Signed", "ditolak bea cukai"), ("Delivering", "ditolak bea cukai"), (None, "Rejected by customs")]
    nothing = F.lit(None).cast("timestamp_ntz")
    ladder = status.report_status(void, F.col("w"), void, nothing, nothing, nothing, void, F.col("r"))
    assert results(spark, "w string, r string", rows, ladder) == ["Delivered", "Undelivered", "Cancel Order"]


def test_courier_zone_order(spark):
    rows = [
        ("TH", "JAWA BARAT", "DKI JAKARTA"),
        ("PDB", "JAWA BARAT", "BANTEN"),
        ("TH", "SUMATERA BAGIAN UTARA", "BANTEN"),
        ("TH", "BALI", "BALI"),
        ("MH", "JAWA BARAT", "BANTEN"),
        (None, "JAWA BARAT", "BANTEN"),
    ]
    zone = courier.courier_zone(F.col("l"), F.col("k"), F.col("p"))
    assert results(spark, "l string, k string, p string", rows, zone) == ["Jakarta", "Tangerang", "Sumbagut", None, "MH", None]
