"""Open parcels of the seller portal with repeated delivery problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock, local_dt
from parceltrail.functions.delivery import SIGNED
from parceltrail.functions.pickup import SELLER_PORTAL
from parceltrail.functions.status import RETURN_RECEIVED
from parceltrail.operators.keyed import attempt_pivot
from parceltrail.operators.lookup import decode_all, having_key
from parceltrail.operators.summary import at_latest, attach, count_where, summarise
from parceltrail.plans.parts import (
    DELIVERY_ATTEMPT,
    KEY,
    PROBLEM_SCAN,
    current_waybills,
    recent_problems,
    recent_rows,
    recent_scans,
    walls,
)
from parceltrail.sources.tables import Tables

LOOK_BACK = 62
ATTEMPTS = 3

COLUMNS = [
    "waybill_no",
    "shipping_time",
    "waybill_source",
    "vip_username",
    "pickup_branch_name",
    "sender_province_name",
    "sender_city_name",
    "recipient_province_name",
    "recipient_city_name",
    "waybill_status",
    "deliv_attempt_1",
    "pos_attempt_1",
    "pos_reason_1",
    "deliv_attempt_2",
    "pos_attempt_2",
    "pos_reason_2",
    "last_location",
    "count_pos_attempt",
    "count_deliv_attempt",
]


def open_vip_versions(t: Tables, clock: Clock) -> DataFrame:
    """Versions of seller-portal parcels that are neither delivered nor returned."""
    rows = recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time").where(
        (F.col("void_flag") == "0")
        & (F.col("deleted") == "0")
        & F.col("pod_record_time").isNull()
        & F.col("return_pod_record_time").isNull()
        & F.col(KEY).isNotNull()
    )
    rows = decode_all(
        rows,
        t.labels,
        {"waybill_source": ("waybill_source", "waybillSource"), "waybill_status": ("waybill_status", "waybillStatus")},
    )
    return rows.where(
        (F.col("waybill_source") == SELLER_PORTAL) & ~F.col("waybill_status").isin(SIGNED, RETURN_RECEIVED)
    )


def vip_problem_check(t: Tables, clock: Clock, min_problems: int = 2) -> DataFrame:
    """One row per open parcel with at least `min_problems` problem scans.

    The logs are cut down to the open parcels before they are summarised. The scan log is read once: its rows are folded
    by parcel and time, which keeps what counts, last place and attempt numbers need.
    """
    versions = open_vip_versions(t, clock)
    base = current_waybills(versions)
    keys = base.select(KEY)
    scans = having_key(recent_scans(t, LOOK_BACK, clock), keys, KEY)
    problems = having_key(recent_problems(t, LOOK_BACK, clock), keys, KEY)

    is_problem = F.col("operation_type") == PROBLEM_SCAN
    is_attempt = F.col("operation_type") == DELIVERY_ATTEMPT
    folded = summarise(
        scans,
        [KEY, "record_time"],
        {
            "__place": F.max("operation_branch_name"),
            "__problems": count_where(is_problem),
            "__labels": count_where(is_attempt, F.col("operation_label")),
            "__attempts": count_where(is_attempt),
        },
    )
    earlier = Window.partitionBy(KEY).orderBy("record_time").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum("__attempts").over(earlier), F.lit(0)) + 1
    attempted = F.sum("__attempts") > 0
    at = F.when(F.col("__attempts") > 0, local_dt("record_time", clock.tz))
    per_scan = summarise(
        folded.withColumn("__number", number),
        [KEY],
        {
            "last_location": at_latest(F.col("record_time"), F.col("__place")),
            "count_pos_attempt": F.sum("__problems"),
            "count_deliv_attempt": F.when(attempted, F.sum("__labels")),
            **{f"deliv_attempt_{i}": F.max(F.when(F.col("__number") == i, at)) for i in range(1, ATTEMPTS + 1)},
        },
    ).where(F.col("count_pos_attempt") >= min_problems)
    failures = attempt_pivot(
        problems.withColumn("operation_time", local_dt("operation_time", clock.tz)),
        [KEY],
        "operation_time",
        ATTEMPTS,
        {"pos_attempt": "operation_time", "pos_reason": "problem_reason"},
    )
    rows = attach(base.join(per_scan, KEY), [failures], KEY)
    return rows.withColumns({"vip_username": F.col("vip_customer_name"), **walls(clock, "shipping_time")}).select(
        *COLUMNS
    )
