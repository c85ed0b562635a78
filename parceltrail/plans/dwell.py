"""Longest stays of parcels at branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock, band, date_of, days_between, local_dt
from parceltrail.functions.values import joined
from parceltrail.operators.keyed import neighbours
from parceltrail.operators.lookup import decode, with_value, without_value
from parceltrail.operators.segments import branch_stays, longest_stays
from parceltrail.operators.sets import stack_rows
from parceltrail.operators.summary import at_latest, summarise
from parceltrail.plans.parts import KEY, current_waybills, recent_rows, recent_scans
from parceltrail.sources.tables import Tables

LOOK_BACK = 93
TOP = 3
MIN_DAYS = 14
MART_DATE = "mart_date"

# Operations that do not open or close a stay.
NOT_OPENING = "Pickup Failure"
NOT_CLOSING = "Confirm Return Bill"
RETURN_HALF = "return process"
FORWARD_HALF = "forward delivery"

COLUMNS = [
    "waybill_no",
    "shipping_time",
    "waybill_source",
    "operation_type",
    "branch_name_1",
    "first_scan_time_branch",
    "previous_branch_name_1",
    "previous_branch_name_2",
    "next_branch_name",
    "operation_type_2",
    "branch_name_2",
    "last_scan_time_branch",
    "last_location",
    "latest_scan_time",
    "return_or_not_last_scan",
    "return_or_not",
    "scan_record_duration_hour",
    "scan_record_duration_sec",
    "ranking",
    "scan_record_duration_day",
    "aging_from_last_scan",
    "scan_record_duration_day_1",
    "rounded_duration_day",
]


def parcels(t: Tables, clock: Clock, returned: bool) -> DataFrame:
    """Current parcels with (or without) a confirmed return, and their confirmation times.

    The newest return bill decides whether a return is confirmed; scans are compared with the confirmations of all
    its versions, of which the earliest and latest are enough.
    """
    waybills = recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time").where(
        (F.col("void_flag") == "0") & (F.col("deleted") == "0") & F.col(KEY).isNotNull()
    )
    base = decode(current_waybills(waybills), t.labels, "waybill_source", "waybillSource", "waybill_source")
    base = base.select(KEY, local_dt("shipping_time", clock.tz).alias("shipping_time"), "waybill_source")
    bills = recent_rows(t["waybill_return_bill"].where(F.col(KEY).isNotNull()), LOOK_BACK, clock, "update_time")
    confirmed = F.col("return_confirm_record_time")
    times = summarise(
        bills,
        [KEY],
        {
            "__confirmed": at_latest(F.col("update_time"), confirmed),
            "__confirmed_first": F.min(confirmed),
            "__confirmed_last": F.max(confirmed),
        },
    )
    return (with_value if returned else without_value)(base, times, KEY, "__confirmed").drop("__confirmed")


def _halves(returned: bool) -> tuple[dict[str, tuple[Column, Column]], Column]:
    """Which scans open and close a stay on the way out and on the way back, and the label of a closing scan.

    Non-returned parcels: closing scans are not limited in time, and the way back starts at the confirmation.
    Returned parcels: the way out ends before it, and the way back starts after it.
    """
    time, first, last = F.col("record_time"), F.col("__confirmed_first"), F.col("__confirmed_last")
    opens, closes = F.col("operation") != NOT_OPENING, F.col("operation") != NOT_CLOSING
    back = (time > first) if returned else (time >= first)
    out_closes = (closes & (time < last)) if returned else closes
    after = F.when(time >= first, RETURN_HALF).otherwise(FORWARD_HALF)
    before_last = F.when(time < last, FORWARD_HALF).otherwise(RETURN_HALF)
    halves = {"out": (opens, out_closes), "back": (back, back)}
    return halves, before_last if returned else after


def stays(t: Tables, clock: Clock, returned: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Branch stays of the parcels. Scans are dealt out by parcel and hour, hours of `hot_rows` scans along their order."""
    scans = recent_scans(t, LOOK_BACK, clock).select(
        KEY,
        "record_time",
        F.col("operation_branch_name").alias("branch"),
        F.col("operation_label").alias("operation"),
    )
    rows = neighbours(
        scans.join(parcels(t, clock, returned), KEY),
        [KEY],
        ["record_time", "operation", "branch"],
        {"previous_branch_name_1": ("branch", 1), "previous_branch_name_2": ("branch", 2)},
        {"next_branch_name": ("branch", 1)},
        hot_rows=hot_rows,
    )
    halves, label = _halves(returned)
    rows = rows.withColumn("side", label)
    return branch_stays(
        rows,
        [KEY, "shipping_time", "waybill_source"],
        "branch",
        "record_time",
        ["operation", "previous_branch_name_1", "previous_branch_name_2", "next_branch_name"],
        ["operation", "side"],
        halves,
    )


def longest_dwell(t: Tables, clock: Clock, returned: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Top stays of at least 14 started days per parcel, forward and return halves ranked together."""
    rows = stays(t, clock, returned, hot_rows)
    side = F.when(F.col("half") == "out", F.col("last_side")).when(F.col("last_time").isNotNull(), RETURN_HALF)
    rows = rows.select(
        KEY,
        "shipping_time",
        "waybill_source",
        F.col("operation").alias("operation_type"),
        F.col("branch").alias("branch_name_1"),
        local_dt("first_time", clock.tz).alias("first_scan_time_branch"),
        "previous_branch_name_1",
        "previous_branch_name_2",
        "next_branch_name",
        F.col("last_operation").alias("operation_type_2"),
        F.when(F.col("last_time").isNotNull(), F.col("branch")).alias("branch_name_2"),
        local_dt("last_time", clock.tz).alias("last_scan_time_branch"),
        F.col("newest_branch").alias("last_location"),
        local_dt("newest_time", clock.tz).alias("latest_scan_time"),
        side.alias("return_or_not_last_scan"),
        F.lit("Return" if returned else "Non-Return").alias("return_or_not"),
    )
    rows = longest_stays(rows, KEY, "first_scan_time_branch", "last_scan_time_branch", TOP, MIN_DAYS)
    return rows.withColumns(
        {
            "scan_record_duration_day": days_between("last_scan_time_branch", "first_scan_time_branch"),
            "aging_from_last_scan": days_between(F.lit(clock.local_today), "latest_scan_time"),
        }
    ).select(*COLUMNS)


def longest_dwell_union(forward: DataFrame, returned: DataFrame, clock: Clock) -> DataFrame:
    """Both stored dwell marts, for parcels shipped 78 to 93 days ago.

    A mart with its partition column (MART_DATE, the date of `shipping_time`) is read from those partitions only.
    """

    def part(mart: DataFrame) -> DataFrame:
        if MART_DATE in mart.columns:
            mart = mart.where(band(MART_DATE, 93, 78, clock)).drop(MART_DATE)
        rows = mart.where(
            band(date_of("shipping_time"), 93, 78, clock) & F.col("first_scan_time_branch").isNotNull()
        )
        return rows.select(
            "*",
            joined("operation_type", "operation_type_2").alias("operation_type_1_2"),
            F.col("branch_name_1").alias("branch_name"),
            F.col("scan_record_duration_hour").alias("leadtime_hour"),
            F.col("scan_record_duration_sec").alias("leadtime_sec"),
        )

    return stack_rows(part(forward), part(returned))
