"""Steps that several reports share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock, local_dt, recent, utc_range
from parceltrail.operators.keyed import latest_per_key
from parceltrail.operators.lookup import Dimension, decode, lookup
from parceltrail.operators.summary import at_earliest, at_latest, count_where
from parceltrail.sources.tables import Tables, utc_date_column

# Operation and problem codes of the scan log.
DELIVERY_ATTEMPT = "09"
PROBLEM_SCAN = "18"
BAG_SENT = "04"
BAG_ARRIVED = "05"
IGNORED_PROBLEM_TYPE = "02"

# Equal version times are decided by these columns.
ORDER_TIES = ["update_time", "input_time", "order_no"]
WAYBILL_TIES = ["shipping_time", "order_no"]
RETURN_TIES = ["return_record_time", "return_waybill_no"]

KEY = "waybill_no"


def all_of(*tests: Column) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


def recent_rows(df: DataFrame, days: int, clock: Clock, *times: str) -> DataFrame:
    """Rows in the look-back. A date partition of one of the times (see Tables.from_parquet) bounds what is read."""
    dates = {c: utc_date_column(c) for c in times if utc_date_column(c) in df.columns}
    return df.where(all_of(*[recent(c, days, clock, dates.get(c)) for c in times])).drop(*dates.values())


def dated_rows(df: DataFrame, time: str, first: str, last: str) -> DataFrame:
    """Rows of a closed UTC date range, read from its date partitions if the table has them."""
    date = utc_date_column(time)
    rows = df.where(utc_range(time, first, last))
    return rows.where(F.col(date).between(F.lit(first), F.lit(last))).drop(date) if date in df.columns else rows


def current_orders(rows: DataFrame, by: str) -> DataFrame:
    """Newest version of every order; all orders without a parcel number count as one key."""
    return latest_per_key(rows, [KEY], by, [c for c in ORDER_TIES if c != by])


def current_waybills(rows: DataFrame) -> DataFrame:
    return latest_per_key(rows, [KEY], "update_time", WAYBILL_TIES)


def current_returns(rows: DataFrame) -> DataFrame:
    """Newest return bill per parcel. Rows without a parcel number can match nothing and are left out."""
    return latest_per_key(rows.where(F.col(KEY).isNotNull()), [KEY], "update_time", RETURN_TIES)


def walls(clock: Clock, *names: str, **renamed: str) -> dict[str, Column]:
    """Wall-clock columns: each name from itself, each keyword from the column it names."""
    return {out: local_dt(c, clock.tz) for out, c in {**{n: n for n in names}, **renamed}.items()}


def active_problem_codes(t: Tables) -> Dimension:
    return t.dimension("res_problem_package")


def region_of(df: DataFrame, t: Tables, roles: Mapping[str, str]) -> DataFrame:
    """Regional office by province: output name -> province column."""
    for out, province in roles.items():
        df = lookup(df, t.dimension("mapping_kanwil_area"), {province: "province_name"}, {out: "kanwil_name"})
    return df


def island_of(df: DataFrame, t: Tables, roles: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Island area by (city, province): output name -> (city column, province column)."""
    dim = t.dimension("masterdata_city_mapping_area_island_new")
    for out, (city, province) in roles.items():
        df = lookup(df, dim, {city: "city", province: "province"}, {out: "pulau"})
    return df


def recent_scans(t: Tables, days: int, clock: Clock) -> DataFrame:
    """Scans of known parcels in the look-back, with the decoded operation."""
    rows = recent_rows(t["waybill_waybill_line"].where(F.col(KEY).isNotNull()), days, clock, "record_time")
    return decode(rows, t.labels, "operation_type", "operationType", "operation_label")


def recent_problems(t: Tables, days: int, clock: Clock) -> DataFrame:
    """Problem records in the look-back without the ignored type, with the decoded type."""
    rows = t["waybill_problem_piece"].where(F.col(KEY).isNotNull() & (F.col("problem_type") != IGNORED_PROBLEM_TYPE))
    rows = recent_rows(rows, days, clock, "operation_time")
    return decode(rows, t.labels, "problem_type", "problemType", "problem_label")


def attempt_columns() -> dict[str, Column]:
    """First and last delivery attempt (instants) and the number of decoded attempts."""
    attempt = F.col("operation_type") == DELIVERY_ATTEMPT
    time = F.when(attempt, F.col("record_time"))
    return {
        "first_deliv_attempt": F.min(time),
        "last_deliv_attempt": F.max(time),
        "count_deliv_attempt": count_where(attempt, F.col("operation_label")),
    }


def place_columns() -> dict[str, Column]:
    """Last location, activity and scan time (instant): each the largest value at the latest time."""
    time = F.col("record_time")
    return {
        "last_location": at_latest(time, F.col("operation_branch_name")),
        "last_activity": at_latest(time, F.col("operation_label")),
        "last_scan_time": F.max(time),
    }


def problem_scan_columns() -> dict[str, Column]:
    """Branch and photo of the first problem scan, photo of the last, ignoring one problem type."""
    scan = (F.col("operation_type") == PROBLEM_SCAN) & (F.col("problem_type") != IGNORED_PROBLEM_TYPE)
    time, branch, photo = F.col("record_time"), F.col("operation_branch_name"), F.col("photo_url")
    return {
        "first_problem_branch": at_earliest(time, branch, scan),
        "first_problem_photo": at_earliest(time, photo, scan),
        "last_problem_photo": at_latest(time, photo, scan),
    }


def columns_in_order(df: DataFrame, outputs: Sequence[str] | Mapping[str, str]) -> DataFrame:
    if isinstance(outputs, Mapping):
        return df.selectExpr(*[f"`{c}` AS `{out}`" for out, c in outputs.items()])
    return df.select(*outputs)
