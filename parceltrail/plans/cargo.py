"""Air-cargo reports: parcels per bag and vehicle, and the cargo sheet against them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import DEFAULT_ZONE, local_date, sheet_date, utc_range
from parceltrail.functions.values import joined, numeric
from parceltrail.operators.lookup import decode, left_join_heavy_right, lookup
from parceltrail.operators.summary import at_earliest, at_latest
from parceltrail.plans.parts import BAG_ARRIVED, BAG_SENT, KEY, current_waybills, dated_rows
from parceltrail.sources.tables import Tables

# Text that marks a main hub, and the code whose hub name is set by hand.
HUB_MARK = "MH"
OVERRIDE_CODE = "CGK"
OVERRIDE_HUB = "MH JAKARTA"

AMOUNTS = [
    "standard_shipping_fee",
    "handling_fee",
    "other_fee",
    "insurance_amount",
    "total_shipping_fee",
]
PLACES = [
    "sender_province_name",
    "sender_city_name",
    "sender_district_name",
    "pickup_branch_name",
    "recipient_province_name",
    "recipient_city_name",
    "recipient_district_name",
    "pod_branch_name",
]


@dataclass(frozen=True)
class CargoPeriod:
    """UTC date ranges, ends included: base and arrival scans, sending scans, and shipping of the parcels."""

    first: str = "2023-07-01"
    last: str = "2023-07-31"
    sending_first: str = "2023-06-01"
    shipped_first: str = "2023-04-01"
    shipped_last: str = "2023-08-16"


def bag_scans(t: Tables, period: CargoPeriod, tz: str = DEFAULT_ZONE) -> DataFrame:
    """One row per bag, vehicle and parcel with its first scan date, sending hub and arrival hub.

    One grouped pass replaces a self-join of the scan log per role. A parcel scanned in several hubs takes the
    earliest sending and the latest arrival.
    """
    log = dated_rows(t["waybill_waybill_line"], "record_time", min(period.first, period.sending_first), period.last)
    scans = log.where(
        F.col(KEY).isNotNull()
        & (F.col("bag_no") != "")
        & F.col("vehicle_tag_no").isNotNull()
    )
    time, branch = F.col("record_time"), F.col("operation_branch_name")
    in_base = utc_range("record_time", period.first, period.last)
    at_hub = branch.contains(HUB_MARK)
    sending = at_hub & (F.col("operation_type") == BAG_SENT) & utc_range(time, period.sending_first, period.last)
    arrival = at_hub & (F.col("operation_type") == BAG_ARRIVED) & in_base
    grouped = scans.groupBy("bag_no", "vehicle_tag_no", KEY).agg(
        F.min(F.when(in_base, time)).alias("__first"),
        at_earliest(time, branch, sending).alias("mh_sending"),
        at_latest(time, branch, arrival).alias("mh_arrival"),
    )
    return grouped.where(F.col("__first").isNotNull()).select(
        joined("bag_no", "vehicle_tag_no", KEY).alias("bm_vm_awb"),
        joined("bag_no", "vehicle_tag_no").alias("bm_vm_concat"),
        "bag_no",
        "vehicle_tag_no",
        KEY,
        local_date("__first", tz).alias("record_time"),
        "mh_sending",
        "mh_arrival",
    )


def shipped_parcels(t: Tables, period: CargoPeriod, tz: str = DEFAULT_ZONE) -> DataFrame:
    rows = dated_rows(t["waybill_waybill"], "shipping_time", period.shipped_first, period.shipped_last)
    rows = rows.where((F.col("deleted") == "0") & F.col(KEY).isNotNull())
    rows = decode(current_waybills(rows), t.labels, "express_type", "expressType", "express_type")
    return rows.select(
        KEY,
        local_date("shipping_time", tz).alias("shipping_time"),
        "express_type",
        *AMOUNTS,
        numeric(F.col("item_calculated_weight")).alias("system_weight"),
        (F.col("standard_shipping_fee") + F.col("handling_fee")).alias("system_sf"),
        *PLACES,
    )


def cargo_base(t: Tables, period: CargoPeriod = CargoPeriod(), tz: str = DEFAULT_ZONE, ordered: bool = True) -> DataFrame:
    """Scanned parcels per bag and vehicle with fees, weights and hubs."""
    rows = bag_scans(t, period, tz).join(shipped_parcels(t, period, tz), KEY)
    rows = rows.select(
        "bm_vm_awb",
        "bm_vm_concat",
        "bag_no",
        "vehicle_tag_no",
        KEY,
        "shipping_time",
        "express_type",
        "record_time",
        *AMOUNTS,
        "system_weight",
        "system_sf",
        *PLACES,
        "mh_sending",
        "mh_arrival",
    )
    return rows.orderBy("bag_no", KEY) if ordered else rows


def sheet_rows(sheet: DataFrame) -> DataFrame:
    """The cargo sheet with a real date and the bag-vehicle key."""
    return sheet.withColumns(
        {"report_date": sheet_date("report_date"), "bm_vm_gsheet": joined("bm_code", "vm_code")}
    )


def cargo_hubs(t: Tables) -> DataFrame:
    """Sheet rows with the names of the sending and arrival hubs."""
    rows = sheet_rows(t["smu_template_2"])
    for out, code in {"mh_sending_join": "origin", "mh_arrival_join": "destination_by_issued"}.items():
        rows = lookup(rows, t["a_mh_facility_name_rnd"], {code: "mh_code"}, {out: "mh_name"})
        rows = rows.withColumn(out, F.when(F.col(code) == OVERRIDE_CODE, OVERRIDE_HUB).otherwise(F.col(out)))
    return rows


def cargo_bags(hubs: DataFrame, base: DataFrame) -> DataFrame:
    """Sheet rows (with hub names) against the totals of their bag and vehicle."""
    totals = base.groupBy("bag_no", "vehicle_tag_no", "bm_vm_concat").agg(
        *[F.sum(c).alias(c) for c in [*AMOUNTS, "system_sf", "system_weight"]]
    )
    sheet = hubs.withColumnsRenamed({"mh_sending_join": "mh_sending", "mh_arrival_join": "mh_arrival"})
    return sheet.join(totals, sheet["bm_vm_gsheet"] == totals["bm_vm_concat"], "left")


def cargo_parcels(sheet: DataFrame, base: DataFrame) -> DataFrame:
    """Sheet rows against every parcel of their bag and vehicle.

    Three return columns are read from the base when it has them and are NULL otherwise.
    """
    extra = ["return_flag", "return_pod_branch_name", "pod_or_return_pod_branch"]
    detail = base.select(
        "bag_no",
        "vehicle_tag_no",
        "bm_vm_concat",
        KEY,
        "shipping_time",
        "express_type",
        "record_time",
        *AMOUNTS,
        "system_sf",
        "system_weight",
        F.col("sender_province_name").alias("origin_province"),
        F.col("sender_city_name").alias("origin_city"),
        F.col("sender_district_name").alias("origin_district"),
        "pickup_branch_name",
        F.col("recipient_province_name").alias("destination_province"),
        F.col("recipient_city_name").alias("destination_city"),
        F.col("recipient_district_name").alias("destination_district"),
        "pod_branch_name",
        *[(F.col(c) if c in base.columns else F.lit(None).cast("string")).alias(c) for c in extra],
    )
    return left_join_heavy_right(sheet_rows(sheet), detail, "bm_vm_gsheet", "bm_vm_concat")
