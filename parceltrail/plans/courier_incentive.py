"""Courier task ledger: one row per parcel picked up and one per parcel delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock
from parceltrail.functions.courier import account_state, courier_zone
from parceltrail.functions.values import sentinel_pick
from parceltrail.operators.keyed import latest_per_key
from parceltrail.operators.lookup import decode, decode_all, lookup
from parceltrail.operators.sets import stack_rows
from parceltrail.plans.parts import KEY, ORDER_TIES, current_waybills, recent_rows, region_of, walls
from parceltrail.sources.tables import Tables

LOOK_BACK = 76
ORDER_LOOK_BACK = 250

COLUMNS = [
    "waybill_no",
    "waybill_alias",
    "waybill_source",
    "express_type",
    "courier_id",
    "personnel_no",
    "courier_name",
    "courier_status",
    "tgl_tugas",
    "branch_no",
    "branch_name",
    "district_name",
    "city_name",
    "province_name",
    "kanwil_name",
    "work_location",
    "enabled",
    "branch_level",
    "task_type",
    "pickup",
    "pod",
]


def _ledger(t: Tables, rows: DataFrame, branch_id: str, names: dict[str, str], measures: dict[str, Column]) -> DataFrame:
    """Branch, zone and courier account of tasks.

    The parcel number is unique here and every lookup key is unique, so each group of the non-measure columns is one
    row already and the measures are their own sums.
    """
    rows = decode_all(
        rows,
        t.labels,
        {"waybill_source": ("waybill_source", "waybillSource"), "express_type": ("express_type", "expressType")},
    )
    rows = lookup(
        rows,
        t.dimension("res_branch"),
        {branch_id: "id"},
        {"branch_no": "branch_no", "branch_level": "branch_level", "__city": "city_id"},
    )
    rows = decode(rows, t.labels, "branch_level", "branchLevel", "branch_level")
    rows = lookup(rows, t["res_area"], {"__city": "city_id"}, {"province_name": "province_name"})
    rows = region_of(rows, t, {"__region": "province_name"})
    rows = lookup(rows, t.dimension("res_user"), {"courier_id": "id"}, {"personnel_no": "personnel_no", "enabled": "enabled"})
    rows = rows.drop(*names).withColumns({out: F.col(c) for out, c in names.items()})
    rows = rows.withColumn(
        "kanwil_name", courier_zone(F.col("branch_level"), F.col("__region"), F.col("province_name"))
    )
    return rows.withColumns(
        {
            "waybill_alias": F.when(F.col(KEY).isNotNull(), 1),
            "courier_status": account_state(F.col("enabled")),
            "work_location": F.concat("branch_no", F.lit(" - "), "kanwil_name", F.lit(" "), "branch_name"),
            **measures,
        }
    ).select(*COLUMNS)


def pickup_tasks(t: Tables, clock: Clock) -> DataFrame:
    """Parcels shipped in the look-back; a 0 courier id or empty courier name is taken from the newest order."""
    rows = recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time").where(
        (F.col("void_flag") == "0") & (F.col("deleted") == "0")
    )
    rows = current_waybills(rows)
    ordered = recent_rows(t["order_order"].where(F.col(KEY).isNotNull()), ORDER_LOOK_BACK, clock, "input_time")
    ordered = latest_per_key(ordered, [KEY], "update_time", [c for c in ORDER_TIES if c != "update_time"]).select(
        KEY,
        F.col("pickup_courier_id").alias("__order_courier"),
        F.col("pickup_courier_name").alias("__order_courier_name"),
    )
    rows = rows.join(ordered, KEY, "left").withColumns(
        {
            "courier_id": sentinel_pick(F.col("pickup_courier_id"), 0, F.col("__order_courier")),
            "courier_name": sentinel_pick(F.col("pickup_courier_name"), "", F.col("__order_courier_name")),
            "task_type": F.when(F.col("shipping_time").isNotNull(), "Pickup"),
            **walls(clock, tgl_tugas="shipping_time"),
        }
    )
    names = {
        "branch_name": "pickup_branch_name",
        "district_name": "sender_district_name",
        "city_name": "sender_city_name",
    }
    known = F.col(KEY).isNotNull()
    measures = {
        "pickup": F.when(known, 1).otherwise(0).cast("bigint"),
        "pod": F.when(known, 0).cast("bigint"),
    }
    return _ledger(t, rows, "pickup_branch_id", names, measures)


def delivery_tasks(t: Tables, clock: Clock) -> DataFrame:
    """Parcels delivered in the look-back."""
    rows = recent_rows(t["dm_waybill_waybill"], LOOK_BACK, clock, "update_time", "pod_record_time")
    rows = current_waybills(rows.where(F.col("deleted") == "0")).withColumns(
        {
            "courier_id": F.col("pod_courier_id"),
            "courier_name": F.col("pod_courier_name"),
            "task_type": F.when(F.col("pod_record_time").isNotNull(), "POD"),
            **walls(clock, tgl_tugas="pod_record_time"),
        }
    )
    names = {
        "branch_name": "pod_branch_name",
        "district_name": "recipient_district_name",
        "city_name": "recipient_city_name",
    }
    measures = {
        "pickup": F.when(F.col(KEY).isNotNull(), 0).cast("bigint"),
        "pod": F.when(F.col("tgl_tugas").isNotNull(), 1).otherwise(0).cast("bigint"),
    }
    return _ledger(t, rows, "pod_branch_id", names, measures)


def courier_incentive(t: Tables, clock: Clock) -> DataFrame:
    return stack_rows(pickup_tasks(t, clock), delivery_tasks(t, clock))
