"""Return backlog: returned parcels whose return is not delivered yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock, days_between
from parceltrail.functions.status import CONFIRM_BACKLOG, RETURN_BACKLOG, backlog_bucket, return_state
from parceltrail.functions.values import flag
from parceltrail.operators.lookup import decode, decode_all, having_key, lookup
from parceltrail.plans.parts import KEY, current_returns, current_waybills, recent_rows, region_of, walls
from parceltrail.sources.tables import Tables

LOOK_BACK = 62

COLUMNS = [
    "waybill_no",
    "waybill_alias",
    "shipping_time",
    "waybill_source",
    "vip_username",
    "sender_name",
    "sender_cellphone",
    "sender_province_name",
    "sender_city_name",
    "sender_district_name",
    "pickup_branch_name",
    "recipient_district_name",
    "recipient_city_name",
    "recipient_province_name",
    "express_type",
    "service_type",
    "kanwil_name_regist",
    "return_regist_time",
    "return_register_branch",
    "remarks_return",
    "return_confirm_time",
    "return_confirm_status",
    "return_shipping_fee",
    "return_pod_record_time",
    "update_time_rr",
    "return_regist_alias",
    "return_confirm_alias",
    "backlog_confirm_alias",
    "return_pod_alias",
    "backlog_return_flag",
    "aging_backlog_confirm",
    "aging_backlog_return",
    "backlog_confirm_category",
    "backlog_return_category",
]


def open_returns(t: Tables, clock: Clock) -> DataFrame:
    """Newest recent return bill per parcel, as far as it is registered and not delivered."""
    rows = recent_rows(t["waybill_return_bill"], LOOK_BACK, clock, "update_time", "return_record_time")
    bills = current_returns(rows).where(F.col("return_pod_record_time").isNull())
    bills = decode(bills, t.labels, "return_confirm_status", "returnConfirmStatus", "return_confirm_status")
    live_types = t.dimension("return_type").where(F.col("deleted") == 0)
    bills = lookup(bills, live_types, {"return_type_id": "id"}, {"remarks_return": "return_type"})
    bills = bills.withColumns(
        {
            "return_regist_alias": flag(F.col("return_record_time").isNotNull()),
            "return_confirm_alias": flag(F.col("return_confirm_record_time").isNotNull()),
            "return_pod_alias": flag(F.col("return_pod_record_time").isNotNull()),
            **walls(
                clock,
                "return_pod_record_time",
                return_regist_time="return_record_time",
                return_confirm_time="return_confirm_record_time",
                update_time_rr="update_time",
            ),
        }
    )
    return bills.select(
        KEY,
        F.col("return_branch_name").alias("return_register_branch"),
        "remarks_return",
        "return_confirm_status",
        "return_shipping_fee",
        "return_regist_time",
        "return_confirm_time",
        "return_pod_record_time",
        "update_time_rr",
        "return_regist_alias",
        "return_confirm_alias",
        "return_pod_alias",
    )


def return_backlog(t: Tables, clock: Clock) -> DataFrame:
    """One row per parcel in return, with backlog state, aging against the UTC today, and aging buckets.

    Versions of parcels without an open return leave before the newest is picked.
    """
    waybills = recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "update_time").where(
        (F.col("void_flag") == "0") & (F.col("deleted") == "0")
    )
    bills = open_returns(t, clock)
    waybills = having_key(waybills.drop("return_pod_record_time"), bills.select(KEY), KEY)
    rows = current_waybills(waybills).join(bills, KEY)
    rows = decode_all(
        rows,
        t.labels,
        {
            "waybill_source": ("waybill_source", "waybillSource"),
            "express_type": ("express_type", "expressType"),
            "service_type": ("service_type", "serviceType"),
        },
    )
    rows = region_of(rows, t, {"kanwil_name_regist": "recipient_province_name"})
    state, today = F.col("backlog_return_flag"), F.lit(clock.utc_today)
    return (
        rows.withColumns(
            {
                "waybill_alias": F.when(F.col(KEY).isNotNull(), 1),
                "vip_username": F.col("parent_shipping_cleint"),
                "backlog_confirm_alias": F.col("return_regist_alias") - F.col("return_confirm_alias"),
                "backlog_return_flag": return_state(
                    F.col("return_regist_time"), F.col("return_confirm_time"), F.col("return_pod_record_time")
                ),
                "aging_backlog_confirm": days_between(today, "return_regist_time"),
                "aging_backlog_return": days_between(today, "return_confirm_time"),
                **walls(clock, "shipping_time"),
            }
        )
        .withColumns(
            {
                "backlog_confirm_category": backlog_bucket(state, CONFIRM_BACKLOG, F.col("aging_backlog_confirm")),
                "backlog_return_category": backlog_bucket(state, RETURN_BACKLOG, F.col("aging_backlog_return")),
            }
        )
        .select(*COLUMNS)
    )
