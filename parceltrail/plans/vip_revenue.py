"""Seller-portal revenue, delivery and aging per day, seller and destination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions.clock import Clock, date_of, days_between
from parceltrail.functions.pickup import SELLER_PORTAL
from parceltrail.functions.status import vip_status
from parceltrail.functions.values import flag
from parceltrail.operators.lookup import decode, decode_all, lookup
from parceltrail.operators.summary import at_latest, attach, summarise
from parceltrail.plans.parts import KEY, current_waybills, recent_problems, recent_rows, region_of, walls
from parceltrail.sources.tables import Tables

LOOK_BACK = 93

# The two seller classes and the division that marks partner sellers.
PARTNER_SELLER = "VIP Seller Amartha"
HEAD_OFFICE_SELLER = "VIP Seller HO"
PARTNER_DIVISION = "Mitra"

GROUP = [
    "shipping_date",
    "waybill_source",
    "vip_username",
    "source_category",
    "waybill_status",
    "return_flag",
    "last_status",
    "service_type",
    "express_type",
    "kanwil_name",
    "recipient_province_name",
    "recipient_city_name",
    "recipient_district_name",
    "th_destination",
    "pos_reason",
    "aging_from_pickup_to_date",
    "leadtime_pickup_to_pod",
]


def vip_parcels(t: Tables, clock: Clock) -> DataFrame:
    rows = recent_rows(t["dm_waybill_waybill"], LOOK_BACK, clock, "shipping_time").where(F.col("void_flag") == "0")
    rows = decode(rows, t.labels, "waybill_source", "waybillSource", "waybill_source")
    rows = current_waybills(rows.where(F.col("waybill_source") == SELLER_PORTAL))
    rows = decode_all(
        rows,
        t.labels,
        {
            "waybill_status": ("waybill_status", "waybillStatus"),
            "return_flag": ("return_flag", "returnFlag"),
            "service_type": ("service_type", "serviceType"),
            "express_type": ("express_type", "expressType"),
        },
    )
    rows = lookup(
        rows, t.dimension("masterdata_branch_coverage_th"), {"recipient_district_id": "district_id"}, {"__hub": "branch_name"}
    )
    rows = lookup(
        rows,
        t.dimension("masterdata_sales_seller_vip"),
        {"vip_customer_name": "seller_name"},
        {"__division": "division", "__sales": "sales_name"},
    )
    rows = region_of(rows, t, {"kanwil_name": "recipient_province_name"})
    division, sales = F.col("__division"), F.col("__sales")
    partner = ((division == PARTNER_DIVISION) & (sales == PARTNER_DIVISION)) | (division.isNull() & sales.isNull())
    return rows.withColumns(
        {
            "vip_username": F.col("parent_shipping_cleint"),
            "source_category": F.when(partner, PARTNER_SELLER).otherwise(HEAD_OFFICE_SELLER),
            "th_destination": F.coalesce("delivery_branch_name", "__hub"),
            "last_status": vip_status(
                F.col("waybill_status"),
                F.col("return_flag"),
                F.col("pod_record_time"),
                F.col("return_pod_record_time"),
            ),
            **walls(clock, pod_date="pod_record_time", shipped="shipping_time"),
        }
    )


def last_problems(t: Tables, clock: Clock) -> DataFrame:
    time = F.col("operation_time")
    return summarise(
        recent_problems(t, LOOK_BACK, clock),
        [KEY],
        {"pos_reason": at_latest(time, F.col("problem_reason")), "last_pos_attempt": F.max(time)},
    )


def vip_revenue(t: Tables, clock: Clock) -> DataFrame:
    """Counts and gross revenue per 17-column group, with aging buckets.

    The count of distinct shipping dates is taken over a grouping column, so it is 1 or (without a date) 0.
    """
    rows = attach(vip_parcels(t, clock), [last_problems(t, clock)], KEY)
    delivered, problem = F.col("pod_date").isNotNull(), F.col("last_pos_attempt").isNotNull()
    rows = rows.withColumns(
        {
            "shipping_date": date_of("shipped"),
            "aging_from_pickup_to_date": F.when(~delivered, days_between(F.lit(clock.local_today), "shipped")),
            "leadtime_pickup_to_pod": days_between("pod_date", "shipped"),
        }
    )
    sums = {
        "total_pickup": flag(F.col(KEY).isNotNull()),
        "total_pod": flag(delivered),
        "total_not_pod": flag(~delivered),
        "gross_revenue": F.col("standard_shipping_fee"),
        "total_waybill_pos": flag(problem),
        "not_pod_with_pos": flag(~delivered & problem),
        "not_pod_without_pos": flag(~delivered & ~problem),
        "pod_with_pos": flag(delivered & problem),
        "pod_without_pos": flag(delivered & ~problem),
    }
    grouped = rows.groupBy(*GROUP).agg(
        *[F.sum(value).alias(out) for out, value in sums.items()],
        F.max(flag(F.col("shipping_date").isNotNull()).cast("bigint")).alias("count_shipping_date"),
        F.count("pos_reason").alias("count_pos_reason"),
    )
    aging = F.col("aging_from_pickup_to_date")
    return grouped.withColumns(
        {
            "aging_0day": flag(aging == 0),
            "aging_1_2day": flag(aging.isin(1, 2)),
            "aging_3_14day": flag(aging.between(3, 14)),
            "aging_more_15day": flag(aging >= 15),
        }
    )
