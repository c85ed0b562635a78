"""Pickup and delivery performance of one seller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions import delivery, pickup, reasons
from parceltrail.functions.clock import Clock, local_date, past_cutoff
from parceltrail.functions.status import seller_final_status, seller_status
from parceltrail.functions.values import safe_int
from parceltrail.operators.keyed import latest_per_key
from parceltrail.operators.lookup import Dimension, decode_all, having_key, lookup
from parceltrail.operators.merge import merge, only_left, only_right, prefer_left, right_once_set
from parceltrail.operators.summary import at_latest, attach, summarise
from parceltrail.plans.parts import (
    KEY,
    PROBLEM_SCAN,
    active_problem_codes,
    columns_in_order,
    current_orders,
    current_returns,
    current_waybills,
    island_of,
    recent_problems,
    recent_rows,
    region_of,
    walls,
)
from parceltrail.sources.tables import Tables

LOOK_BACK = 186

OUTPUTS = [
    "waybill_no",
    "order_no",
    "ecommerce_order_no",
    "order_source",
    "vip_username",
    "sub_account",
    "input_time",
    "start_pickup_time",
    "end_pickup_time",
    "pickup_failure_reason",
    "pickup_failure_time",
    "pickup_time",
    "scheduling_or_pickup_branch",
    "order_status",
    "sender_name",
    "sender_province_name",
    "sender_city_name",
    "sender_district_name",
    "kanwil_area_pickup",
    "origin_area",
    "recipient_province_name",
    "recipient_city_name",
    "recipient_district_name",
    "kanwil_area_deliv",
    "destination_area",
    "service_type",
    "durasi_pickup",
    "order_past_1400",
    "order_past_1500",
    "division",
    "sales_name",
    "pickup_performance",
    "pickup_category_everpro",
    "pickup_performance_everpro",
    "sla_pickup_shopee",
    "sla_pickup_tokped",
    "sla_pickup_blibli",
    "sla_pickup_blibli_by_input_time",
    "sla_pickup_soscom",
    "sla_performance",
    "pickup_rate",
    "pickup_status",
    "fm_performance",
    "late_pickup_factor",
    "late_pickup_category",
    "adjusted_performance_everpro",
    "cod_amount",
    "waybill_status",
    "void_status",
    "cod_type",
    "update_time_oo",
    "update_time_ww",
    "sla_delivery",
    "sla_est_deadline",
    "pod_record_time",
    "pod_branch_name",
    "lead_time_deliv",
    "lead_time_category",
    "sla_status",
    "remark_return",
    "return_branch_name",
    "return_pod_photo_url",
    "return_record_time",
    "return_area",
    "return_status",
    "return_confirm_status",
    "return_confirm_record_time",
    "return_pod_record_time",
    "recording_time_pos",
    "late_reason",
    "problem_type",
    "problem_delivery_category",
    "problem_delivery_category_2",
    "problem_delivery_category_oms_2",
    "late_delivery_factor",
    "late_delivery_category",
    "count_pos",
    "last_status",
    "final_status",
    "recipient_name",
    "recipient_cellphone",
    "recipient_address",
]

_SHARED = [
    "waybill_no",
    "order_no",
    "ecommerce_order_no",
    "order_source",
    "sender_name",
    "sender_province_name",
    "sender_city_name",
    "sender_district_name",
    "kanwil_area_pickup",
    "origin_area",
    "recipient_province_name",
    "recipient_city_name",
    "recipient_district_name",
    "kanwil_area_deliv",
    "destination_area",
]
_FROM_ORDER = [
    "start_pickup_time",
    "end_pickup_time",
    "pickup_failure_reason",
    "pickup_failure_time",
    "order_status",
    "service_type",
    "durasi_pickup",
    "order_past_1400",
    "order_past_1500",
    "division",
    "sales_name",
    "pickup_performance",
    "pickup_category_everpro",
    "pickup_performance_everpro",
    "sla_pickup_shopee",
    "sla_pickup_tokped",
    "sla_pickup_blibli",
    "sla_pickup_blibli_by_input_time",
    "sla_pickup_soscom",
    "pickup_rate",
    "pickup_status",
    "fm_performance",
    "late_pickup_factor",
    "late_pickup_category",
    "adjusted_performance_everpro",
    "update_time_oo",
    "recipient_name",
    "recipient_cellphone",
    "recipient_address",
]
_FROM_WAYBILL = [
    "cod_amount",
    "waybill_status",
    "void_status",
    "cod_type",
    "sla_delivery",
    "sla_est_deadline",
    "sla_performance",
    "pod_record_time",
    "pod_branch_name",
    "lead_time_deliv",
    "lead_time_category",
    "sla_status",
    "remark_return",
    "return_branch_name",
    "return_pod_photo_url",
    "return_record_time",
    "return_area",
    "return_status",
    "return_confirm_status",
    "return_confirm_record_time",
    "return_pod_record_time",
    "update_time_ww",
]

POLICY = {
    **{c: prefer_left(c) for c in _SHARED},
    "vip_username": right_once_set("pickup_time", "parent_shipping_cleint"),
    "sub_account": right_once_set("pickup_time", "vip_customer_name"),
    "input_time": prefer_left("input_time", "shipping_time"),
    "pickup_time": prefer_left("pickup_time", "shipping_time"),
    "scheduling_or_pickup_branch": right_once_set(
        "pickup_time", "scheduling_target_branch_name", "pickup_branch_name"
    ),
    **{c: only_left(c) for c in _FROM_ORDER},
    **{c: only_right(c) for c in _FROM_WAYBILL},
}

# Columns that depend on the parcel number alone.
SUMMARIES = [
    "recording_time_pos",
    "late_reason",
    "problem_type",
    "problem_delivery_category_2",
    "problem_delivery_category_oms_2",
    "late_delivery_factor",
    "late_delivery_category",
    "count_pos",
]


def seller_keys(t: Tables, clock: Clock, username: str) -> DataFrame:
    """Parcels that any recent version of an order or waybill assigns to the seller: a superset of the report's.

    Only recent versions can be picked as the current one, so older ones needn't be read.
    """
    recent = [
        recent_rows(t["order_order"], LOOK_BACK, clock, "input_time"),
        recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time", "update_time"),
    ]
    parts = [r.where((F.col("parent_shipping_cleint") == username) & F.col(KEY).isNotNull()).select(KEY) for r in recent]
    return parts[0].unionByName(parts[1]).distinct()


def _of(rows: DataFrame, keys: DataFrame | None) -> DataFrame:
    return rows if keys is None else having_key(rows, keys, KEY)


def orders(t: Tables, clock: Clock, keys: DataFrame | None = None) -> DataFrame:
    """Current orders with all pickup results. The newest update decides the version.

    With a key list, orders without a parcel number stay in: one of them survives, whichever seller it is from.
    """
    rows = recent_rows(t["order_order"], LOOK_BACK, clock, "input_time")
    if keys is not None:
        rows = having_key(rows, keys, KEY).unionByName(rows.where(F.col(KEY).isNull()))
    rows = current_orders(rows, "update_time")
    rows = rows.withColumns(
        {
            "durasi_pickup": pickup.pickup_days(
                F.col("pickup_time"), F.col("start_pickup_time"), F.col("input_time"), clock.tz
            ),
            "order_past_1400": past_cutoff("input_time", "14:00:00", clock.tz),
            "order_past_1500": past_cutoff("input_time", "15:00:00", clock.tz),
        }
    )
    rows = decode_all(
        rows,
        t.labels,
        {
            "order_source": ("order_source", "orderSource"),
            "order_status": ("order_status", "orderStatus"),
            "service_type": ("service_type", "serviceType"),
        },
    )
    rows = lookup(
        rows,
        active_problem_codes(t),
        {"pickup_failure_problem_code": "code"},
        {"pickup_failure_reason": "register_reason_bahasa"},
    )
    rows = region_of(
        rows, t, {"kanwil_area_pickup": "sender_province_name", "kanwil_area_deliv": "recipient_province_name"}
    )
    rows = island_of(
        rows,
        t,
        {
            "destination_area": ("recipient_city_name", "recipient_province_name"),
            "origin_area": ("sender_city_name", "sender_province_name"),
        },
    )
    rows = lookup(
        rows,
        t.dimension("masterdata_sales_source"),
        {"order_source": "source"},
        {"__source_division": "division", "__source_sales": "sales_name"},
    )
    rows = lookup(
        rows,
        t.dimension("masterdata_sales_seller_vip"),
        {"vip_customer_name": "seller_name"},
        {"__seller_division": "division", "__seller_sales": "sales_name"},
    )
    rows = rows.withColumns(
        walls(
            clock,
            "input_time",
            "start_pickup_time",
            "end_pickup_time",
            "pickup_failure_time",
            "pickup_time",
            update_time_oo="update_time",
        )
    )
    today = clock.local_today
    source, status = F.col("order_source"), F.col("order_status")
    picked, placed = F.col("pickup_time"), F.col("input_time")
    start, end = F.col("start_pickup_time"), F.col("end_pickup_time")
    past_1400, past_1500 = F.col("order_past_1400"), F.col("order_past_1500")
    failure_reason = F.col("pickup_failure_reason")
    rows = rows.withColumns(
        {
            "division": pickup.owner(source, F.col("__seller_division"), F.col("__source_division")),
            "sales_name": pickup.owner(source, F.col("__seller_sales"), F.col("__source_sales")),
            "pickup_performance": pickup.generic_sla(F.col("service_type"), picked, end, today),
            "pickup_category_everpro": pickup.pickup_category(source, past_1400, past_1500),
            "sla_pickup_shopee": pickup.shopee_sla(source, status, picked, start, today),
            "sla_pickup_tokped": pickup.tokopedia_sla(source, status, picked, start, end, today),
            "sla_pickup_blibli": pickup.blibli_sla(source, status, picked, start, past_1400, today),
            "sla_pickup_blibli_by_input_time": pickup.blibli_sla(source, status, picked, placed, past_1400, today),
            "sla_pickup_soscom": pickup.other_sla(source, status, picked, placed, past_1500, today),
            "pickup_rate": pickup.pickup_rate(F.col("durasi_pickup"), "H+0"),
            "pickup_status": pickup.pickup_status(status),
            "fm_performance": pickup.first_mile(status),
            "late_pickup_factor": reasons.pickup_factor(failure_reason),
            "late_pickup_category": reasons.pickup_control(failure_reason),
        }
    )
    rows = rows.withColumn(
        "pickup_performance_everpro",
        pickup.selected_sla(
            F.col("sla_pickup_shopee"),
            F.col("sla_pickup_blibli_by_input_time"),
            F.col("sla_pickup_soscom"),
            F.col("sla_pickup_tokped"),
        ),
    )
    return rows.withColumn(
        "adjusted_performance_everpro",
        pickup.adjusted_by_reason(
            source, F.col("pickup_performance_everpro"), F.col("pickup_failure_time"), end, failure_reason
        ),
    )


def current_prices(t: Tables, clock: Clock) -> Dimension:
    """Unexpired price rows, newest per search code, then newest per (client, origin, destination, express type)."""
    rows = t["standard_shipping_fee"].where(
        (F.col("end_expire_time") >= F.lit(clock.as_of))
        & (local_date("end_expire_time", clock.tz) > F.lit(clock.local_today))
        & (F.col("deleted") == "0")
    )
    rows = latest_per_key(rows, ["search_code"], "created_at", ["max_sla"])
    lane = ["shipping_client_id", "sender_location_id", "recipient_location_id", "express_type"]
    return Dimension(latest_per_key(rows, lane, "created_at", ["max_sla", "search_code"]), tuple(lane), True)


def waybills(t: Tables, clock: Clock, keys: DataFrame | None = None, local_deadline: bool = False) -> DataFrame:
    """Current parcels with delivery results and their newest undeleted return bill."""
    rows = _of(recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time", "update_time"), keys)
    rows = current_waybills(rows)
    bills = recent_rows(t["waybill_return_bill"].where(F.col("deleted") == "0"), LOOK_BACK, clock, "update_time")
    bills = current_returns(_of(bills, keys)).select(
        KEY,
        "return_type_id",
        "return_branch_name",
        "return_pod_photo_url",
        "return_record_time",
        F.col("return_confirm_status").alias("__confirm_code"),
        "return_confirm_record_time",
        F.col("return_pod_record_time").alias("__return_done"),
        F.col("recipient_city_name").alias("__return_city"),
        F.col("recipient_province_name").alias("__return_province"),
    )
    rows = rows.join(bills, KEY, "left")
    rows = lookup(
        rows,
        current_prices(t, clock),
        {
            "vip_customer_id": "shipping_client_id",
            "sender_city_id": "sender_location_id",
            "recipient_district_id": "recipient_location_id",
            "express_type": "express_type",
        },
        {"__price_days": "max_sla"},
    )
    rows = lookup(rows, t.dimension("return_type"), {"return_type_id": "id"}, {"remark_return": "return_type"})
    rows = lookup(
        rows,
        t.dimension("masterdata_sla_shopee"),
        {"recipient_city_name": "destination_city", "sender_city_name": "origin_city"},
        {"__city_sla": "sla"},
    )
    rows = decode_all(
        rows,
        t.labels,
        {
            "void_status": ("void_flag", "voidFlag"),
            "waybill_status": ("waybill_status", "waybillStatus"),
            "return_status": ("return_flag", "returnFlag"),
            "return_confirm_status": ("__confirm_code", "returnConfirmStatus"),
            "order_source": ("waybill_source", "waybillSource"),
        },
    )
    rows = island_of(
        rows,
        t,
        {
            "origin_area": ("sender_city_name", "sender_province_name"),
            "destination_area": ("recipient_city_name", "recipient_province_name"),
            "return_area": ("__return_city", "__return_province"),
        },
    )
    rows = region_of(
        rows, t, {"kanwil_area_pickup": "sender_province_name", "kanwil_area_deliv": "recipient_province_name"}
    )
    source, shipped, delivered = F.col("order_source"), F.col("shipping_time"), F.col("pod_record_time")
    price_days, city_days = F.col("__price_days"), safe_int(F.col("__city_sla"))
    lead = F.datediff(local_date(delivered, clock.tz), local_date(shipped, clock.tz))
    allowed = delivery.sla_days(source, price_days, city_days)
    rows = rows.withColumns(
        {
            "cod_type": delivery.cod_type(F.col("cod_amount"), missing_is_non_cod=False),
            "sla_delivery": allowed,
            "sla_est_deadline": delivery.sla_deadline(source, shipped, price_days, city_days, clock.tz),
            "sla_performance": delivery.sla_performance(
                source, shipped, delivered, price_days, city_days, clock.local_today, clock.tz, local_deadline
            ),
            "lead_time_deliv": lead,
            "lead_time_category": delivery.lead_bucket(lead),
            "sla_status": delivery.sla_hit(lead, allowed),
        }
    )
    return rows.withColumns(
        walls(
            clock,
            "shipping_time",
            "pod_record_time",
            "return_record_time",
            "return_confirm_record_time",
            return_pod_record_time="__return_done",
            update_time_ww="update_time",
        )
    )


def problems(t: Tables, clock: Clock, keys: DataFrame | None = None) -> DataFrame:
    """Last problem per parcel, the late reason drawn from it, and its classes."""
    rows = _of(recent_problems(t, LOOK_BACK, clock), keys)
    time = F.col("operation_time")
    rows = summarise(
        rows,
        [KEY],
        {
            "__reason": at_latest(time, F.col("problem_reason")),
            "recording_time_pos": F.max(time),
            "problem_type": at_latest(time, F.col("problem_label")),
        },
    ).withColumns(walls(clock, "recording_time_pos"))
    partner = _of(t["mitra_late_reason_delivery"], keys)
    rows = lookup(rows, partner, {KEY: KEY}, {"__partner": "late_delivery_reason"})
    rows = rows.withColumn("late_reason", reasons.late_reason(F.col("__reason"), F.col("__partner")))
    reason = F.col("late_reason")
    return rows.withColumns(
        {
            "problem_delivery_category_2": reasons.problem_category(reason),
            "problem_delivery_category_oms_2": reasons.order_system_problem(F.col("problem_type"), reason),
            "late_delivery_factor": reasons.delivery_factor(reason),
            "late_delivery_category": reasons.delivery_control(reason),
        }
    ).drop("__reason", "__partner")


def problem_counts(t: Tables, clock: Clock, keys: DataFrame | None = None) -> DataFrame:
    scans = t["waybill_waybill_line"].where((F.col("operation_type") == PROBLEM_SCAN) & F.col(KEY).isNotNull())
    scans = _of(recent_rows(scans, LOOK_BACK, clock, "record_time"), keys)
    return summarise(scans, [KEY], {"count_pos": F.count("record_time")})


def seller_performance(
    t: Tables,
    clock: Clock,
    source: str = pickup.SELLER_PORTAL,
    username: str | None = None,
    local_deadline: bool = False,
) -> DataFrame:
    """One row per order or parcel of a source, and of one seller account unless `username` is None.

    For one seller every table is first cut down to the parcels a recent version of which names the seller. Rows without an order never carry an account name, so one seller's report needs only
    the orders' side of the merge.

    The summaries are attached before the merge, while the rows are still partitioned by the parcel number.
    """
    keys = None if username is None else seller_keys(t, clock, username)
    summaries = [problems(t, clock, keys), problem_counts(t, clock, keys)]
    rows = attach(orders(t, clock, keys), summaries, KEY)
    parcels = waybills(t, clock, keys, local_deadline)
    if username is None:
        policy = {**POLICY, **{c: prefer_left(c) for c in SUMMARIES}}
        rows = merge(rows, attach(parcels, summaries, KEY), KEY, policy)
    else:
        policy = {**POLICY, **{c: only_left(c) for c in [KEY, *SUMMARIES]}}
        rows = merge(rows, parcels, KEY, policy, how="left")
    rows = rows.where(F.col("order_source") == source)
    if username is not None:
        rows = rows.where(F.col("vip_username") == username)
    reason = F.col("late_reason")
    ladder = [
        F.col("order_status"),
        F.col("waybill_status"),
        F.col("void_status"),
        F.col("pod_record_time"),
        F.col("return_confirm_record_time"),
        F.col("return_pod_record_time"),
        reason,
    ]
    rows = rows.withColumns(
        {
            "problem_delivery_category": reasons.narrow_category(
                reason, F.col("recipient_province_name"), F.col("cod_amount")
            ),
            "last_status": seller_status(*ladder),
            "final_status": seller_final_status(*ladder),
        }
    )
    return columns_in_order(rows, OUTPUTS)
