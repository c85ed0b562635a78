"""Daily report: every recent order and parcel with its pickup, delivery, problem and return state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.functions import delivery, pickup
from parceltrail.functions.clock import Clock, days_between, local_date, local_dt, plus_days
from parceltrail.functions.reasons import handling_problem, problem_category
from parceltrail.functions.status import report_status
from parceltrail.functions.values import null_to_zero, numeric, safe_int
from parceltrail.operators.lookup import decode_all, lookup
from parceltrail.operators.merge import merge, only_left, only_right, prefer_left, right_once_set
from parceltrail.operators.summary import at_earliest, at_latest, attach, count_where, summarise
from parceltrail.plans.parts import (
    KEY,
    PROBLEM_SCAN,
    active_problem_codes,
    attempt_columns,
    columns_in_order,
    current_orders,
    current_returns,
    current_waybills,
    island_of,
    place_columns,
    problem_scan_columns,
    recent_problems,
    recent_rows,
    recent_scans,
    region_of,
    walls,
)
from parceltrail.sources.tables import Tables

LOOK_BACK = 93

OUTPUTS = {
    "waybill_no": "waybill_no",
    "order_no": "order_no",
    "ecommerce_order_no": "ecommerce_order_no",
    "waktu_input": "input_time",
    "order_status": "order_status",
    "pickup_time": "pickup_time",
    "pickup_failure_reason": "pickup_failure_reason",
    "nama_pengirim": "sender_name",
    "no_hp_pengirim": "sender_cellphone",
    "order_source": "order_source",
    "vip_username": "vip_username",
    "sub_akun": "sub_account",
    "scheduling_or_pickup_branch": "scheduling_or_pickup_branch",
    "kec_asal": "sender_district_name",
    "kota_asal": "sender_city_name",
    "provinsi_asal": "sender_province_name",
    "kanwil_asal": "kanwil_asal",
    "shipment_area": "shipment_area",
    "nama_penerima": "recipient_name",
    "tipe_service": "service_type",
    "tipe_ekspress": "express_type",
    "tipe_pembayaran": "payment_type",
    "item_name": "item_name",
    "estimasi_biaya_standar_pengiriman": "standard_shipping_fee_oo",
    "estimasi_total_biaya": "total_shipping_fee_oo",
    "estimasi_biaya_asuransi": "insurance_amount_oo",
    "estimasi_biaya_penanganan": "handling_fee_oo",
    "estimasi_biaya_lain": "other_fee_oo",
    "biaya_standar_pengiriman": "standard_shipping_fee_ww",
    "biaya_total_pengiriman": "total_shipping_fee_ww",
    "biaya_piutang_pengiriman": "receivable_shipping_fee_ww",
    "biaya_asuransi": "insurance_amount_ww",
    "biaya_penanganan": "handling_fee_ww",
    "biaya_lain": "other_fee_ww",
    "void_status": "void_status",
    "item_value": "item_value",
    "cod_amount": "cod_amount",
    "cod_type": "cod_type",
    "estimasi_berat": "item_weight_oo",
    "estimasi_berat_aktual": "item_actual_weight_oo",
    "estimasi_kalkulasi_berat": "item_calculated_weight_oo",
    "berat": "item_weight_ww",
    "berat_aktual": "item_actual_weight_ww",
    "kalkulasi_berat": "item_calculated_weight_ww",
    "alamat_penerima": "recipient_address",
    "no_hp_penerima": "recipient_cellphone",
    "waybill_status": "waybill_status",
    "last_scan_time": "last_scan_time",
    "last_activity": "last_activity",
    "last_location": "last_location",
    "first_deliv_attempt": "first_deliv_attempt",
    "last_deliv_attempt": "last_deliv_attempt",
    "destinasi_cabang_pod": "pod_branch_name",
    "waktu_perekaman_pod": "pod_record_time",
    "pod_photo_url": "pod_photo_url",
    "tujuan_kec": "recipient_district_name",
    "kota_tujuan": "recipient_city_name",
    "provinsi_tujuan": "recipient_province_name",
    "kanwil_tujuan": "kanwil_tujuan",
    "area_tujuan": "area_tujuan",
    "return_status": "return_status",
    "return_shipping_fee": "return_shipping_fee",
    "return_confirm_status": "return_confirm_status",
    "return_reason": "return_reason",
    "return_pod_photo_url": "return_pod_photo_url",
    "return_pod_record_time": "return_pod_record_time",
    "return_area": "return_area",
    "first_pos_location": "first_pos_location",
    "first_pos_attempt": "first_pos_attempt",
    "first_pos_reason": "first_pos_reason",
    "first_pos_photo_url": "first_pos_photo_url",
    "last_pos_attempt": "last_pos_attempt",
    "last_pos_type": "last_pos_type",
    "last_pos_reason": "last_pos_reason",
    "last_pos_photo_url": "last_pos_photo_url",
    "count_deliv_attempt": "count_deliv_attempt",
    "count_pos": "count_pos",
    "last_status": "last_status",
    "pod_courier_name_ww": "pod_courier_name",
    "signer_ww": "signer",
    "relationship_type_ww": "relationship_type",
    "durasi_pickup": "durasi_pickup",
    "pickup_rate": "pickup_rate",
    "pickup_failure_time": "pickup_failure_time",
    "sla_pickup_status": "sla_pickup_status",
    "adjusted_performance_pickup": "adjusted_performance_pickup",
    "deliv_problem_agg": "deliv_problem_agg",
    "last_pos_category": "last_pos_category",
    "lead_time_deliv": "lead_time_deliv",
    "sla_est_deadline": "sla_est_deadline",
    "sla_status_deliv": "sla_status_deliv",
    "pickup_status_oo": "pickup_status",
}

_ORDER_AMOUNTS = [
    "standard_shipping_fee",
    "total_shipping_fee",
    "insurance_amount",
    "handling_fee",
    "other_fee",
    "item_weight",
    "item_actual_weight",
    "item_calculated_weight",
    "item_value",
    "item_name",
]
_WAYBILL_AMOUNTS = [*_ORDER_AMOUNTS, "receivable_shipping_fee"]
_SHARED = [
    "waybill_no",
    "order_no",
    "ecommerce_order_no",
    "sender_name",
    "sender_cellphone",
    "sender_province_name",
    "sender_city_name",
    "sender_district_name",
    "kanwil_asal",
    "recipient_name",
    "recipient_address",
    "recipient_cellphone",
    "recipient_province_name",
    "recipient_city_name",
    "recipient_district_name",
    "kanwil_tujuan",
    "express_type",
    "service_type",
    "payment_type",
]
_FROM_ORDER = [
    "pickup_failure_reason",
    "pickup_failure_time",
    "order_status",
    "durasi_pickup",
    "sla_pickup_status",
    "pickup_rate",
    "pickup_status",
    "adjusted_performance_pickup",
]
_FROM_WAYBILL = [
    "cod_amount",
    "cod_type",
    "void_status",
    "waybill_status",
    "sla_est_deadline",
    "pod_record_time",
    "pod_branch_name",
    "lead_time_deliv",
    "sla_status_deliv",
    "return_reason",
    "return_confirm_status",
    "return_confirm_record_time",
    "return_area",
    "return_status",
    "return_shipping_fee",
    "return_pod_record_time",
    "return_pod_photo_url",
    "shipment_area",
    "area_tujuan",
    "pod_photo_url",
    "pod_courier_name",
    "signer",
    "relationship_type",
]

POLICY = {
    **{c: prefer_left(c) for c in _SHARED},
    "order_source": prefer_left("order_source", "waybill_source"),
    "vip_username": right_once_set("pickup_time", "parent_shipping_cleint"),
    "sub_account": right_once_set("pickup_time", "vip_customer_name"),
    "input_time": prefer_left("input_time", "shipping_time"),
    "pickup_time": prefer_left("pickup_time", "shipping_time"),
    "scheduling_or_pickup_branch": right_once_set(
        "pickup_time", "scheduling_target_branch_name", "pickup_branch_name"
    ),
    "item_name": right_once_set("pickup_time", "item_name"),
    "item_value": right_once_set("pickup_time", "item_value"),
    **{c: only_left(c) for c in _FROM_ORDER},
    **{f"{c}_oo": only_left(c) for c in _ORDER_AMOUNTS},
    **{c: only_right(c) for c in _FROM_WAYBILL},
    **{f"{c}_ww": only_right(c) for c in _WAYBILL_AMOUNTS},
}

# Columns that depend on the parcel number alone.
SUMMARIES = [
    "first_deliv_attempt",
    "last_deliv_attempt",
    "count_deliv_attempt",
    "last_location",
    "last_activity",
    "last_scan_time",
    "first_problem_branch",
    "first_problem_photo",
    "last_problem_photo",
    "count_pos",
    "first_pos_reason",
    "first_pos_attempt",
    "last_pos_reason",
    "last_pos_attempt",
    "last_pos_type",
]


def orders(t: Tables, clock: Clock, sane_pickup_sla: bool = False) -> DataFrame:
    """Current orders with pickup results. The newest input decides the version."""
    rows = current_orders(recent_rows(t["order_order"], LOOK_BACK, clock, "input_time"), "input_time")
    rows = rows.withColumn(
        "durasi_pickup",
        pickup.pickup_days(F.col("pickup_time"), F.col("start_pickup_time"), F.col("input_time"), clock.tz),
    )
    rows = decode_all(
        rows,
        t.labels,
        {
            "order_source": ("order_source", "orderSource"),
            "order_status": ("order_status", "orderStatus"),
            "payment_type": ("payment_type", "paymentType"),
            "express_type": ("express_type", "expressType"),
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
        rows, t, {"kanwil_asal": "sender_province_name", "kanwil_tujuan": "recipient_province_name"}
    )
    rows = rows.withColumns(
        walls(clock, "input_time", "start_pickup_time", "end_pickup_time", "pickup_failure_time", "pickup_time")
    )
    status, end = F.col("order_status"), F.col("end_pickup_time")
    rows = rows.withColumns(
        {
            "sla_pickup_status": pickup.generic_sla(
                F.col("service_type"), F.col("pickup_time"), end, clock.local_today, inverted=not sane_pickup_sla
            ),
            "pickup_rate": pickup.pickup_rate(F.col("durasi_pickup"), "H0"),
            "pickup_status": pickup.pickup_status(status),
        }
    )
    return rows.withColumn(
        "adjusted_performance_pickup",
        pickup.adjusted_by_time_or_reason(
            F.col("order_source"),
            F.col("sla_pickup_status"),
            F.col("pickup_failure_time"),
            end,
            F.col("pickup_failure_reason"),
        ),
    )


def waybills(t: Tables, clock: Clock) -> DataFrame:
    """Current parcels with delivery results and their newest return bill."""
    rows = current_waybills(recent_rows(t["waybill_waybill"], LOOK_BACK, clock, "shipping_time", "update_time"))
    bills = current_returns(recent_rows(t["waybill_return_bill"], LOOK_BACK, clock, "update_time"))
    bills = bills.select(
        KEY,
        "return_type_id",
        F.col("return_confirm_status").alias("__confirm_code"),
        "return_confirm_record_time",
        F.col("return_pod_record_time").alias("__return_done"),
        "return_shipping_fee",
        "return_pod_photo_url",
        F.col("recipient_city_name").alias("__return_city"),
        F.col("recipient_province_name").alias("__return_province"),
    )
    rows = rows.join(bills, KEY, "left")
    rows = decode_all(
        rows,
        t.labels,
        {
            "waybill_status": ("waybill_status", "waybillStatus"),
            "return_status": ("return_flag", "returnFlag"),
            "void_status": ("void_flag", "voidFlag"),
            "waybill_source": ("waybill_source", "waybillSource"),
            "service_type": ("service_type", "serviceType"),
            "express_type": ("express_type", "expressType"),
            "payment_type": ("payment_type", "paymentType"),
            "return_confirm_status": ("__confirm_code", "returnConfirmStatus"),
            "relationship_type": ("relationship_type", "relation"),
        },
    )
    rows = lookup(
        rows,
        t.dimension("masterdata_sla_shopee"),
        {"recipient_city_name": "destination_city", "sender_city_name": "origin_city"},
        {"sla": "sla"},
    )
    rows = island_of(
        rows,
        t,
        {
            "area_tujuan": ("recipient_city_name", "recipient_province_name"),
            "shipment_area": ("sender_city_name", "sender_province_name"),
            "return_area": ("__return_city", "__return_province"),
        },
    )
    rows = region_of(
        rows, t, {"kanwil_asal": "sender_province_name", "kanwil_tujuan": "recipient_province_name"}
    )
    rows = lookup(rows, t.dimension("return_type"), {"return_type_id": "id"}, {"return_reason": "return_type"})
    sla = safe_int(F.col("sla"))
    lead = days_between(local_dt("pod_record_time", clock.tz), local_dt("shipping_time", clock.tz))
    rows = rows.withColumns(
        {
            "item_value": numeric(F.col("item_value")),
            "cod_type": delivery.cod_type(F.col("cod_amount"), missing_is_non_cod=True),
            "sla_est_deadline": plus_days(local_date("shipping_time", clock.tz), sla),
            "lead_time_deliv": lead,
            "sla_status_deliv": delivery.sla_hit(lead, sla),
        }
    )
    return rows.withColumns(
        walls(
            clock,
            "shipping_time",
            "pod_record_time",
            "return_confirm_record_time",
            return_pod_record_time="__return_done",
        )
    )


def scan_summary(t: Tables, clock: Clock) -> DataFrame:
    """Attempts, last place, problem scans and problem count per parcel, from one pass over the scan log."""
    scans = lookup(
        recent_scans(t, LOOK_BACK, clock),
        active_problem_codes(t),
        {"problem_code": "code"},
        {"problem_reason": "register_reason_bahasa"},
    )
    is_problem = F.col("operation_type") == PROBLEM_SCAN
    return summarise(
        scans,
        [KEY],
        {
            **attempt_columns(),
            **place_columns(),
            **problem_scan_columns(),
            "count_pos": count_where(is_problem, F.col("problem_reason")),
        },
    ).withColumns(walls(clock, "first_deliv_attempt", "last_deliv_attempt", "last_scan_time"))


def problem_summary(t: Tables, clock: Clock) -> DataFrame:
    """First and last problem record per parcel.

    Reason and type are taken among the records at the earliest (latest) time. Branch and photo come from the
    problem scans, so no record has to be paired with every scan of its parcel.
    """
    problems = recent_problems(t, LOOK_BACK, clock)
    time, reason, kind = F.col("operation_time"), F.col("problem_reason"), F.col("problem_label")
    return summarise(
        problems,
        [KEY],
        {
            "first_pos_reason": at_earliest(time, reason),
            "first_pos_attempt": F.min(time),
            "last_pos_reason": at_latest(time, reason),
            "last_pos_attempt": F.max(time),
            "last_pos_type": at_latest(time, kind),
        },
    ).withColumns(walls(clock, "first_pos_attempt", "last_pos_attempt"))


def daily_report(t: Tables, clock: Clock, sane_pickup_sla: bool = False) -> DataFrame:
    """One row per order or parcel of the last 93 days.

    Open pickup-service orders are labelled the wrong way round (a slot still ahead is Late) unless
    `sane_pickup_sla` is set.

    The summaries are attached to both sides before the full join: everything up to it is partitioned by the parcel
    number already, while its wide output is not and would have to be shuffled again.
    """
    summaries = [scan_summary(t, clock), problem_summary(t, clock)]
    rows = merge(
        attach(orders(t, clock, sane_pickup_sla), summaries, KEY),
        attach(waybills(t, clock), summaries, KEY),
        KEY,
        {**POLICY, **{c: prefer_left(c) for c in SUMMARIES}},
    )
    has_problem, reason = F.col("first_pos_attempt").isNotNull(), F.col("last_pos_reason")
    rows = rows.withColumns(
        {
            "first_pos_location": F.when(has_problem, F.col("first_problem_branch")),
            "first_pos_photo_url": F.when(has_problem, F.col("first_problem_photo")),
            "last_pos_photo_url": F.when(has_problem, F.col("last_problem_photo")),
            "count_deliv_attempt": null_to_zero(F.col("count_deliv_attempt")),
            "count_pos": null_to_zero(F.col("count_pos")),
            "pod_status": delivery.delivered_flag(F.col("waybill_status"), F.col("pod_record_time")),
            "deliv_problem_agg": handling_problem(reason),
            "last_pos_category": problem_category(reason),
            "last_status": report_status(
                F.col("order_status"),
                F.col("waybill_status"),
                F.col("void_status"),
                F.col("pod_record_time"),
                F.col("return_confirm_record_time"),
                F.col("return_pod_record_time"),
                F.col("return_status"),
                reason,
            ),
        }
    )
    return columns_in_order(rows, OUTPUTS)
