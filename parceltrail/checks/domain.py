"""Parcel tables derived from the TPC-H-like test tables.

The reports need courier tables that the test data does not have. Each one is derived from whole test tables by a
query in the SQL subset that Spark and DuckDB share, so both engines see the same rows and the work of a report grows
with the test data. `{name}` stands for another table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from parceltrail.functions import reasons
from parceltrail.functions.clock import Clock
from parceltrail.sources.tables import SCHEMAS, Tables, conform

CLOCK = Clock.at("2024-01-31T03:00:00Z")

# Every reason the classifications know, plus an unknown one.
ALL_REASONS = sorted(
    {
        *(r for group in reasons.PROBLEM_CATEGORIES.values() for r in group),
        *(r for group in reasons.PICKUP_FACTORS.values() for r in group),
        *(r for group in reasons.DELIVERY_FACTORS.values() for r in group),
        *reasons.NOT_A_DELIVERY_PROBLEM,
        "Parcel was Rejected by customs",
        "Unknown reason",
    }
)

_OPTIONS = {
    "orderSource": {
        "0": "Shopee platform",
        "1": "Tokopedia",
        "2": "Blibli",
        "3": "VIP Customer Portal",
        "4": "pt fashion marketplace indonesia",
        "5": "Walk in",
    },
    "orderStatus": {"0": "Cancel Order", "1": "Picked Up", "2": "Pending"},
    "paymentType": {"0": "Monthly", "1": "Cash"},
    "expressType": {"0": "STD", "1": "Cargo"},
    "serviceType": {"0": "Pick up", "1": "Drop off"},
    "waybillStatus": {
        "1": "Signed",
        "2": "Return Received",
        "3": "Delivering",
        "4": "Returning",
        "5": "Pickup Failure",
    },
    "returnFlag": {"0": "Tidak Retur", "1": "Retur"},
    "voidFlag": {"0": "Not void", "1": "Void"},
    "returnConfirmStatus": {"0": "Waiting", "1": "Confirmed"},
    "relation": {"0": "Family", "1": "Self"},
    "operationType": {
        "03": "Pickup Failure",
        "04": "Sending",
        "05": "Arrival",
        "09": "Delivery",
        "18": "Problem",
        "30": "Confirm Return Bill",
    },
    "problemType": {"01": "Delivery problem", "02": "Ignored", "03": "Percobaan pengambilan terkendala"},
    "branchLevel": {"0": "TH", "1": "PDB", "2": "MH", "3": "Outlet", "4": "HQ"},
}
_OPTIONS["waybillSource"] = _OPTIONS["orderSource"]


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    lines = ", ".join("(" + ", ".join(v if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {lines}) AS t({columns})"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _after(start: str, seconds: str) -> str:
    return f"({start} + INTERVAL '1' SECOND * ({seconds}))"


def _dec(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,9))"


_PEOPLE = f"""
  'Sender ' || {_text("c")} AS sender_name, '08' || {_text("c")} AS sender_cellphone,
  sender_province AS sender_province_name, sender_province || ' CITY ' || {_text("c % 3")} AS sender_city_name,
  'D' || {_text("c % 7")} AS sender_district_name,
  'Recipient ' || {_text("k")} AS recipient_name, 'Street ' || {_text("k")} AS recipient_address,
  '09' || {_text("k")} AS recipient_cellphone,
  recipient_province AS recipient_province_name,
  recipient_province || ' CITY ' || {_text("k % 3")} AS recipient_city_name,
  'D' || {_text("k % 7")} AS recipient_district_name
"""

_CONTRACT = f"""
  'ON' || {_text("k")} AS order_no, 'EC' || {_text("c")} || '-' || {_text("k")} AS ecommerce_order_no,
  'seller' || {_text("c % 10")} AS parent_shipping_cleint, 'shop' || {_text("c % 20")} AS vip_customer_name,
  {_text("k % 3")} AS payment_type, {_text("k % 2")} AS express_type, {_text("k % 3")} AS service_type
"""

_WAYBILL = f"""
  'WB' || {_text("k")} AS waybill_no, {_CONTRACT},
  {_text("k % 7")} AS waybill_source, {_text("(k + v) % 6")} AS waybill_status,
  CASE WHEN k % 17 = 0 THEN '1' ELSE '0' END AS void_flag,
  CASE WHEN k % 4 = 0 THEN '1' ELSE '0' END AS return_flag,
  CASE WHEN k % 19 = 0 THEN '1' ELSE '0' END AS deleted,
  {_text("k % 3")} AS relationship_type, c % 10 AS vip_customer_id,
  {_after("base", "(k * 11 % 48) * 3600")} AS shipping_time,
  {_after("base", "(k * 13 % 90) * 3600 + v * 86400")} AS update_time,
  CASE WHEN (k + v) % 3 = 1 THEN {_after("base", "(k * 11 % 48 + k % 12 * 24 + k % 5) * 3600")} END AS pod_record_time,
  CASE WHEN k % 13 = 0 THEN {_after("base", "(k % 30 + 2) * 86400")} END AS return_pod_record_time,
  k % 15 AS pickup_branch_id, 'TH ' || {_text("k % 15")} AS pickup_branch_name,
  CASE WHEN k % 8 = 0 THEN NULL WHEN k % 3 = 0 THEN 0 ELSE c % 40 END AS pickup_courier_id,
  CASE WHEN k % 8 = 0 THEN NULL WHEN k % 3 = 0 THEN '' ELSE 'Courier ' || {_text("c % 40")} END
    AS pickup_courier_name,
  'TH ' || {_text("c % 15")} AS pod_branch_name, 'photo/' || {_text("k")} AS pod_photo_url,
  'Courier ' || {_text("k % 40")} AS pod_courier_name, 'Signer ' || {_text("k % 100")} AS signer,
  k % 10 AS sender_city_id, k % 12 AS recipient_district_id,
  {_text("k % 1000")} || '.5' AS item_value, 'Item ' || {_text("k % 50")} AS item_name,
  {_dec("k % 900")} AS standard_shipping_fee, {_dec("k % 910")} AS total_shipping_fee,
  {_dec("k % 70")} AS insurance_amount, CASE WHEN k % 9 = 0 THEN NULL ELSE {_dec("k % 50")} END AS handling_fee,
  {_dec("k % 800")} AS receivable_shipping_fee, {_dec("k % 30")} AS other_fee,
  CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN {_dec("0")} ELSE {_dec("k % 500 + 1")} END AS cod_amount,
  {_dec("k % 20")} AS item_weight, {_dec("k % 21")} AS item_actual_weight,
  {_dec("k % 22")} AS item_calculated_weight, {_PEOPLE}
"""

# name -> query, in dependency order. The first four are helpers.
QUERIES: dict[str, str] = {
    "places": """
SELECT n_nationkey AS place,
  CASE n_nationkey WHEN 0 THEN 'DKI JAKARTA' WHEN 1 THEN 'BANTEN' WHEN 2 THEN 'PAPUA' WHEN 3 THEN 'NTT'
    ELSE n_name END AS province,
  CASE n_nationkey % 10 WHEN 0 THEN 'JAWA BARAT' WHEN 1 THEN 'JAWA TENGAH' WHEN 2 THEN 'JAWA TIMUR'
    WHEN 3 THEN 'KALIMANTAN' WHEN 4 THEN 'SULAWESI' WHEN 5 THEN '3PL' WHEN 6 THEN 'SUMATERA BAGIAN UTARA'
    WHEN 7 THEN 'SUMATERA BAGIAN SELATAN' WHEN 8 THEN 'BALI' END AS kanwil
FROM {nation}""",
    "reason_codes": values(
        [(str(i), quoted(f"P{i}"), quoted(reason)) for i, reason in enumerate(ALL_REASONS)], "n, code, reason"
    ),
    "parcels": f"""
SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS price, o_orderstatus AS status, o_orderpriority AS priority,
  s.province AS sender_province, r.province AS recipient_province,
  TIMESTAMP '2024-01-31 02:00:00'
    - INTERVAL '1' SECOND * ((o_orderkey * 37 + o_custkey) % 120 * 86400 + (o_orderkey * 7919 + o_custkey * 31) % 86400)
    AS base
FROM {{orders}}
LEFT JOIN {{customer}} ON c_custkey = o_custkey
LEFT JOIN {{places}} s ON s.place = c_nationkey
LEFT JOIN {{places}} r ON r.place = o_orderkey % 25""",
    "versions": """
SELECT *, 0 AS v FROM {parcels} UNION ALL SELECT *, 1 AS v FROM {parcels} WHERE price < 150000""",
    "order_order": f"""
SELECT *,
  CASE WHEN k % 4 <> 0 THEN {_after("input_time", "21600")} END AS start_pickup_time,
  CASE WHEN k % 11 <> 0 THEN {_after("input_time", "21600 + k % 60 * 3600")} END AS end_pickup_time,
  CASE WHEN k % 5 = 0 THEN {_after("input_time", "k % 40 * 3600")} END AS pickup_failure_time,
  CASE WHEN (k + v) % 3 <> 0 THEN {_after("input_time", "(k * 17 % 100 - 5) * 3600")} END AS pickup_time
FROM (
  SELECT k, v,
    CASE WHEN (k * 7 + c) % 23 <> 0 THEN 'WB' || {_text("k")} END AS waybill_no, {_CONTRACT},
    {_text("k % 7")} AS order_source, {_text("(k + v) % 4")} AS order_status,
    {_after("base", "v * 7200")} AS input_time, {_after("base", "(k * 13 % 50) * 3600 - v * 1800")} AS update_time,
    'TH ' || {_text("c % 15")} AS scheduling_target_branch_name, 'TH ' || {_text("k % 15")} AS pickup_branch_name,
    CASE WHEN k % 5 = 0 THEN 'P' || {_text(f"(k * 3 + c) % {len(ALL_REASONS) + 5}")} END
      AS pickup_failure_problem_code,
    c % 41 AS pickup_courier_id, 'Courier ' || {_text("c % 41")} AS pickup_courier_name,
    {_dec("k % 901")} AS standard_shipping_fee, {_dec("k % 911")} AS total_shipping_fee,
    {_dec("k % 71")} AS insurance_amount, {_dec("k % 51")} AS handling_fee, {_dec("k % 31")} AS other_fee,
    {_dec("k % 23")} AS item_weight, {_dec("k % 24")} AS item_actual_weight,
    {_dec("k % 25")} AS item_calculated_weight, {_dec("k % 1000")} AS item_value,
    'Ordered item ' || {_text("k % 50")} AS item_name, {_PEOPLE}
  FROM {{versions}} WHERE priority <> '5-LOW'
) AS o""",
    "waybill_waybill": f"SELECT {_WAYBILL} FROM {{versions}} WHERE priority <> '1-URGENT'",
    "dm_waybill_waybill": f"""
SELECT {_WAYBILL}, c % 40 AS pod_courier_id, c % 15 AS pod_branch_id,
  CASE WHEN k % 2 = 0 THEN 'TH ' || {_text("k % 12")} END AS delivery_branch_name
FROM {{versions}} WHERE priority <> '1-URGENT'""",
    "waybill_waybill_line": f"""
SELECT 'WB' || {_text("k")} AS waybill_no,
  {_after("base", "(l_partkey * 7 + l_linenumber * 113) % 900 * 3600 + l_suppkey * 61 % 3600")} AS record_time,
  CASE l_partkey % 8 WHEN 0 THEN '03' WHEN 1 THEN '04' WHEN 2 THEN '05' WHEN 3 THEN '09' WHEN 4 THEN '09'
    WHEN 5 THEN '18' WHEN 6 THEN '18' WHEN 7 THEN CASE WHEN l_linenumber < 3 THEN '30' ELSE '99' END END
    AS operation_type,
  CASE l_suppkey % 5 WHEN 0 THEN 'MH EAST' WHEN 1 THEN 'MH WEST' WHEN 2 THEN 'TH NORTH' WHEN 3 THEN 'TH SOUTH' END
    AS operation_branch_name,
  CASE WHEN l_partkey % 8 IN (5, 6) THEN 'P' || {_text(f"l_partkey % {len(ALL_REASONS) + 5}")} END AS problem_code,
  CASE WHEN l_partkey % 8 IN (5, 6)
    THEN CASE l_linenumber % 4 WHEN 0 THEN '02' WHEN 1 THEN '01' WHEN 2 THEN '03' END END AS problem_type,
  'scan/' || {_text("l_suppkey")} AS photo_url,
  CASE WHEN l_returnflag = 'A' THEN 'BM' || {_text("l_suppkey % 40")} WHEN l_returnflag = 'N' THEN '' END AS bag_no,
  CASE WHEN l_linestatus = 'F' THEN 'VM' || {_text("l_partkey % 3")} END AS vehicle_tag_no
FROM {{lineitem}} JOIN {{parcels}} ON l_orderkey = k""",
    "waybill_problem_piece": f"""
SELECT 'WB' || {_text("k")} AS waybill_no,
  {_after("base", "(l_suppkey * 5 + l_linenumber * 29) % 400 * 3600")} AS operation_time, reason AS problem_reason,
  CASE l_linenumber % 4 WHEN 0 THEN '02' WHEN 1 THEN '01' WHEN 2 THEN '03' END AS problem_type
FROM {{lineitem}} JOIN {{parcels}} ON l_orderkey = k
LEFT JOIN {{reason_codes}} ON n = (l_partkey * 7 + l_suppkey) % {len(ALL_REASONS) + 3}
WHERE l_returnflag = 'R'""",
    "waybill_return_bill": f"""
SELECT 'WB' || {_text("k")} AS waybill_no, 'RT' || {_text("k")} AS return_waybill_no,
  {_after("base", "k % 20 * 86400 + v * 3600")} AS update_time,
  {_after("base", "k * 7 % 40 * 86400")} AS return_record_time,
  CASE WHEN (k + v) % 3 <> 0 THEN {_after("base", "k * 5 % 400 * 3600 + v * 7200")} END AS return_confirm_record_time,
  CASE WHEN k % 5 = 0 THEN {_after("base", "k % 45 * 86400")} END AS return_pod_record_time,
  {_text("(k + v) % 3")} AS return_confirm_status, k % 4 AS return_type_id, 'TH ' || {_text("k % 15")}
    AS return_branch_name, {_dec("k % 60")} AS return_shipping_fee, 'return/' || {_text("k")} AS return_pod_photo_url,
  sender_province || ' CITY ' || {_text("c % 3")} AS recipient_city_name, sender_province AS recipient_province_name,
  CASE WHEN k % 6 = 0 THEN '1' ELSE '0' END AS deleted
FROM {{versions}} WHERE status = 'F'""",
    "system_option": values(
        [(quoted(t), quoted(v), quoted(n)) for t, codes in _OPTIONS.items() for v, n in codes.items()],
        "type_option, option_value, option_name",
    ),
    "mapping_kanwil_area": "SELECT province AS province_name, kanwil AS kanwil_name FROM {places}",
    "masterdata_city_mapping_area_island_new": f"""
SELECT city, province, 'Island ' || {_text("min(place) % 4")} AS pulau FROM (
  SELECT sender_province || ' CITY ' || {_text("c % 3")} AS city, sender_province AS province FROM {{parcels}}
  UNION ALL
  SELECT recipient_province || ' CITY ' || {_text("k % 3")}, recipient_province FROM {{parcels}}
) AS seen JOIN {{places}} USING (province) GROUP BY city, province""",
    "masterdata_sla_shopee": f"""
SELECT origin_city, destination_city,
  CASE lowest % 6 WHEN 0 THEN '3' WHEN 1 THEN '3 hari' WHEN 2 THEN '3.5' WHEN 3 THEN '999' WHEN 4 THEN '6' END AS sla
FROM (
  SELECT sender_province || ' CITY ' || {_text("c % 3")} AS origin_city,
    recipient_province || ' CITY ' || {_text("k % 3")} AS destination_city, min(k) AS lowest
  FROM {{parcels}} GROUP BY 1, 2
) AS pairs""",
    "masterdata_sales_source": values(
        [
            ("'Shopee platform'", "'Marketplace'", "'Ani'"),
            ("'Blibli'", "'Marketplace'", "'Budi'"),
            ("'VIP Customer Portal'", "'Direct'", "'Citra'"),
        ],
        "source, division, sales_name",
    ),
    "masterdata_sales_seller_vip": f"""
SELECT seller_name, CASE n % 4 WHEN 0 THEN 'Mitra' WHEN 1 THEN 'Direct' WHEN 2 THEN 'Corporate' END AS division,
  CASE n % 4 WHEN 0 THEN 'Mitra' WHEN 1 THEN 'Dewi' END AS sales_name
FROM (SELECT 'shop' || {_text("c_custkey % 20")} AS seller_name, min(c_custkey % 20) AS n
      FROM {{customer}} GROUP BY 1) AS shops""",
    "res_problem_package": """
SELECT code, reason AS register_reason_bahasa, '0' AS deleted FROM {reason_codes}
UNION ALL SELECT code, 'Old text', '1' FROM {reason_codes}""",
    "return_type": values([(0, "'Refused'", 0), (1, "'Bad address'", 0), (2, "'Old'", 1)], "id, return_type, deleted"),
    "res_user": f"""
SELECT id, 'PN' || {_text("id")} AS personnel_no, CASE WHEN id % 3 = 0 THEN '0' ELSE '1' END AS enabled,
  CASE WHEN id % 10 = 0 THEN '1' ELSE '0' END AS deleted
FROM (SELECT DISTINCT c_custkey % 40 AS id FROM {{customer}}) AS u""",
    "res_branch": f"""
SELECT id, 'B' || {_text("id")} AS branch_no, {_text("id % 6")} AS branch_level, id % 10 AS city_id
FROM (SELECT DISTINCT s_suppkey % 15 AS id FROM {{supplier}}) AS b""",
    "res_area": """
SELECT place % 10 AS city_id, province AS province_name FROM {places}""",
    "standard_shipping_fee": f"""
SELECT 'S' || {_text("client")} || '-' || {_text("city")} || '-' || {_text("district")} || '-' || express
    || '-' || {_text("lowest % 2")} AS search_code,
  city AS sender_location_id, district AS recipient_location_id, express AS express_type,
  client AS shipping_client_id, {_dec("0")} AS discount_rate, 1 AS min_sla,
  CASE WHEN lowest % 9 = 0 THEN 999 WHEN lowest % 9 = 1 THEN NULL ELSE lowest % 7 END AS max_sla,
  {_after("TIMESTAMP '2024-01-30 17:00:00'", "lowest % 5 * 43200")} AS end_expire_time,
  CASE WHEN lowest % 8 = 0 THEN '1' ELSE '0' END AS deleted,
  {_after("TIMESTAMP '2023-01-01 00:00:00'", "lowest * 60")} AS created_at
FROM (
  SELECT c % 10 AS client, k % 10 AS city, k % 12 AS district, {_text("k % 2")} AS express, status, min(k) AS lowest
  FROM {{parcels}} GROUP BY 1, 2, 3, 4, 5
) AS lanes""",
    "mitra_late_reason_delivery": f"""
SELECT 'WB' || {_text("k")} AS waybill_no, reason AS late_delivery_reason
FROM {{parcels}} JOIN {{reason_codes}} ON n = k % {len(ALL_REASONS)} WHERE status = 'O'""",
    "masterdata_branch_coverage_th": f"""
SELECT id AS district_id, 'TH ' || {_text("id")} AS branch_name
FROM (SELECT DISTINCT o_orderkey % 12 AS id FROM {{orders}}) AS d WHERE id <> 5""",
    "a_mh_facility_name_rnd": f"""
SELECT 'H' || {_text("n_nationkey")} AS mh_code, 'MH ' || n_name AS mh_name FROM {{nation}}
UNION ALL SELECT 'H' || {_text("n_nationkey")}, 'MH ' || n_name || ' ANNEX' FROM {{nation}}""",
    "smu_template_2": f"""
SELECT CASE WHEN suppliers % 2 = 0 THEN '07/15/2023' ELSE '01/02/2024' END AS report_date,
  CASE WHEN bag % 5 = 0 THEN 'CGK' ELSE 'H' || {_text("bag")} END AS origin,
  'H' || {_text("vehicle")} AS destination_by_bagging,
  CASE WHEN vehicle = 0 THEN 'CGK' ELSE 'H' || {_text("vehicle")} END AS destination_by_issued,
  suppliers AS no_of_packages, {_dec("bag * 3")} AS smu_weight, 'BM' || {_text("bag")} AS bm_code,
  CASE WHEN bag % 9 = 0 THEN NULL ELSE 'VM' || {_text("vehicle")} END AS vm_code, 'Island' AS area_pulau,
  'SMU' || {_text("bag * 10 + vehicle")} AS smu_booking_code, {_dec("bag * 100")} AS total_smu_fee,
  'FL' || {_text("vehicle")} AS flight_no, 'Airline' AS airlanes, 'Vendor' AS vendor
FROM (SELECT l_suppkey % 45 AS bag, l_partkey % 4 AS vehicle, count(DISTINCT l_suppkey) AS suppliers
      FROM {{lineitem}} GROUP BY 1, 2) AS tags""",
}

BASE = ["orders", "lineitem", "customer", "supplier", "nation"]


def _needed(names: Sequence[str]) -> list[str]:
    """The named tables and what they are derived from, in dependency order."""
    found: set[str] = set()

    def need(name: str) -> None:
        if name in QUERIES and name not in found:
            found.add(name)
            for other in QUERIES:
                if "{" + other + "}" in QUERIES[name]:
                    need(other)

    for name in names:
        need(name)
    return [name for name in QUERIES if name in found]


def frames(
    spark: SparkSession, sf_dir: str, names: Sequence[str], known: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Derived tables and helpers as they come out of their queries."""
    known = {} if known is None else known
    for name in BASE:
        known.setdefault(name, spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    for name in _needed(names):
        if name not in known:
            used = {n: df for n, df in known.items() if "{" + n + "}" in QUERIES[name]}
            known[name] = spark.sql(QUERIES[name], **used)
    return known


class DerivedTables(Tables):
    """Parcel tables on one scale-factor folder; each is derived when a report first asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__({})
        self._spark, self._sf_dir, self._known = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            rows = frames(self._spark, self._sf_dir, [name], self._known)[name]
            self._frames[name] = conform(rows, SCHEMAS[name])
        return self._frames[name]


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return DerivedTables(spark, sf_dir)


def with_tables(*names: str) -> str:
    """A DuckDB WITH list that defines the named parcel tables and what they need."""
    plain = {n: n for n in [*BASE, *QUERIES]}
    return "WITH " + ",\n".join(f"{n} AS ({QUERIES[n].format(**plain)})" for n in _needed(names))
