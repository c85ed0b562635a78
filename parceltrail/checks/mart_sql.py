"""DuckDB forms of the report marts over the derived parcel tables.

They state each report directly (pairing, running extremes, full joins) where the Spark plans use one-pass summaries
and key pruning, so a match also checks those rewrites.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from parceltrail.checks.compare import typed
from parceltrail.checks.domain import CLOCK, quoted, with_tables
from parceltrail.functions import courier, delivery, pickup, reasons
from parceltrail.plans.cargo import AMOUNTS, PLACES
from parceltrail.plans.daily_report import OUTPUTS as REPORT_OUTPUTS
from parceltrail.plans.daily_report import POLICY as REPORT_POLICY
from parceltrail.plans.seller_performance import OUTPUTS as SELLER_OUTPUTS
from parceltrail.plans.seller_performance import POLICY as SELLER_POLICY

UTC_TODAY = f"DATE '{CLOCK.utc_today}'"
TODAY = f"DATE '{CLOCK.local_today}'"
SELLER = "seller3"


def local(ts: str) -> str:
    return f"({ts} + INTERVAL 7 HOUR)"


def ldate(ts: str) -> str:
    return f"CAST({local(ts)} AS DATE)"


def recent(ts: str, days: int) -> str:
    return f"{ldate(ts)} >= {UTC_TODAY} - {days}"


def label(kind: str, code: str) -> str:
    return f"(SELECT option_name FROM system_option WHERE type_option = '{kind}' AND option_value = {code})"


def region(province: str) -> str:
    return f"(SELECT kanwil_name FROM mapping_kanwil_area m WHERE m.province_name = {province})"


def island(city: str, province: str) -> str:
    return (
        "(SELECT pulau FROM masterdata_city_mapping_area_island_new m "
        f"WHERE m.city = {city} AND m.province = {province})"
    )


def among(value: str, members: Sequence[str]) -> str:
    return f"{value} IN ({', '.join(quoted(m) for m in members)})"


def classes(value: str, groups: Mapping[str, Sequence[str]]) -> str:
    return " ".join(f"WHEN {among(value, members)} THEN {quoted(name)}" for name, members in groups.items())


def newest(table: str, where: str, by: str, ties: Sequence[str], key: str = "waybill_no") -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in (by, *ties))
    return f"SELECT DISTINCT ON ({key}) * FROM {table} WHERE {where} ORDER BY {key}, {order}"


def newest_waybill(where: str, table: str = "waybill_waybill") -> str:
    return newest(table, where, "update_time", ["shipping_time", "order_no"])


def newest_return(where: str) -> str:
    return newest("waybill_return_bill", where, "update_time", ["return_record_time", "return_waybill_no"])


def return_backlog() -> str:
    def bucket(state: str, aging: str) -> str:
        return (
            f"CASE WHEN backlog_return_flag = '{state}' THEN CASE WHEN {aging} > 30 THEN '>30 Days' "
            f"WHEN {aging} > 14 THEN '15-30 Days' WHEN {aging} > 7 THEN '8-14 Days' WHEN {aging} > 2 THEN '3-7 Days' "
            f"WHEN {aging} <= 2 THEN '<3 Days' END END"
        )

    kept = [
        "sender_name",
        "sender_cellphone",
        "sender_province_name",
        "sender_city_name",
        "sender_district_name",
        "pickup_branch_name",
        "recipient_district_name",
        "recipient_city_name",
        "recipient_province_name",
    ]
    body = f"""
SELECT *, {bucket("Backlog Confirm Return", "aging_backlog_confirm")} AS backlog_confirm_category,
  {bucket("Backlog Return", "aging_backlog_return")} AS backlog_return_category
FROM (
  SELECT w.waybill_no, 1 AS waybill_alias, {local("w.shipping_time")} AS shipping_time,
    {label("waybillSource", "w.waybill_source")} AS waybill_source, w.parent_shipping_cleint AS vip_username,
    {", ".join("w." + c for c in kept)},
    {label("expressType", "w.express_type")} AS express_type,
    {label("serviceType", "w.service_type")} AS service_type,
    {region("w.recipient_province_name")} AS kanwil_name_regist,
    {local("r.return_record_time")} AS return_regist_time, r.return_branch_name AS return_register_branch,
    (SELECT return_type FROM return_type y WHERE y.id = r.return_type_id AND y.deleted = 0) AS remarks_return,
    {local("r.return_confirm_record_time")} AS return_confirm_time,
    {label("returnConfirmStatus", "r.return_confirm_status")} AS return_confirm_status, r.return_shipping_fee,
    {local("r.return_pod_record_time")} AS return_pod_record_time, {local("r.update_time")} AS update_time_rr,
    1 AS return_regist_alias, (r.return_confirm_record_time IS NOT NULL)::INT AS return_confirm_alias,
    (r.return_confirm_record_time IS NULL)::INT AS backlog_confirm_alias, 0 AS return_pod_alias,
    CASE WHEN r.return_confirm_record_time IS NULL THEN 'Backlog Confirm Return' ELSE 'Backlog Return' END
      AS backlog_return_flag,
    {UTC_TODAY} - {ldate("r.return_record_time")} AS aging_backlog_confirm,
    {UTC_TODAY} - {ldate("r.return_confirm_record_time")} AS aging_backlog_return
  FROM ({newest_waybill(f"{recent('update_time', 62)} AND void_flag = '0' AND deleted = '0'")}) AS w
  JOIN ({newest_return(f"{recent('update_time', 62)} AND {recent('return_record_time', 62)}")}) AS r USING (waybill_no)
  WHERE r.return_pod_record_time IS NULL AND r.return_record_time IS NOT NULL
) AS joined"""
    names = with_tables(
        "waybill_waybill", "waybill_return_bill", "system_option", "mapping_kanwil_area", "return_type"
    )
    return f"{names} " + typed(
        body,
        ["shipping_time", "return_regist_time", "return_confirm_time", "return_pod_record_time", "update_time_rr"],
        ["return_shipping_fee"],
        [
            "waybill_alias",
            "return_regist_alias",
            "return_confirm_alias",
            "backlog_confirm_alias",
            "return_pod_alias",
            "aging_backlog_confirm",
            "aging_backlog_return",
        ],
    )


def longest_dwell(returned: bool, prefix: str = "") -> tuple[str, str]:
    """(CTE list, select) of one dwell mart."""
    compare = ">" if returned else ">="
    closes = "AND EXISTS (SELECT 1 FROM {p}bills b WHERE b.waybill_no = s.waybill_no AND s.moment < b.confirmed)"
    closes = closes.format(p=prefix) if returned else ""
    back = f"EXISTS (SELECT 1 FROM {prefix}bills b WHERE b.waybill_no = s.waybill_no AND s.moment {compare} b.confirmed)"
    side = (
        "'forward delivery'"
        if returned
        else (
            f"CASE WHEN EXISTS (SELECT 1 FROM {prefix}bills b WHERE b.waybill_no = s.waybill_no AND s.moment >= b.confirmed) "
            "THEN 'return process' ELSE 'forward delivery' END"
        )
    )
    opening = "operation, previous_branch_name_1, previous_branch_name_2, next_branch_name"

    def edge(condition: str, descending: bool, columns: str, extra: str) -> str:
        way = "DESC NULLS LAST" if descending else "ASC NULLS FIRST"
        order = ", ".join(f"{c.strip()} {way}" for c in f"moment, {columns}".split(","))
        return (
            f"SELECT DISTINCT ON (waybill_no, branch) waybill_no, branch, moment, {columns}{extra} "
            f"FROM {prefix}log s WHERE {condition} ORDER BY waybill_no, branch, {order}"
        )

    ctes = f"""
{prefix}bills AS (
  SELECT waybill_no, {local("return_confirm_record_time")} AS confirmed, update_time FROM waybill_return_bill
  WHERE {recent("update_time", 93)}
),
{prefix}base AS (
  SELECT w.waybill_no, {local("w.shipping_time")} AS shipping_time,
    {label("waybillSource", "w.waybill_source")} AS waybill_source
  FROM ({newest_waybill(f"{recent('shipping_time', 93)} AND void_flag = '0' AND deleted = '0'")}) AS w
  LEFT JOIN (SELECT DISTINCT ON (waybill_no) * FROM {prefix}bills
             ORDER BY waybill_no, update_time DESC, confirmed DESC NULLS LAST) AS b USING (waybill_no)
  WHERE b.confirmed IS {"NOT " if returned else ""}NULL
),
{prefix}log AS (
  SELECT waybill_no, branch, moment, operation,
    lag(branch) OVER w AS previous_branch_name_1, lag(branch, 2) OVER w AS previous_branch_name_2,
    lead(branch) OVER w AS next_branch_name
  FROM (SELECT waybill_no, operation_branch_name AS branch, {local("record_time")} AS moment,
          {label("operationType", "operation_type")} AS operation
        FROM waybill_waybill_line WHERE {recent("record_time", 93)}) AS decoded
  WINDOW w AS (PARTITION BY waybill_no ORDER BY moment, operation NULLS FIRST, branch NULLS FIRST)
),
{prefix}place AS (
  SELECT DISTINCT ON (waybill_no) waybill_no, branch AS last_location, moment AS latest_scan_time
  FROM {prefix}log ORDER BY waybill_no, moment DESC, branch DESC NULLS LAST
),
{prefix}stays AS (
  SELECT o.*, c.operation AS operation_type_2, c.branch AS branch_name_2, c.moment AS closed, c.side
  FROM ({edge("operation <> 'Pickup Failure'", False, opening, "")}) AS o
  LEFT JOIN ({edge(f"operation <> 'Confirm Return Bill' {closes}", True, "operation", f", {side} AS side")}) AS c
    USING (waybill_no, branch)
  UNION ALL
  SELECT o.*, c.operation, c.branch, c.moment, c.side
  FROM ({edge(back, False, opening, "")}) AS o
  LEFT JOIN ({edge(back, True, "operation", ", 'return process' AS side")}) AS c USING (waybill_no, branch)
)"""
    select = f"""
SELECT waybill_no, shipping_time, waybill_source, operation AS operation_type, branch AS branch_name_1,
  moment AS first_scan_time_branch, previous_branch_name_1, previous_branch_name_2, next_branch_name, operation_type_2,
  branch_name_2, closed AS last_scan_time_branch, last_location, latest_scan_time, side AS return_or_not_last_scan,
  '{"Return" if returned else "Non-Return"}' AS return_or_not, hours AS scan_record_duration_hour,
  seconds AS scan_record_duration_sec, ranking,
  date_diff('day', moment, closed) AS scan_record_duration_day,
  {TODAY} - CAST(latest_scan_time AS DATE) AS aging_from_last_scan,
  hours / 24 AS scan_record_duration_day_1, ceil(hours / 24) AS rounded_duration_day
FROM (
  SELECT *, rank() OVER (PARTITION BY waybill_no ORDER BY seconds DESC NULLS LAST) AS ranking
  FROM (SELECT *, date_diff('hour', moment, closed) AS hours, date_diff('second', moment, closed) AS seconds
        FROM {prefix}base JOIN {prefix}stays USING (waybill_no) JOIN {prefix}place USING (waybill_no)) AS timed
) AS ranked
WHERE ranking <= 3 AND ceil(hours / 24) >= 14"""
    return ctes, select


_DWELL_TIMES = ["shipping_time", "first_scan_time_branch", "last_scan_time_branch", "latest_scan_time"]
_DWELL_NUMBERS = ["scan_record_duration_day_1", "rounded_duration_day"]
_DWELL_COUNTS = [
    "scan_record_duration_hour",
    "scan_record_duration_sec",
    "ranking",
    "scan_record_duration_day",
    "aging_from_last_scan",
]
_DWELL_TABLES = ["waybill_waybill", "waybill_return_bill", "waybill_waybill_line", "system_option"]


def dwell(returned: bool) -> str:
    ctes, select = longest_dwell(returned)
    return f"{with_tables(*_DWELL_TABLES)}, {ctes} " + typed(select, _DWELL_TIMES, _DWELL_NUMBERS, _DWELL_COUNTS)


def dwell_union() -> str:
    out_ctes, out_select = longest_dwell(False, "f_")
    back_ctes, back_select = longest_dwell(True, "r_")
    body = f"""
SELECT *, operation_type || ' - ' || operation_type_2 AS operation_type_1_2, branch_name_1 AS branch_name,
  scan_record_duration_hour AS leadtime_hour, scan_record_duration_sec AS leadtime_sec
FROM ({out_select} UNION ALL {back_select}) AS both_marts
WHERE CAST(shipping_time AS DATE) BETWEEN {UTC_TODAY} - 93 AND {UTC_TODAY} - 78 AND first_scan_time_branch IS NOT NULL"""
    return f"{with_tables(*_DWELL_TABLES)}, {out_ctes}, {back_ctes} " + typed(
        body, _DWELL_TIMES, _DWELL_NUMBERS, [*_DWELL_COUNTS, "leadtime_hour", "leadtime_sec"]
    )


def vip_problem_check() -> str:
    def nth(source: str, i: int, value: str) -> str:
        return f"(SELECT max({value}) FROM {source} x WHERE x.waybill_no = w.waybill_no AND x.id = {i})"

    body = f"""
SELECT w.waybill_no, {local("w.shipping_time")} AS shipping_time, w.source AS waybill_source,
  w.vip_customer_name AS vip_username, w.pickup_branch_name, w.sender_province_name, w.sender_city_name,
  w.recipient_province_name, w.recipient_city_name, w.state AS waybill_status,
  {nth("tries", 1, "x.at")} AS deliv_attempt_1, {nth("fails", 1, "x.at")} AS pos_attempt_1,
  {nth("fails", 1, "x.problem_reason")} AS pos_reason_1, {nth("tries", 2, "x.at")} AS deliv_attempt_2,
  {nth("fails", 2, "x.at")} AS pos_attempt_2, {nth("fails", 2, "x.problem_reason")} AS pos_reason_2,
  p.last_location, n.count_pos_attempt, d.count_deliv_attempt
FROM (
  SELECT DISTINCT ON (waybill_no) * FROM (
    SELECT *, {label("waybillSource", "waybill_source")} AS source, {label("waybillStatus", "waybill_status")} AS state
    FROM waybill_waybill
    WHERE {recent("shipping_time", 62)} AND void_flag = '0' AND deleted = '0' AND pod_record_time IS NULL
      AND return_pod_record_time IS NULL) AS decoded
  WHERE source = 'VIP Customer Portal' AND state NOT IN ('Signed', 'Return Received')
  ORDER BY waybill_no, update_time DESC, shipping_time DESC, order_no DESC
) AS w
JOIN (SELECT waybill_no, count(*) AS count_pos_attempt FROM scans WHERE operation_type = '18' GROUP BY 1) AS n
  USING (waybill_no)
LEFT JOIN (SELECT waybill_no, count(activity) AS count_deliv_attempt FROM scans WHERE operation_type = '09' GROUP BY 1)
  AS d USING (waybill_no)
LEFT JOIN (SELECT DISTINCT ON (waybill_no) waybill_no, operation_branch_name AS last_location FROM scans
           ORDER BY waybill_no, record_time DESC, operation_branch_name DESC NULLS LAST) AS p USING (waybill_no)
WHERE n.count_pos_attempt >= 2"""
    ctes = f"""
scans AS (SELECT *, {label("operationType", "operation_type")} AS activity FROM waybill_waybill_line
  WHERE {recent("record_time", 62)}),
tries AS (SELECT waybill_no, {local("record_time")} AS at,
    rank() OVER (PARTITION BY waybill_no ORDER BY record_time) AS id FROM scans WHERE operation_type = '09'),
fails AS (SELECT waybill_no, {local("operation_time")} AS at, problem_reason,
    rank() OVER (PARTITION BY waybill_no ORDER BY operation_time) AS id
  FROM waybill_problem_piece WHERE {recent("operation_time", 62)} AND problem_type <> '02')"""
    names = with_tables("waybill_waybill", "waybill_waybill_line", "waybill_problem_piece", "system_option")
    return f"{names}, {ctes} " + typed(
        body,
        ["shipping_time", "deliv_attempt_1", "pos_attempt_1", "deliv_attempt_2", "pos_attempt_2"],
        [],
        ["count_pos_attempt", "count_deliv_attempt"],
    )


def vip_revenue() -> str:
    body = f"""
SELECT *, (coalesce(aging_from_pickup_to_date = 0, false))::INT AS aging_0day,
  (coalesce(aging_from_pickup_to_date BETWEEN 1 AND 2, false))::INT AS aging_1_2day,
  (coalesce(aging_from_pickup_to_date BETWEEN 3 AND 14, false))::INT AS aging_3_14day,
  (coalesce(aging_from_pickup_to_date > 14, false))::INT AS aging_more_15day
FROM (
  SELECT shipping_date, waybill_source, vip_username, source_category, waybill_status, return_flag, last_status,
    service_type, express_type, kanwil_name, recipient_province_name, recipient_city_name, recipient_district_name,
    th_destination, pos_reason, aging_from_pickup_to_date, leadtime_pickup_to_pod,
    count(waybill_no) AS total_pickup, count(pod_record_time) AS total_pod,
    count(*) - count(pod_record_time) AS total_not_pod, sum(standard_shipping_fee) AS gross_revenue,
    count(problem_at) AS total_waybill_pos,
    count(*) FILTER (pod_record_time IS NULL AND problem_at IS NOT NULL) AS not_pod_with_pos,
    count(*) FILTER (pod_record_time IS NULL AND problem_at IS NULL) AS not_pod_without_pos,
    count(*) FILTER (pod_record_time IS NOT NULL AND problem_at IS NOT NULL) AS pod_with_pos,
    count(*) FILTER (pod_record_time IS NOT NULL AND problem_at IS NULL) AS pod_without_pos,
    count(DISTINCT shipping_date) AS count_shipping_date, count(pos_reason) AS count_pos_reason
  FROM (
    SELECT w.waybill_no, w.pod_record_time, w.standard_shipping_fee, p.at AS problem_at,
      {ldate("w.shipping_time")} AS shipping_date, w.source AS waybill_source, w.parent_shipping_cleint AS vip_username,
      CASE WHEN (s.division = 'Mitra' AND s.sales_name = 'Mitra') OR (s.division IS NULL AND s.sales_name IS NULL)
        THEN 'VIP Seller Amartha' ELSE 'VIP Seller HO' END AS source_category,
      {label("waybillStatus", "w.waybill_status")} AS waybill_status, {label("returnFlag", "w.return_flag")} AS return_flag,
      CASE WHEN w.pod_record_time IS NOT NULL THEN 'Delivered' WHEN w.return_pod_record_time IS NOT NULL THEN 'Returned'
        WHEN {label("returnFlag", "w.return_flag")} = 'Retur' THEN 'Return Process'
        WHEN {label("returnFlag", "w.return_flag")} = 'Tidak Retur'
          AND {label("waybillStatus", "w.waybill_status")} NOT IN ('Signed', 'Return Received') THEN 'Stuck'
      END AS last_status,
      {label("serviceType", "w.service_type")} AS service_type, {label("expressType", "w.express_type")} AS express_type,
      {region("w.recipient_province_name")} AS kanwil_name, w.recipient_province_name, w.recipient_city_name,
      w.recipient_district_name, coalesce(w.delivery_branch_name, h.branch_name) AS th_destination,
      p.reason AS pos_reason,
      CASE WHEN w.pod_record_time IS NULL THEN {TODAY} - {ldate("w.shipping_time")} END AS aging_from_pickup_to_date,
      {ldate("w.pod_record_time")} - {ldate("w.shipping_time")} AS leadtime_pickup_to_pod
    FROM (
      SELECT DISTINCT ON (waybill_no) * FROM (
        SELECT *, {label("waybillSource", "waybill_source")} AS source FROM dm_waybill_waybill
        WHERE {recent("shipping_time", 93)} AND void_flag = '0') AS decoded
      WHERE source = 'VIP Customer Portal' ORDER BY waybill_no, update_time DESC, shipping_time DESC, order_no DESC
    ) AS w
    LEFT JOIN masterdata_sales_seller_vip s ON s.seller_name = w.vip_customer_name
    LEFT JOIN masterdata_branch_coverage_th h ON h.district_id = w.recipient_district_id
    LEFT JOIN (
      SELECT DISTINCT ON (waybill_no) waybill_no, operation_time AS at, problem_reason AS reason
      FROM waybill_problem_piece WHERE {recent("operation_time", 93)} AND problem_type <> '02'
      ORDER BY waybill_no, operation_time DESC, problem_reason DESC NULLS LAST
    ) AS p ON p.waybill_no = w.waybill_no
  ) AS parcels_with_problem
  GROUP BY ALL
) AS grouped"""
    names = with_tables(
        "dm_waybill_waybill",
        "waybill_problem_piece",
        "system_option",
        "mapping_kanwil_area",
        "masterdata_sales_seller_vip",
        "masterdata_branch_coverage_th",
    )
    return f"{names} " + typed(
        body,
        ["shipping_date"],
        ["gross_revenue"],
        [
            "aging_from_pickup_to_date",
            "leadtime_pickup_to_pod",
            "total_pickup",
            "total_pod",
            "total_not_pod",
            "total_waybill_pos",
            "not_pod_with_pos",
            "not_pod_without_pos",
            "pod_with_pos",
            "pod_without_pos",
            "count_shipping_date",
            "count_pos_reason",
            "aging_0day",
            "aging_1_2day",
            "aging_3_14day",
            "aging_more_15day",
        ],
    )


def zone(level: str, kanwil: str, province: str) -> str:
    regional = " ".join(
        [
            *(f"WHEN {kanwil} = '{k}' THEN '{v}'" for k, v in courier.SUMATRA_ZONES.items()),
            *(f"WHEN {province} = '{k}' THEN '{v}'" for k, v in courier.PROVINCE_ZONES.items()),
            *(f"WHEN {kanwil} = '{k}' THEN '{v}'" for k, v in courier.REGION_ZONES.items()),
        ]
    )
    own = among(level, courier.OWN_ZONE_LEVELS)
    return (
        f"CASE WHEN {among(level, courier.REGIONAL_LEVELS)} THEN CASE {regional} END WHEN {own} THEN {level} END"
    )


def courier_incentive() -> str:
    def half(source: str, fields: str, branch_id: str, task: str, picked: int) -> str:
        return f"""
SELECT waybill_no, 1 AS waybill_alias, {label("waybillSource", "w.waybill_source")} AS waybill_source,
  {label("expressType", "w.express_type")} AS express_type, w.courier_id, u.personnel_no, w.courier_name,
  CASE u.enabled WHEN '1' THEN 'active' WHEN '0' THEN 'inactive' END AS courier_status, w.tgl_tugas, b.branch_no,
  w.branch_name, w.district_name, w.city_name, a.province_name,
  {zone("b.level", region("a.province_name"), "a.province_name")} AS kanwil_name,
  b.branch_no || ' - ' || {zone("b.level", region("a.province_name"), "a.province_name")} || ' ' || w.branch_name
    AS work_location,
  u.enabled, b.level AS branch_level, '{task}' AS task_type, {picked} AS pickup, {1 - picked} AS pod
FROM (SELECT *, {fields} FROM {source}) AS w
LEFT JOIN (SELECT *, {label("branchLevel", "branch_level")} AS level FROM res_branch) AS b ON b.id = w.{branch_id}
LEFT JOIN (SELECT city_id, min(province_name) AS province_name FROM res_area GROUP BY 1) AS a ON a.city_id = b.city_id
LEFT JOIN res_user u ON u.id = w.courier_id AND u.deleted = '0'"""

    shipped = newest_waybill(f"{recent('shipping_time', 76)} AND void_flag = '0' AND deleted = '0'")
    ordered = newest("order_order", recent("input_time", 250), "update_time", ["input_time", "order_no"])
    picked = f"""(
  SELECT x.*, o.pickup_courier_id AS other_id, o.pickup_courier_name AS other_name
  FROM ({shipped}) AS x LEFT JOIN ({ordered}) AS o ON o.waybill_no = x.waybill_no) AS p"""
    delivered = newest_waybill(
        f"{recent('update_time', 76)} AND {recent('pod_record_time', 76)} AND deleted = '0'", "dm_waybill_waybill"
    )
    pickups = half(
        picked,
        f"""CASE pickup_courier_id WHEN 0 THEN other_id ELSE pickup_courier_id END AS courier_id,
    CASE pickup_courier_name WHEN '' THEN other_name ELSE pickup_courier_name END AS courier_name,
    {local("shipping_time")} AS tgl_tugas, pickup_branch_name AS branch_name, sender_district_name AS district_name,
    sender_city_name AS city_name""",
        "pickup_branch_id",
        "Pickup",
        1,
    )
    deliveries = half(
        f"({delivered}) AS p",
        f"""pod_courier_id AS courier_id, pod_courier_name AS courier_name, {local("pod_record_time")} AS tgl_tugas,
    pod_branch_name AS branch_name, recipient_district_name AS district_name, recipient_city_name AS city_name""",
        "pod_branch_id",
        "POD",
        0,
    )
    names = with_tables(
        "waybill_waybill",
        "dm_waybill_waybill",
        "order_order",
        "system_option",
        "res_branch",
        "res_area",
        "res_user",
        "mapping_kanwil_area",
    )
    return f"{names} " + typed(
        f"{pickups} UNION ALL {deliveries}", ["tgl_tugas"], [], ["waybill_alias", "courier_id", "pickup", "pod"]
    )


# The derived scans fall in this period.
CARGO_PERIOD = {
    "first": "2023-12-01",
    "last": "2024-01-31",
    "sending_first": "2023-11-01",
    "shipped_first": "2023-09-01",
    "shipped_last": "2024-03-01",
}
_CARGO_TABLES = ["waybill_waybill_line", "waybill_waybill", "system_option", "smu_template_2", "a_mh_facility_name_rnd"]


def _between(ts: str, first: str, last: str) -> str:
    return f"CAST({ts} AS DATE) BETWEEN DATE '{CARGO_PERIOD[first]}' AND DATE '{CARGO_PERIOD[last]}'"


def _cargo_base() -> str:
    tag = "bag_no || ' - ' || vehicle_tag_no"

    def hub(operation: str, first: str, way: str, name: str) -> str:
        nulls = "FIRST" if way == "DESC" else "LAST"
        return f"""(SELECT DISTINCT ON (bag_no, vehicle_tag_no, waybill_no) bag_no, vehicle_tag_no, waybill_no,
    operation_branch_name AS {name} FROM waybill_waybill_line
  WHERE operation_type = '{operation}' AND contains(operation_branch_name, 'MH') AND {_between("record_time", first, "last")}
  ORDER BY bag_no, vehicle_tag_no, waybill_no, record_time {way}, operation_branch_name {way} NULLS {nulls})"""

    return f"""
SELECT {tag} || ' - ' || s.waybill_no AS bm_vm_awb, {tag} AS bm_vm_concat, s.bag_no, s.vehicle_tag_no, s.waybill_no,
  {ldate("w.shipping_time")} AS shipping_time, {label("expressType", "w.express_type")} AS express_type,
  {ldate("s.first_scan")} AS record_time, {", ".join("w." + c for c in AMOUNTS)},
  w.item_calculated_weight AS system_weight, w.standard_shipping_fee + w.handling_fee AS system_sf,
  {", ".join("w." + c for c in PLACES)}, f.mh_sending, a.mh_arrival
FROM (
  SELECT bag_no, vehicle_tag_no, waybill_no, min(record_time) AS first_scan FROM waybill_waybill_line
  WHERE {_between("record_time", "first", "last")} AND bag_no <> '' AND vehicle_tag_no IS NOT NULL GROUP BY ALL
) AS s
JOIN ({newest_waybill(f"{_between('shipping_time', 'shipped_first', 'shipped_last')} AND deleted = '0'")}) AS w
  USING (waybill_no)
LEFT JOIN {hub("04", "sending_first", "ASC", "mh_sending")} AS f USING (bag_no, vehicle_tag_no, waybill_no)
LEFT JOIN {hub("05", "first", "DESC", "mh_arrival")} AS a USING (bag_no, vehicle_tag_no, waybill_no)"""


def cargo_base() -> str:
    return f"{with_tables(*_CARGO_TABLES)} " + typed(
        _cargo_base(), ["shipping_time", "record_time"], [*AMOUNTS, "system_weight", "system_sf"]
    )


_SHEET = "strptime(report_date, '%m/%d/%Y')::DATE AS report_date"
_SHEET_NUMBERS = ["smu_weight", "total_smu_fee"]


def _hubs(sending: str, arrival: str) -> str:
    def hub(code: str) -> str:
        return (
            f"CASE {code} WHEN 'CGK' THEN 'MH JAKARTA' "
            f"ELSE (SELECT min(mh_name) FROM a_mh_facility_name_rnd h WHERE h.mh_code = {code}) END"
        )

    return f"""
SELECT * REPLACE ({_SHEET}), bm_code || ' - ' || vm_code AS bm_vm_gsheet, {hub("origin")} AS {sending},
  {hub("destination_by_issued")} AS {arrival} FROM smu_template_2"""


def cargo_hubs() -> str:
    return f"{with_tables(*_CARGO_TABLES)} " + typed(
        _hubs("mh_sending_join", "mh_arrival_join"), ["report_date"], _SHEET_NUMBERS, ["no_of_packages"]
    )


def cargo_bags() -> str:
    sums = ", ".join(f"sum({c}) AS {c}" for c in [*AMOUNTS, "system_sf", "system_weight"])
    body = f"""
SELECT * FROM ({_hubs("mh_sending", "mh_arrival")}) AS g
LEFT JOIN (SELECT bag_no, vehicle_tag_no, bm_vm_concat, {sums} FROM ({_cargo_base()}) AS b GROUP BY 1, 2, 3) AS q
  ON q.bm_vm_concat = g.bm_vm_gsheet"""
    return f"{with_tables(*_CARGO_TABLES)} " + typed(
        body,
        ["report_date"],
        [*_SHEET_NUMBERS, *AMOUNTS, "system_sf", "system_weight"],
        ["no_of_packages"],
    )


def cargo_parcels() -> str:
    renamed = {
        "sender_province_name": "origin_province",
        "sender_city_name": "origin_city",
        "sender_district_name": "origin_district",
        "recipient_province_name": "destination_province",
        "recipient_city_name": "destination_city",
        "recipient_district_name": "destination_district",
    }
    places = ", ".join(f"{c} AS {renamed.get(c, c)}" for c in PLACES)
    body = f"""
SELECT g.*, q.* FROM (SELECT * REPLACE ({_SHEET}), bm_code || ' - ' || vm_code AS bm_vm_gsheet FROM smu_template_2) AS g
LEFT JOIN (
  SELECT bag_no, vehicle_tag_no, bm_vm_concat, waybill_no, shipping_time, express_type, record_time,
    {", ".join(AMOUNTS)}, system_sf, system_weight, {places}, CAST(NULL AS VARCHAR) AS return_flag,
    CAST(NULL AS VARCHAR) AS return_pod_branch_name, CAST(NULL AS VARCHAR) AS pod_or_return_pod_branch
  FROM ({_cargo_base()}) AS b
) AS q ON q.bm_vm_concat = g.bm_vm_gsheet"""
    return f"{with_tables(*_CARGO_TABLES)} " + typed(
        body,
        ["report_date", "shipping_time", "record_time"],
        [*_SHEET_NUMBERS, *AMOUNTS, "system_sf", "system_weight"],
        ["no_of_packages"],
    )


def category(reason: str) -> str:
    customs = " OR ".join(f"contains({reason}, {quoted(part)})" for part in reasons.CUSTOMS_PARTS)
    return (
        f"CASE WHEN {customs} THEN {quoted(reasons.CUSTOMS_CATEGORY)} "
        f"{classes(reason, reasons.PROBLEM_CATEGORIES)} END"
    )


def merged(outputs: Mapping[str, object]) -> str:
    """Select list of a full merge `o` / `w` from the policy of the plan."""
    parts = []
    for out, pick in outputs.items():
        left, right = f"o.{pick.left}", f"w.{pick.right}"
        if pick.switch:
            value = f"CASE WHEN o.{pick.switch} IS NULL THEN {left} ELSE {right} END"
        elif pick.left and pick.right:
            value = f"coalesce({left}, {right})"
        else:
            value = left if pick.left else right
        parts.append(f"{value} AS {out}")
    return ", ".join(parts)


def _generic_sla(late_when_open: str) -> str:
    waiting = "<=" if late_when_open == ">" else ">"
    return f"""CASE WHEN service_type = 'Pick up' THEN CASE WHEN pickup_time <= end_pickup_time THEN 'On Time'
    WHEN pickup_time > end_pickup_time THEN 'Late'
    WHEN pickup_time IS NULL AND end_pickup_time {late_when_open} {TODAY} THEN 'Late'
    WHEN pickup_time IS NULL AND end_pickup_time {waiting} {TODAY} THEN 'Not Pick up Yet' END END"""


_PICKUP_DAYS = f"""CASE WHEN pickup_time IS NOT NULL THEN {ldate("pickup_time")}
    - {ldate("CASE WHEN start_pickup_time IS NULL THEN input_time ELSE start_pickup_time END")} END"""


def _pickup_rate(same_day: str) -> str:
    return f"""CASE WHEN durasi_pickup < 0 THEN 'Early Pickup' WHEN durasi_pickup > 2 THEN 'H2+'
    WHEN durasi_pickup = 0 THEN '{same_day}' WHEN durasi_pickup IN (1, 2) THEN 'H+' || durasi_pickup END"""


_PICKUP_STATUS = """CASE WHEN order_status IN ('Cancel Order', 'Picked Up') THEN order_status
    WHEN order_status IS NOT NULL THEN 'Not Picked Up' END"""
_FAILURE = """(SELECT register_reason_bahasa FROM res_problem_package r
    WHERE r.code = pickup_failure_problem_code AND r.deleted = '0')"""


def _walls(*names: str) -> str:
    return ", ".join(f"{local(n)} AS {n}" for n in names)


def daily() -> str:
    excused = among("pickup_failure_reason", [*reasons.SENDER_PICKUP_REASONS, reasons.CANCELLED_BEFORE_PICKUP])
    order_times = ["input_time", "start_pickup_time", "end_pickup_time", "pickup_failure_time", "pickup_time"]
    order_side = f"""
SELECT *, CASE WHEN sla_pickup_status = 'Late' AND (pickup_failure_time < end_pickup_time
      OR (order_source <> 'Tokopedia' AND {excused})) THEN 'Adjusted' ELSE sla_pickup_status
  END AS adjusted_performance_pickup
FROM (SELECT *, {_generic_sla(">")} AS sla_pickup_status, {_pickup_rate("H0")} AS pickup_rate,
    {_PICKUP_STATUS} AS pickup_status
  FROM (SELECT * REPLACE ({_walls(*order_times)},
      {label("orderSource", "order_source")} AS order_source, {label("orderStatus", "order_status")} AS order_status,
      {label("paymentType", "payment_type")} AS payment_type, {label("expressType", "express_type")} AS express_type,
      {label("serviceType", "service_type")} AS service_type),
      {_PICKUP_DAYS} AS durasi_pickup, {_FAILURE} AS pickup_failure_reason,
      {region("sender_province_name")} AS kanwil_asal, {region("recipient_province_name")} AS kanwil_tujuan
    FROM ({newest("order_order", recent("input_time", 93), "input_time", ["update_time", "order_no"])}) AS x) AS y) AS z"""
    lead = f"{ldate('x.pod_record_time')} - {ldate('x.shipping_time')}"
    days = "CAST(CASE WHEN regexp_full_match(c.sla, '[0-9]+') THEN c.sla END AS BIGINT)"
    waybill_side = f"""
SELECT x.* EXCLUDE (return_pod_record_time) REPLACE (
    {label("waybillStatus", "x.waybill_status")} AS waybill_status,
    {label("waybillSource", "x.waybill_source")} AS waybill_source,
    {label("serviceType", "x.service_type")} AS service_type, {label("expressType", "x.express_type")} AS express_type,
    {label("paymentType", "x.payment_type")} AS payment_type,
    {label("relation", "x.relationship_type")} AS relationship_type,
    CAST(x.item_value AS DECIMAL(38,9)) AS item_value,
    {local("x.shipping_time")} AS shipping_time, {local("x.pod_record_time")} AS pod_record_time),
  {label("returnFlag", "x.return_flag")} AS return_status, {label("voidFlag", "x.void_flag")} AS void_status,
  {label("returnConfirmStatus", "r.return_confirm_status")} AS return_confirm_status,
  CASE WHEN x.cod_amount > 0 THEN 'COD' ELSE 'Non COD' END AS cod_type,
  {ldate("x.shipping_time")} + CAST({days} AS INT) AS sla_est_deadline, {lead} AS lead_time_deliv,
  CASE WHEN {lead} <= {days} THEN 'Hit SLA' WHEN {lead} > {days} THEN 'Not Hit' END AS sla_status_deliv,
  (SELECT return_type FROM return_type y WHERE y.id = r.return_type_id) AS return_reason,
  {local("r.return_confirm_record_time")} AS return_confirm_record_time,
  {local("r.return_pod_record_time")} AS return_pod_record_time, r.return_shipping_fee, r.return_pod_photo_url,
  {island("r.recipient_city_name", "r.recipient_province_name")} AS return_area,
  {island("x.sender_city_name", "x.sender_province_name")} AS shipment_area,
  {island("x.recipient_city_name", "x.recipient_province_name")} AS area_tujuan,
  {region("x.sender_province_name")} AS kanwil_asal, {region("x.recipient_province_name")} AS kanwil_tujuan
FROM ({newest_waybill(f"{recent('shipping_time', 93)} AND {recent('update_time', 93)}")}) AS x
LEFT JOIN ({newest_return(recent("update_time", 93))}) AS r ON r.waybill_no = x.waybill_no
LEFT JOIN masterdata_sla_shopee c ON c.origin_city = x.sender_city_name AND c.destination_city = x.recipient_city_name"""
    ctes = f"""
o AS ({order_side}), w AS ({waybill_side}),
a AS (SELECT {merged(REPORT_POLICY)} FROM o FULL JOIN w ON o.waybill_no = w.waybill_no),
scans AS (SELECT *, {label("operationType", "operation_type")} AS activity FROM waybill_waybill_line
  WHERE {recent("record_time", 93)}),
attempts AS (SELECT waybill_no, min({local("record_time")}) AS first_deliv_attempt,
    max({local("record_time")}) AS last_deliv_attempt, count(activity) AS tries
  FROM scans WHERE operation_type = '09' GROUP BY 1),
place AS (SELECT waybill_no, max(record_time) AS newest FROM scans GROUP BY 1),
last_place AS (SELECT s.waybill_no, {local("max(newest)")} AS last_scan_time, max(operation_branch_name) AS last_location,
    max(activity) AS last_activity
  FROM scans s JOIN place p ON p.waybill_no = s.waybill_no AND p.newest = s.record_time GROUP BY 1),
problem_counts AS (SELECT waybill_no, count(register_reason_bahasa) AS problems FROM scans
  LEFT JOIN res_problem_package r ON r.code = problem_code AND r.deleted = '0' WHERE operation_type = '18' GROUP BY 1),
pairs AS (
  SELECT p.waybill_no, p.operation_time AS pt, s.record_time AS st,
    min(p.problem_reason) OVER up AS first_reason, min(p.operation_time) OVER up AS first_at,
    max(p.problem_reason) OVER down AS last_reason, max(p.operation_time) OVER down AS last_at,
    max({label("problemType", "p.problem_type")}) OVER down AS last_type,
    min(s.operation_branch_name) OVER s_up AS first_branch, min(s.photo_url) OVER s_up AS first_photo,
    max(s.photo_url) OVER s_down AS last_photo
  FROM waybill_problem_piece p
  LEFT JOIN (SELECT * FROM scans WHERE operation_type = '18' AND problem_type <> '02') AS s
    ON s.waybill_no = p.waybill_no
  WHERE {recent("p.operation_time", 93)} AND p.problem_type <> '02'
  WINDOW up AS (PARTITION BY p.waybill_no ORDER BY p.operation_time),
    down AS (PARTITION BY p.waybill_no ORDER BY p.operation_time DESC),
    s_up AS (PARTITION BY s.waybill_no ORDER BY s.record_time),
    s_down AS (PARTITION BY s.waybill_no ORDER BY s.record_time DESC)
),
first_problem AS (SELECT DISTINCT ON (waybill_no) * FROM pairs ORDER BY waybill_no, st ASC NULLS FIRST, pt ASC),
last_problem AS (SELECT DISTINCT ON (waybill_no) * FROM pairs ORDER BY waybill_no, st DESC NULLS LAST, pt DESC),
report AS (
  SELECT a.*, b.first_deliv_attempt, b.last_deliv_attempt, coalesce(b.tries, 0) AS count_deliv_attempt,
    l.last_scan_time, l.last_location, l.last_activity, coalesce(n.problems, 0) AS count_pos,
    f.first_reason AS first_pos_reason, {local("f.first_at")} AS first_pos_attempt,
    f.first_branch AS first_pos_location, f.first_photo AS first_pos_photo_url, e.last_reason AS last_pos_reason,
    {local("e.last_at")} AS last_pos_attempt, e.last_type AS last_pos_type, e.last_photo AS last_pos_photo_url,
    CASE WHEN {among("e.last_reason", [*reasons.DAMAGED, *reasons.LOST, *reasons.MIXED_UP, *reasons.MISROUTED])}
      THEN e.last_reason END AS deliv_problem_agg,
    {category("e.last_reason")} AS last_pos_category,
    CASE WHEN a.void_status = 'Void' OR a.order_status = 'Cancel Order' OR a.waybill_status IS NULL THEN 'Cancel Order'
      WHEN a.waybill_status = 'Signed' OR a.pod_record_time IS NOT NULL THEN 'Delivered'
      WHEN a.waybill_status = 'Return Received' OR a.return_pod_record_time IS NOT NULL THEN 'Returned'
      WHEN a.return_confirm_record_time IS NOT NULL AND a.return_status = 'Retur' THEN 'Return Process'
      WHEN {among("e.last_reason", [*reasons.LOST, *reasons.DAMAGED])} OR contains(e.last_reason, 'bea cukai')
        OR contains(e.last_reason, 'Rejected by customs') THEN 'Undelivered'
      ELSE 'Delivery Process' END AS last_status
  FROM a
  LEFT JOIN attempts b ON b.waybill_no = a.waybill_no
  LEFT JOIN last_place l ON l.waybill_no = a.waybill_no
  LEFT JOIN problem_counts n ON n.waybill_no = a.waybill_no
  LEFT JOIN first_problem f ON f.waybill_no = a.waybill_no
  LEFT JOIN last_problem e ON e.waybill_no = a.waybill_no
)"""
    outputs = ", ".join(f"{c} AS {out}" for out, c in REPORT_OUTPUTS.items())
    names = with_tables(
        "order_order",
        "waybill_waybill",
        "waybill_return_bill",
        "waybill_waybill_line",
        "waybill_problem_piece",
        "system_option",
        "mapping_kanwil_area",
        "masterdata_city_mapping_area_island_new",
        "masterdata_sla_shopee",
        "res_problem_package",
        "return_type",
    )
    numbers = [out for out, c in REPORT_OUTPUTS.items() if c.endswith(("_oo", "_ww"))]
    return f"{names}, {ctes} " + typed(
        f"SELECT {outputs} FROM report",
        [
            "waktu_input",
            "pickup_time",
            "last_scan_time",
            "first_deliv_attempt",
            "last_deliv_attempt",
            "waktu_perekaman_pod",
            "return_pod_record_time",
            "first_pos_attempt",
            "last_pos_attempt",
            "pickup_failure_time",
            "sla_est_deadline",
        ],
        [*numbers, "item_value", "cod_amount", "return_shipping_fee"],
        ["count_deliv_attempt", "count_pos", "durasi_pickup", "lead_time_deliv"],
    )


def seller(username: str | None) -> str:
    three = among("order_source", pickup.MARKETPLACES)

    def day_sla(base: str, past: str, waiting: str = "Not Picked Up", cancelled: bool = True) -> str:
        due = f"(CAST({base} AS DATE) + {past})"
        cancel = "WHEN pickup_time IS NULL AND order_status = 'Cancel Order' THEN 'Cancel Order'" if cancelled else ""
        return f"""CASE {cancel} WHEN CAST(pickup_time AS DATE) <= {due} THEN 'On Time'
      WHEN CAST(coalesce(pickup_time, {TODAY}) AS DATE) > {due} THEN 'Late'
      WHEN pickup_time IS NULL AND {TODAY} <= {due} THEN '{waiting}' END"""

    fourteen = among("pickup_failure_reason", reasons.SENDER_PICKUP_REASONS)
    fifteen = among("pickup_failure_reason", [*reasons.SENDER_PICKUP_REASONS, reasons.CANCELLED_BEFORE_PICKUP])
    order_times = ["input_time", "start_pickup_time", "end_pickup_time", "pickup_failure_time", "pickup_time"]

    def owner(column: str) -> str:
        return f"""CASE WHEN order_source = 'VIP Customer Portal'
      THEN (SELECT {column} FROM masterdata_sales_seller_vip v WHERE v.seller_name = vip_customer_name)
      ELSE (SELECT {column} FROM masterdata_sales_source v WHERE v.source = order_source) END"""

    order_side = f"""
SELECT *, CASE WHEN pickup_performance_everpro = 'Late' AND (
      (order_source = 'Tokopedia' AND pickup_failure_time <= end_pickup_time AND {fourteen})
      OR (order_source <> 'Tokopedia' AND {fifteen})) THEN 'Adjusted' ELSE pickup_performance_everpro
    END AS adjusted_performance_everpro
FROM (SELECT *, CASE WHEN (sla_pickup_shopee IS NOT NULL)::INT + (sla_pickup_blibli_by_input_time IS NOT NULL)::INT
      + (sla_pickup_soscom IS NOT NULL)::INT + (sla_pickup_tokped IS NOT NULL)::INT = 1
    THEN coalesce(sla_pickup_shopee, sla_pickup_blibli_by_input_time, sla_pickup_soscom, sla_pickup_tokped)
    END AS pickup_performance_everpro
  FROM (SELECT *, {_generic_sla("<")} AS pickup_performance,
    CASE WHEN order_source = 'Blibli' THEN CASE order_past_1400 WHEN 1 THEN 'NextDay Pickup' ELSE 'SameDay Pickup' END
      WHEN NOT {three} THEN CASE order_past_1500 WHEN 1 THEN 'NextDay Pickup' ELSE 'SameDay Pickup' END
      END AS pickup_category_everpro,
    CASE WHEN order_source = 'Shopee platform' AND order_status <> 'Cancel Order'
      THEN {day_sla("start_pickup_time", "1", "Not Pick Up Yet", False)} END AS sla_pickup_shopee,
    CASE WHEN order_source = 'Tokopedia' AND order_status <> 'Cancel Order' THEN
      CASE WHEN pickup_time <= end_pickup_time THEN 'On Time' WHEN pickup_time > end_pickup_time THEN 'Late'
        WHEN pickup_time IS NULL AND start_pickup_time >= {TODAY} THEN 'Not Pick Up Yet'
        WHEN pickup_time IS NULL AND start_pickup_time < {TODAY} THEN 'Late' END END AS sla_pickup_tokped,
    CASE WHEN order_source = 'Blibli' THEN {day_sla("start_pickup_time", "order_past_1400")} END AS sla_pickup_blibli,
    CASE WHEN order_source = 'Blibli' THEN {day_sla("input_time", "order_past_1400")} END
      AS sla_pickup_blibli_by_input_time,
    CASE WHEN NOT {three} THEN {day_sla("input_time", "order_past_1500")} END AS sla_pickup_soscom,
    {_pickup_rate("H+0")} AS pickup_rate, {_PICKUP_STATUS} AS pickup_status,
    CASE WHEN order_status = 'Picked Up' THEN 'Picked Up' ELSE 'Failed Pickup' END AS fm_performance,
    CASE {classes("pickup_failure_reason", reasons.PICKUP_FACTORS)} WHEN pickup_failure_reason IS NULL THEN 'IDE' END
      AS late_pickup_factor,
    CASE {classes("pickup_failure_reason", reasons.PICKUP_CONTROL)}
      WHEN pickup_failure_reason IS NULL THEN 'Controllable' END AS late_pickup_category
  FROM (SELECT *, {owner("division")} AS division, {owner("sales_name")} AS sales_name
  FROM (SELECT * REPLACE ({_walls(*order_times)}, {label("orderSource", "order_source")} AS order_source,
      {label("orderStatus", "order_status")} AS order_status, {label("serviceType", "service_type")} AS service_type),
      {local("update_time")} AS update_time_oo, {_PICKUP_DAYS} AS durasi_pickup, {_FAILURE} AS pickup_failure_reason,
      (CAST({local("input_time")} AS TIME) >= TIME '14:00:00')::INT AS order_past_1400,
      (CAST({local("input_time")} AS TIME) >= TIME '15:00:00')::INT AS order_past_1500,
      {region("sender_province_name")} AS kanwil_area_pickup, {region("recipient_province_name")} AS kanwil_area_deliv,
      {island("sender_city_name", "sender_province_name")} AS origin_area,
      {island("recipient_city_name", "recipient_province_name")} AS destination_area
    FROM ({newest("order_order", recent("input_time", 186), "update_time", ["input_time", "order_no"])}) AS x
  ) AS decoded) AS owned) AS rated) AS chosen"""
    days = "CAST(CASE WHEN regexp_full_match(c.sla, '[0-9]+') THEN c.sla END AS BIGINT)"
    waybill_side = f"""
SELECT *, CASE WHEN lead_time_deliv < 1 THEN '0 Hari' WHEN lead_time_deliv < 2 THEN '1 Hari'
    WHEN lead_time_deliv < 4 THEN '2-3 Hari' WHEN lead_time_deliv < 6 THEN '4-5 Hari'
    WHEN lead_time_deliv < 8 THEN '6-7 Hari' WHEN lead_time_deliv >= 8 THEN '7 Hari+' END AS lead_time_category,
  CASE WHEN lead_time_deliv <= sla_delivery THEN 'Hit SLA' WHEN lead_time_deliv > sla_delivery THEN 'Not Hit'
    END AS sla_status,
  CASE WHEN order_source IS NULL THEN NULL WHEN sla_delivery >= 999 THEN 'No SLA (OoC)'
    WHEN sla_delivery IS NULL AND NOT priced THEN 'Hit SLA'
    WHEN coalesce(pod_day, {TODAY}) > utc_due THEN 'Not Hit' WHEN pod_day <= utc_due THEN 'Hit SLA'
    END AS sla_performance,
  CASE WHEN priced THEN utc_due ELSE shipped_day + CAST(city_days AS INT) END AS sla_est_deadline
FROM (
  SELECT *, CASE WHEN priced THEN price_days ELSE city_days END AS sla_delivery, pod_day - shipped_day AS lead_time_deliv,
    CAST(shipped_utc AS DATE) + CAST(CASE WHEN priced THEN price_days ELSE city_days END AS INT) AS utc_due
  FROM (
    SELECT x.* EXCLUDE (return_pod_record_time) REPLACE (
        {label("waybillStatus", "x.waybill_status")} AS waybill_status,
        {local("x.shipping_time")} AS shipping_time, {local("x.pod_record_time")} AS pod_record_time),
      {label("waybillSource", "x.waybill_source")} AS order_source,
      coalesce({among(label("waybillSource", "x.waybill_source"), delivery.PRICE_LIST_SOURCES)}, false) AS priced,
      p.max_sla AS price_days, {days} AS city_days, x.shipping_time AS shipped_utc,
      {ldate("x.shipping_time")} AS shipped_day, {ldate("x.pod_record_time")} AS pod_day,
      {local("x.update_time")} AS update_time_ww, {label("voidFlag", "x.void_flag")} AS void_status,
      {label("returnFlag", "x.return_flag")} AS return_status,
      {label("returnConfirmStatus", "r.return_confirm_status")} AS return_confirm_status,
      CASE WHEN x.cod_amount > 0 THEN 'COD' WHEN x.cod_amount = 0 THEN 'Non COD' END AS cod_type,
      {region("x.sender_province_name")} AS kanwil_area_pickup,
      {region("x.recipient_province_name")} AS kanwil_area_deliv,
      {island("x.sender_city_name", "x.sender_province_name")} AS origin_area,
      {island("x.recipient_city_name", "x.recipient_province_name")} AS destination_area,
      {island("r.recipient_city_name", "r.recipient_province_name")} AS return_area,
      (SELECT return_type FROM return_type y WHERE y.id = r.return_type_id) AS remark_return, r.return_branch_name,
      r.return_pod_photo_url, {local("r.return_record_time")} AS return_record_time,
      {local("r.return_confirm_record_time")} AS return_confirm_record_time,
      {local("r.return_pod_record_time")} AS return_pod_record_time
    FROM ({newest_waybill(f"{recent('shipping_time', 186)} AND {recent('update_time', 186)}")}) AS x
    LEFT JOIN ({newest_return(f"deleted = '0' AND {recent('update_time', 186)}")}) AS r ON r.waybill_no = x.waybill_no
    LEFT JOIN masterdata_sla_shopee c
      ON c.origin_city = x.sender_city_name AND c.destination_city = x.recipient_city_name
    LEFT JOIN prices p ON p.shipping_client_id = x.vip_customer_id AND p.sender_location_id = x.sender_city_id
      AND p.recipient_location_id = x.recipient_district_id AND p.express_type = x.express_type
  ) AS decoded
) AS timed"""
    who = "" if username is None else f"AND m.vip_username = '{username}'"
    closed = """WHEN m.order_status = 'Cancel Order' OR m.void_status = 'Void' THEN 'Cancel Order'
      WHEN m.waybill_status IS NULL THEN 'Not Picked Up'
      WHEN m.waybill_status = 'Signed' OR m.pod_record_time IS NOT NULL THEN 'Delivered'
      WHEN m.waybill_status = 'Return Received' OR m.return_pod_record_time IS NOT NULL THEN 'Returned'"""
    ctes = f"""
prices AS (
  SELECT DISTINCT ON (shipping_client_id, sender_location_id, recipient_location_id, express_type) * FROM (
    SELECT DISTINCT ON (search_code) * FROM standard_shipping_fee
    WHERE deleted = '0' AND {ldate("end_expire_time")} > {TODAY}
    ORDER BY search_code, created_at DESC, max_sla DESC NULLS LAST) AS valid
  ORDER BY shipping_client_id, sender_location_id, recipient_location_id, express_type, created_at DESC,
    max_sla DESC NULLS LAST, search_code DESC
),
o AS ({order_side}), w AS ({waybill_side}),
m AS (SELECT {merged(SELLER_POLICY)} FROM o FULL JOIN w ON o.waybill_no = w.waybill_no),
problem AS (
  SELECT *, CASE WHEN reason IS NULL THEN (SELECT min(late_delivery_reason) FROM mitra_late_reason_delivery d
      WHERE d.waybill_no = p.waybill_no)
    WHEN {among("reason", reasons.NOT_A_DELIVERY_PROBLEM)} THEN NULL ELSE reason END AS late_reason
  FROM (
    SELECT a.waybill_no, {local("max(a.operation_time)")} AS recording_time_pos, max(a.problem_reason) AS reason,
      max({label("problemType", "a.problem_type")}) AS problem_type
    FROM waybill_problem_piece a
    JOIN (SELECT waybill_no, max(operation_time) AS operation_time FROM waybill_problem_piece
          WHERE problem_type <> '02' AND {recent("operation_time", 186)} GROUP BY 1) AS newest_one
      USING (waybill_no, operation_time)
    WHERE a.problem_type <> '02' GROUP BY 1
  ) AS p
),
report AS (
  SELECT m.*, b.recording_time_pos, b.late_reason, b.problem_type, n.count_pos,
    CASE {classes("b.late_reason", reasons.NARROW_CATEGORIES)}
      WHEN {among("m.recipient_province_name", reasons.HARD_TO_REACH_PROVINCES)} AND m.cod_amount > 0 THEN 'Uncoverage'
      END AS problem_delivery_category,
    CASE WHEN b.waybill_no IS NOT NULL THEN {category("b.late_reason")} END AS problem_delivery_category_2,
    CASE WHEN b.problem_type <> 'Percobaan pengambilan terkendala' THEN b.late_reason END
      AS problem_delivery_category_oms_2,
    CASE WHEN b.waybill_no IS NOT NULL THEN CASE {classes("b.late_reason", reasons.DELIVERY_FACTORS)}
      WHEN b.late_reason IS NULL THEN 'IDE' END END AS late_delivery_factor,
    CASE WHEN b.waybill_no IS NOT NULL THEN CASE {classes("b.late_reason", reasons.DELIVERY_CONTROL)}
      WHEN b.late_reason IS NULL THEN 'Controllable' END END AS late_delivery_category,
    CASE {closed}
      WHEN contains(m.waybill_status, 'bea cukai') OR contains(b.late_reason, 'Rejected by customs')
        OR {among("b.late_reason", [*reasons.DAMAGED, *reasons.LOST])} THEN 'Undelivered'
      WHEN m.return_confirm_record_time IS NOT NULL THEN 'Return Process' ELSE 'Delivery Process' END AS last_status,
    CASE {closed}
      WHEN m.return_confirm_record_time IS NOT NULL THEN 'Return Process'
      WHEN contains(b.late_reason, 'bea cukai') OR contains(b.late_reason, 'Rejected by customs')
        THEN 'Paket ditolak bea cukai (red line)'
      {classes("b.late_reason", reasons.NARROW_CATEGORIES)} ELSE 'Over SLA' END AS final_status
  FROM m
  LEFT JOIN problem b ON b.waybill_no = m.waybill_no
  LEFT JOIN (SELECT waybill_no, count(*) AS count_pos FROM waybill_waybill_line
    WHERE operation_type = '18' AND {recent("record_time", 186)} GROUP BY 1) AS n ON n.waybill_no = m.waybill_no
  WHERE m.order_source = 'VIP Customer Portal' {who}
)"""
    names = with_tables(
        "order_order",
        "waybill_waybill",
        "waybill_return_bill",
        "waybill_waybill_line",
        "waybill_problem_piece",
        "system_option",
        "mapping_kanwil_area",
        "masterdata_city_mapping_area_island_new",
        "masterdata_sla_shopee",
        "masterdata_sales_source",
        "masterdata_sales_seller_vip",
        "res_problem_package",
        "return_type",
        "standard_shipping_fee",
        "mitra_late_reason_delivery",
    )
    return f"{names}, {ctes} " + typed(
        f"SELECT {', '.join(SELLER_OUTPUTS)} FROM report",
        [
            "input_time",
            "start_pickup_time",
            "end_pickup_time",
            "pickup_failure_time",
            "pickup_time",
            "update_time_oo",
            "update_time_ww",
            "sla_est_deadline",
            "pod_record_time",
            "return_record_time",
            "return_confirm_record_time",
            "return_pod_record_time",
            "recording_time_pos",
        ],
        ["cod_amount"],
        ["durasi_pickup", "order_past_1400", "order_past_1500", "sla_delivery", "lead_time_deliv", "count_pos"],
    )
