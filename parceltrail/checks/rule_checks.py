"""Checks of scalar functions and business rules.

Inputs are built from whole test tables by SQL that both engines run (`{name}` stands for a table).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.checks import domain, mart_sql
from parceltrail.checks.registry import Registry, Source
from parceltrail.functions import clock, courier, delivery, pickup, reasons, status, values
from parceltrail.functions.rules import buckets
from parceltrail.operators.lookup import lookup
from parceltrail.plans.seller_performance import current_prices

registry = Registry()
check = registry.check

TODAY = date(1998, 6, 1)
_TODAY = f"DATE '{TODAY}'"


def _shared(s: Source, sql: str) -> DataFrame:
    names = ["orders", "lineitem", "customer", "supplier", "nation", "events", "part"]
    return s.rows(sql, **{n: getattr(s, n) for n in names if "{" + n + "}" in sql})


def _cte(sql: str) -> str:
    return sql.replace("{", "").replace("}", "")


@check("""
SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS VARCHAR) AS wall, CAST(CAST(ts + INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS day,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS utc_day, strftime(ts + INTERVAL 7 HOUR, '%H:%M:%S') AS wall_time FROM events""")
def local_time_parts(s: Source) -> DataFrame:
    return s.events.select(
        "event_id",
        clock.local_dt("ts").alias("wall"),
        clock.local_date("ts").alias("day"),
        clock.date_of("ts").alias("utc_day"),
        clock.local_time_text("ts").alias("wall_time"),
    )


@check("""
SELECT event_id, (CAST(ts + INTERVAL 7 HOUR AS TIME) >= TIME '14:00:00')::BIGINT AS past_1400,
  (CAST(ts + INTERVAL 7 HOUR AS TIME) >= TIME '15:00:00')::BIGINT AS past_1500 FROM events""")
def cutoff_flags(s: Source) -> DataFrame:
    return s.events.select(
        "event_id",
        clock.past_cutoff("ts", "14:00:00").alias("past_1400"),
        clock.past_cutoff("ts", "15:00:00").alias("past_1500"),
    )


@check("SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%b %Y') AS month FROM events")
def month_label(s: Source) -> DataFrame:
    return s.events.select("event_id", clock.month_label(clock.local_date("ts")).alias("month"))


@check("""
SELECT event_id, date_diff('day', previous, ts) AS days, date_diff('hour', previous, ts) AS hours,
  date_diff('second', previous, ts) AS seconds
FROM (SELECT *, first_value(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events) AS t""")
def boundary_differences(s: Source) -> DataFrame:
    started = s.events.groupBy("user_id").agg(F.min("ts").alias("started"))
    rows = s.events.join(started, "user_id")
    return rows.select(
        "event_id",
        clock.days_between("ts", "started").alias("days"),
        clock.hours_crossed("ts", "started").alias("hours"),
        clock.seconds_crossed("ts", "started").alias("seconds"),
    )


_TEXTS = """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN p_name
  WHEN 2 THEN CAST(p_size AS STRING) || '.5' WHEN 3 THEN CAST(p_size AS STRING) || ' hari' END AS text FROM {part}"""


@check(f"""
SELECT p_partkey, CAST(CASE WHEN regexp_full_match(text, '[0-9]+') THEN text END AS BIGINT) AS number
FROM ({_cte(_TEXTS)}) AS t""")
def safe_int(s: Source) -> DataFrame:
    return _shared(s, _TEXTS).select("p_partkey", values.safe_int(F.col("text")).alias("number"))


@check("""
SELECT p_partkey, round(CAST(CAST(p_size || '.25' AS DECIMAL(38,9)) AS DOUBLE), 4) AS weight FROM part""")
def numeric_cast(s: Source) -> DataFrame:
    text = F.concat(F.col("p_size").cast("string"), F.lit(".25"))
    return s.part.select("p_partkey", values.numeric(text).alias("weight"))


@check("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def format_date_parse(s: Source) -> DataFrame:
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    return s.orders.select("o_orderkey", clock.sheet_date(text).alias("day"))


_ORDERS = """
SELECT o_orderkey AS k, o_custkey % 2 AS past,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Shopee platform' WHEN '2-HIGH' THEN 'Tokopedia' WHEN '3-MEDIUM' THEN 'Blibli'
    WHEN '4-NOT SPECIFIED' THEN 'VIP Customer Portal' END AS source,
  CASE o_orderstatus WHEN 'F' THEN 'Cancel Order' WHEN 'O' THEN 'Picked Up' ELSE 'Pending' END AS order_status,
  o_orderdate AS placed, CASE WHEN o_custkey % 9 <> 0 THEN o_orderdate + INTERVAL '1' DAY END AS starting,
  o_orderdate + INTERVAL '3' DAY AS ending,
  CASE WHEN least_quantity < 30
    THEN o_orderdate + INTERVAL '1' HOUR * (CAST(least_quantity AS BIGINT) * 6 - 24) END AS picked,
  o_orderdate + INTERVAL '1' HOUR * (o_custkey % 100) AS failed,
  CASE o_custkey % 3 WHEN 0 THEN 'Pick up' ELSE 'Drop off' END AS service
FROM {orders} LEFT JOIN (
  SELECT l_orderkey, min(l_quantity) AS least_quantity FROM {lineitem} GROUP BY l_orderkey) AS q ON l_orderkey = o_orderkey"""


def _orders(s: Source) -> DataFrame:
    return _shared(s, _ORDERS)


@check(f"""
SELECT k, CASE WHEN service = 'Pick up' THEN CASE WHEN picked <= ending THEN 'On Time' WHEN picked > ending THEN 'Late'
    WHEN ending < {_TODAY} THEN 'Late' WHEN ending >= {_TODAY} THEN 'Not Pick up Yet' END END AS sane,
  CASE WHEN service = 'Pick up' THEN CASE WHEN picked <= ending THEN 'On Time' WHEN picked > ending THEN 'Late'
    WHEN ending > {_TODAY} THEN 'Late' WHEN ending <= {_TODAY} THEN 'Not Pick up Yet' END END AS inverted
FROM ({_cte(_ORDERS)}) AS o""")
def pickup_sla(s: Source) -> DataFrame:
    service, picked, ending = F.col("service"), F.col("picked"), F.col("ending")
    return _orders(s).select(
        "k",
        pickup.generic_sla(service, picked, ending, TODAY).alias("sane"),
        pickup.generic_sla(service, picked, ending, TODAY, inverted=True).alias("inverted"),
    )


def _day_rule(due: str, waiting: str, cancelled: bool) -> str:
    cancel = "WHEN picked IS NULL AND order_status = 'Cancel Order' THEN 'Cancel Order'" if cancelled else ""
    return f"""CASE {cancel} WHEN CAST(picked AS DATE) <= {due} THEN 'On Time'
    WHEN coalesce(CAST(picked AS DATE), {_TODAY}) > {due} THEN 'Late'
    WHEN picked IS NULL AND {_TODAY} <= {due} THEN '{waiting}' END"""


_VARIANTS = f"""
SELECT k, source,
  CASE WHEN source = 'Shopee platform' AND order_status <> 'Cancel Order'
    THEN {_day_rule("CAST(starting AS DATE) + 1", "Not Pick Up Yet", False)} END AS a,
  CASE WHEN source = 'Tokopedia' AND order_status <> 'Cancel Order' THEN
    CASE WHEN picked <= ending THEN 'On Time' WHEN picked > ending THEN 'Late'
      WHEN starting >= {_TODAY} THEN 'Not Pick Up Yet' WHEN starting < {_TODAY} THEN 'Late' END END AS b,
  CASE WHEN source = 'Blibli' THEN {_day_rule("CAST(starting AS DATE) + CAST(past AS INT)", "Not Picked Up", True)} END AS c,
  CASE WHEN source = 'Blibli' THEN {_day_rule("CAST(placed AS DATE) + CAST(past AS INT)", "Not Picked Up", True)} END AS d,
  CASE WHEN source NOT IN ('Shopee platform', 'Tokopedia', 'Blibli')
    THEN {_day_rule("CAST(placed AS DATE) + CAST(past AS INT)", "Not Picked Up", True)} END AS e
FROM ({_cte(_ORDERS)}) AS o"""


def _variants(s: Source) -> DataFrame:
    source, state, picked = F.col("source"), F.col("order_status"), F.col("picked")
    placed, starting, ending, past = F.col("placed"), F.col("starting"), F.col("ending"), F.col("past")
    return _orders(s).withColumns(
        {
            "a": pickup.shopee_sla(source, state, picked, starting, TODAY),
            "b": pickup.tokopedia_sla(source, state, picked, starting, ending, TODAY),
            "c": pickup.blibli_sla(source, state, picked, starting, past, TODAY),
            "d": pickup.blibli_sla(source, state, picked, placed, past, TODAY),
            "e": pickup.other_sla(source, state, picked, placed, past, TODAY),
        }
    )


@check(_VARIANTS)
def pickup_sla_cutoff(s: Source) -> DataFrame:
    return _variants(s).select("k", "source", "a", "b", "c", "d", "e")


@check(f"SELECT k, coalesce(a, b, d, e) AS chosen FROM ({_VARIANTS}) AS v")
def sla_select_one(s: Source) -> DataFrame:
    chosen = pickup.selected_sla(F.col("a"), F.col("d"), F.col("e"), F.col("b"))
    return _variants(s).select("k", chosen.alias("chosen"))


@check("""
SELECT event_id, CASE WHEN (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT = 2 THEN coalesce(a, b, c) END AS only_one
FROM (SELECT event_id, CASE WHEN value < 20 THEN 'low' END AS a, CASE WHEN user_id % 3 = 0 THEN 'third' END AS b,
  CASE WHEN event_type = 'view' THEN 'view' END AS c FROM events) AS t""")
def exactly_one_value(s: Source) -> DataFrame:
    a = F.when(F.col("value") < 20, "low")
    b = F.when(F.col("user_id") % 3 == 0, "third")
    c = F.when(F.col("event_type") == "view", "view")
    return s.events.select("event_id", values.exactly_one(a, b, c).alias("only_one"))


@check(f"""
SELECT k, days, CASE WHEN days < 0 THEN 'Early Pickup' WHEN days > 2 THEN 'H2+' WHEN days = 0 THEN 'H0'
    WHEN days IS NOT NULL THEN 'H+' || days END AS rate,
  CASE WHEN order_status = 'Pending' THEN 'Not Picked Up' ELSE order_status END AS state,
  CASE WHEN order_status = 'Picked Up' THEN 'Picked Up' ELSE 'Failed Pickup' END AS first_mile,
  CASE WHEN source = 'Blibli' OR source = 'VIP Customer Portal'
    THEN CASE past WHEN 1 THEN 'NextDay Pickup' ELSE 'SameDay Pickup' END END AS category
FROM (SELECT *, date_diff('day', CASE WHEN starting IS NULL THEN placed ELSE starting END + INTERVAL 7 HOUR,
  picked + INTERVAL 7 HOUR) AS days FROM ({_cte(_ORDERS)}) AS o) AS t""")
def pickup_rate(s: Source) -> DataFrame:
    days = pickup.pickup_days(F.col("picked"), F.col("starting"), F.col("placed"))
    return _orders(s).select(
        "k",
        days.alias("days"),
        pickup.pickup_rate(days, "H0").alias("rate"),
        pickup.pickup_status(F.col("order_status")).alias("state"),
        pickup.first_mile(F.col("order_status")).alias("first_mile"),
        pickup.pickup_category(F.col("source"), F.col("past"), F.col("past")).alias("category"),
    )


_FAILED = f"""
SELECT k, v, order_source, CASE (k + v) % 3 WHEN 0 THEN 'Late' WHEN 1 THEN 'On Time' END AS sla,
  pickup_failure_time AS failed, end_pickup_time AS ending, reason
FROM order_order LEFT JOIN reason_codes ON code = pickup_failure_problem_code"""
_LATE = f"""{domain.with_tables("order_order", "reason_codes")}, late_orders AS ({_FAILED})"""


@check(f"""{_LATE}
SELECT k, v, CASE WHEN sla = 'Late' AND (failed < ending OR (source <> 'Tokopedia' AND listed_15)) THEN 'Adjusted'
    ELSE sla END AS by_time,
  CASE WHEN sla = 'Late' AND ((source = 'Tokopedia' AND failed <= ending AND listed_14)
    OR (source <> 'Tokopedia' AND listed_15)) THEN 'Adjusted' ELSE sla END AS by_reason
FROM (SELECT *, CASE order_source WHEN '1' THEN 'Tokopedia' WHEN '6' THEN NULL ELSE 'Other' END AS source,
  {mart_sql.among("reason", reasons.SENDER_PICKUP_REASONS)} AS listed_14,
  {mart_sql.among("reason", [*reasons.SENDER_PICKUP_REASONS, reasons.CANCELLED_BEFORE_PICKUP])} AS listed_15
  FROM late_orders) AS t""")
def adjusted_pickup(s: Source) -> DataFrame:
    rows = domain.frames(s.spark, s.sf_dir, ["order_order", "reason_codes"])
    rows = s.rows(
        _FAILED.replace("order_order", "{order_order}").replace("reason_codes", "{reason_codes}"),
        order_order=rows["order_order"],
        reason_codes=rows["reason_codes"],
    )
    code = F.col("order_source")
    source = F.when(code == "1", "Tokopedia").when(code != "6", "Other")
    args = (source, F.col("sla"), F.col("failed"), F.col("ending"), F.col("reason"))
    return rows.select(
        "k",
        "v",
        pickup.adjusted_by_time_or_reason(*args).alias("by_time"),
        pickup.adjusted_by_reason(*args).alias("by_reason"),
    )


_PARCELS = """
SELECT o_orderkey AS k,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Blibli' WHEN '2-HIGH' THEN 'pt fashion eservices indonesia'
    WHEN '3-MEDIUM' THEN 'Walk in' WHEN '4-NOT SPECIFIED' THEN 'Shopee platform' END AS source,
  o_orderdate + INTERVAL '1' HOUR * (o_custkey % 24) AS shipped,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '1' HOUR * (o_custkey % 24 + o_orderkey % 240) END AS delivered,
  CASE o_orderkey % 7 WHEN 0 THEN 999 WHEN 1 THEN NULL ELSE o_orderkey % 8 END AS price_days,
  CASE o_custkey % 7 WHEN 0 THEN '1000' WHEN 1 THEN '3 hari' WHEN 2 THEN NULL ELSE CAST(o_custkey % 8 AS STRING) END AS city_sla,
  CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE o_custkey END AS cod,
  CASE o_orderstatus WHEN 'F' THEN 'Signed' WHEN 'O' THEN 'Delivering' END AS state
FROM {orders}"""


def _parcels(s: Source) -> DataFrame:
    return _shared(s, _PARCELS)


_TIMED = f"""
SELECT *, CASE WHEN priced THEN price_days ELSE city_days END AS days,
  CAST(delivered + INTERVAL 7 HOUR AS DATE) AS done,
  CAST(shipped AS DATE) + CAST(CASE WHEN priced THEN price_days ELSE city_days END AS INT) AS due,
  date_diff('day', shipped + INTERVAL 7 HOUR, delivered + INTERVAL 7 HOUR) AS lead
FROM (SELECT *, coalesce(source IN ('Blibli', 'pt fashion eservices indonesia'), false) AS priced,
  CAST(CASE WHEN regexp_full_match(city_sla, '[0-9]+') THEN city_sla END AS BIGINT) AS city_days
  FROM ({_cte(_PARCELS)}) AS p) AS q"""


@check(f"""
SELECT k, CAST(days AS BIGINT) AS days, CAST(CASE WHEN priced THEN due
    ELSE CAST(shipped + INTERVAL 7 HOUR AS DATE) + CAST(city_days AS INT) END AS VARCHAR) AS deadline
FROM ({_TIMED}) AS t""")
def delivery_sla(s: Source) -> DataFrame:
    city = values.safe_int(F.col("city_sla"))
    return _parcels(s).select(
        "k",
        delivery.sla_days(F.col("source"), F.col("price_days"), city).alias("days"),
        delivery.sla_deadline(F.col("source"), F.col("shipped"), F.col("price_days"), city).alias("deadline"),
    )


@check(f"""
SELECT k, lead, CASE WHEN lead < 1 THEN '0 Hari' WHEN lead < 2 THEN '1 Hari' WHEN lead < 4 THEN '2-3 Hari'
    WHEN lead < 6 THEN '4-5 Hari' WHEN lead < 8 THEN '6-7 Hari' WHEN lead > 7 THEN '7 Hari+' END AS bucket,
  CASE WHEN lead <= days THEN 'Hit SLA' WHEN lead > days THEN 'Not Hit' END AS hit FROM ({_TIMED}) AS t""")
def lead_bucket(s: Source) -> DataFrame:
    lead = F.datediff(clock.local_date("delivered"), clock.local_date("shipped"))
    days = delivery.sla_days(F.col("source"), F.col("price_days"), values.safe_int(F.col("city_sla")))
    return _parcels(s).select(
        "k",
        lead.alias("lead"),
        delivery.lead_bucket(lead).alias("bucket"),
        delivery.sla_hit(lead, days).alias("hit"),
    )


@check(f"""
SELECT k, CASE WHEN source IS NULL THEN NULL WHEN days >= 999 THEN 'No SLA (OoC)'
    WHEN days IS NULL AND NOT priced THEN 'Hit SLA' WHEN coalesce(done, {_TODAY}) > due THEN 'Not Hit'
    WHEN done <= due THEN 'Hit SLA' END AS result FROM ({_TIMED}) AS t""")
def sla_performance(s: Source) -> DataFrame:
    result = delivery.sla_performance(
        F.col("source"),
        F.col("shipped"),
        F.col("delivered"),
        F.col("price_days"),
        values.safe_int(F.col("city_sla")),
        TODAY,
    )
    return _parcels(s).select("k", result.alias("result"))


@check(f"""
SELECT k, CASE WHEN cod > 0 THEN 'COD' ELSE 'Non COD' END AS report_type,
  CASE WHEN cod > 0 THEN 'COD' WHEN cod = 0 THEN 'Non COD' END AS seller_type, coalesce(cod, 0) AS amount,
  CASE WHEN state = 'Signed' OR delivered IS NOT NULL THEN 'Delivered' END AS delivered_flag
FROM ({_cte(_PARCELS)}) AS p""")
def cod_and_delivered_flags(s: Source) -> DataFrame:
    cod = F.col("cod")
    return _parcels(s).select(
        "k",
        delivery.cod_type(cod, missing_is_non_cod=True).alias("report_type"),
        delivery.cod_type(cod, missing_is_non_cod=False).alias("seller_type"),
        values.null_to_zero(cod).alias("amount"),
        delivery.delivered_flag(F.col("state"), F.col("delivered")).alias("delivered_flag"),
    )


@check(f"""
SELECT k, CASE WHEN source = 'VIP Customer Portal' THEN order_status ELSE service END AS sales_owner
FROM ({_cte(_ORDERS)}) AS o""")
def owner_pick(s: Source) -> DataFrame:
    sales_owner = pickup.owner(F.col("source"), F.col("order_status"), F.col("service"))
    return _orders(s).select("k", sales_owner.alias("sales_owner"))


@check(f"""{domain.with_tables("standard_shipping_fee")}
SELECT shipping_client_id, sender_location_id, recipient_location_id, express_type, search_code,
  CAST(max_sla AS BIGINT) AS max_sla
FROM (
  SELECT *, row_number() OVER (PARTITION BY shipping_client_id, sender_location_id, recipient_location_id, express_type
    ORDER BY created_at DESC, max_sla DESC NULLS LAST, search_code DESC) AS lane_place
  FROM (SELECT *, row_number() OVER (PARTITION BY search_code ORDER BY created_at DESC, max_sla DESC NULLS LAST) AS place
        FROM standard_shipping_fee
        WHERE deleted = '0' AND CAST(end_expire_time + INTERVAL 7 HOUR AS DATE) > {mart_sql.TODAY}) AS valid
  WHERE place = 1) AS newest
WHERE lane_place = 1""")
def price_effective(s: Source) -> DataFrame:
    t = domain.tables(s.spark, s.sf_dir)
    return current_prices(t, domain.CLOCK).rows.select(
        "shipping_client_id",
        "sender_location_id",
        "recipient_location_id",
        "express_type",
        "search_code",
        "max_sla",
    )


_REASONS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, reason,
  CASE l_suppkey % 5 WHEN 0 THEN 'PAPUA' WHEN 1 THEN 'NTT' WHEN 2 THEN 'BALI' END AS province,
  CASE WHEN l_returnflag = 'R' THEN l_quantity END AS cod,
  CASE l_linenumber % 3 WHEN 0 THEN 'Percobaan pengambilan terkendala' WHEN 1 THEN 'Delivery problem' END AS kind
FROM {lineitem} LEFT JOIN {reason_codes} ON n = (l_partkey * 7 + l_suppkey) % 100"""
_REASONS_CTE = f"{domain.with_tables('reason_codes')}, rows_with_reason AS ({_cte(_REASONS)})"


def _reasons(s: Source) -> DataFrame:
    codes = domain.frames(s.spark, s.sf_dir, ["reason_codes"])["reason_codes"]
    return s.rows(_REASONS, lineitem=s.lineitem, reason_codes=codes)


_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_ID_SQL = ", ".join(_IDS)


@check(f"""{_REASONS_CTE}
SELECT {_ID_SQL}, {mart_sql.category("reason")} AS category,
  CASE {mart_sql.classes("reason", reasons.NARROW_CATEGORIES)}
    WHEN {mart_sql.among("province", reasons.HARD_TO_REACH_PROVINCES)} AND cod > 0 THEN 'Uncoverage' END AS narrow,
  CASE WHEN {mart_sql.among("reason", [*reasons.DAMAGED, *reasons.LOST, *reasons.MIXED_UP, *reasons.MISROUTED])}
    THEN reason END AS handling,
  CASE WHEN kind <> 'Percobaan pengambilan terkendala' THEN reason END AS oms FROM rows_with_reason""")
def reason_category(s: Source) -> DataFrame:
    reason = F.col("reason")
    return _reasons(s).select(
        *_IDS,
        reasons.problem_category(reason).alias("category"),
        reasons.narrow_category(reason, F.col("province"), F.col("cod")).alias("narrow"),
        reasons.handling_problem(reason).alias("handling"),
        reasons.order_system_problem(F.col("kind"), reason).alias("oms"),
    )


@check(f"""{_REASONS_CTE}
SELECT {_ID_SQL},
  CASE {mart_sql.classes("reason", reasons.PICKUP_FACTORS)} WHEN reason IS NULL THEN 'IDE' END AS pickup_factor,
  CASE {mart_sql.classes("reason", reasons.PICKUP_CONTROL)} WHEN reason IS NULL THEN 'Controllable' END AS pickup_control,
  CASE {mart_sql.classes("reason", reasons.DELIVERY_FACTORS)} WHEN reason IS NULL THEN 'IDE' END AS delivery_factor,
  CASE {mart_sql.classes("reason", reasons.DELIVERY_CONTROL)} WHEN reason IS NULL THEN 'Controllable' END
    AS delivery_control,
  CASE WHEN reason IS NULL THEN province WHEN {mart_sql.among("reason", reasons.NOT_A_DELIVERY_PROBLEM)} THEN NULL
    ELSE reason END AS late_reason FROM rows_with_reason""")
def reason_owner(s: Source) -> DataFrame:
    reason = F.col("reason")
    return _reasons(s).select(
        *_IDS,
        reasons.pickup_factor(reason).alias("pickup_factor"),
        reasons.pickup_control(reason).alias("pickup_control"),
        reasons.delivery_factor(reason).alias("delivery_factor"),
        reasons.delivery_control(reason).alias("delivery_control"),
        reasons.late_reason(reason, F.col("province")).alias("late_reason"),
    )


_LADDER = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, reason,
  CASE l_partkey % 11 WHEN 0 THEN 'Cancel Order' WHEN 1 THEN NULL ELSE 'Picked Up' END AS order_status,
  CASE l_suppkey % 7 WHEN 0 THEN 'Signed' WHEN 1 THEN 'Return Received' WHEN 2 THEN NULL ELSE 'Delivering' END AS state,
  CASE WHEN l_suppkey % 13 = 0 THEN 'Void' ELSE 'Not void' END AS void_label,
  CASE WHEN l_partkey % 5 = 0 THEN l_shipdate END AS delivered,
  CASE WHEN l_partkey % 7 < 2 THEN l_shipdate END AS confirmed,
  CASE WHEN l_partkey % 17 = 0 THEN l_shipdate END AS returned,
  CASE l_linenumber % 3 WHEN 0 THEN 'Retur' WHEN 1 THEN 'Tidak Retur' END AS return_label
FROM {lineitem} LEFT JOIN {reason_codes} ON n = (l_partkey * 7 + l_suppkey) % 100"""


@check(f"""{domain.with_tables("reason_codes")}, parcels_seen AS ({_cte(_LADDER)})
SELECT {_ID_SQL},
  CASE WHEN order_status = 'Cancel Order' OR state IS NULL OR void_label = 'Void' THEN 'Cancel Order'
    WHEN state = 'Signed' OR delivered IS NOT NULL THEN 'Delivered'
    WHEN state = 'Return Received' OR returned IS NOT NULL THEN 'Returned'
    WHEN confirmed IS NOT NULL AND return_label = 'Retur' THEN 'Return Process'
    WHEN {mart_sql.among("reason", [*reasons.LOST, *reasons.DAMAGED])} OR contains(reason, 'bea cukai')
      OR contains(reason, 'Rejected by customs') THEN 'Undelivered' ELSE 'Delivery Process' END AS report,
  CASE WHEN order_status = 'Cancel Order' OR void_label = 'Void' THEN 'Cancel Order' WHEN state IS NULL THEN 'Not Picked Up'
    WHEN state = 'Signed' OR delivered IS NOT NULL THEN 'Delivered'
    WHEN state = 'Return Received' OR returned IS NOT NULL THEN 'Returned'
    WHEN contains(reason, 'Rejected by customs') OR {mart_sql.among("reason", [*reasons.LOST, *reasons.DAMAGED])}
      THEN 'Undelivered'
    WHEN confirmed IS NOT NULL THEN 'Return Process' ELSE 'Delivery Process' END AS seller,
  CASE WHEN order_status = 'Cancel Order' OR void_label = 'Void' THEN 'Cancel Order' WHEN state IS NULL THEN 'Not Picked Up'
    WHEN state = 'Signed' OR delivered IS NOT NULL THEN 'Delivered'
    WHEN state = 'Return Received' OR returned IS NOT NULL THEN 'Returned'
    WHEN confirmed IS NOT NULL THEN 'Return Process'
    WHEN contains(reason, 'Rejected by customs') OR contains(reason, 'bea cukai') THEN 'Paket ditolak bea cukai (red line)'
    {mart_sql.classes("reason", reasons.NARROW_CATEGORIES)} ELSE 'Over SLA' END AS final,
  CASE WHEN delivered IS NOT NULL THEN 'Delivered' WHEN returned IS NOT NULL THEN 'Returned'
    WHEN return_label = 'Retur' THEN 'Return Process'
    WHEN return_label = 'Tidak Retur' AND state NOT IN ('Signed', 'Return Received') THEN 'Stuck' END AS vip
FROM parcels_seen""")
def status_ladder(s: Source) -> DataFrame:
    codes = domain.frames(s.spark, s.sf_dir, ["reason_codes"])["reason_codes"]
    rows = s.rows(_LADDER, lineitem=s.lineitem, reason_codes=codes)
    placed, state, void = F.col("order_status"), F.col("state"), F.col("void_label")
    delivered, confirmed, returned = F.col("delivered"), F.col("confirmed"), F.col("returned")
    flag, reason = F.col("return_label"), F.col("reason")
    ladder = (placed, state, void, delivered, confirmed, returned)
    return rows.select(
        *_IDS,
        status.report_status(*ladder, flag, reason).alias("report"),
        status.seller_status(*ladder, reason).alias("seller"),
        status.seller_final_status(*ladder, reason).alias("final"),
        status.vip_status(state, flag, delivered, returned).alias("vip"),
    )


@check("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, state, aging,
  CASE WHEN state = 'Backlog Return' THEN CASE WHEN aging > 30 THEN '>30 Days' WHEN aging > 14 THEN '15-30 Days'
    WHEN aging > 7 THEN '8-14 Days' WHEN aging > 2 THEN '3-7 Days' ELSE '<3 Days' END END AS bucket
FROM (SELECT *, (l_partkey % 45 - 3)::BIGINT AS aging, CASE WHEN l_returnflag = 'N' THEN NULL
    WHEN l_linestatus = 'O' THEN 'Backlog Confirm Return' WHEN l_suppkey % 2 = 0 THEN 'Backlog Return'
    ELSE 'POD Return' END AS state FROM lineitem) AS t""")
def return_backlog(s: Source) -> DataFrame:
    shipped = F.col("l_shipdate")
    state = status.return_state(
        F.when(F.col("l_returnflag") != "N", shipped),
        F.when(F.col("l_linestatus") != "O", shipped),
        F.when(F.col("l_suppkey") % 2 != 0, shipped),
    )
    rows = s.lineitem.withColumns({"aging": F.col("l_partkey") % 45 - 3, "state": state})
    bucket = status.backlog_bucket(F.col("state"), status.RETURN_BACKLOG, F.col("aging"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "state", "aging", bucket.alias("bucket"))


_BRANCHES = f"""
SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN 'MH' WHEN 1 THEN 'Outlet' WHEN 2 THEN 'HQ' WHEN 3 THEN 'PDB'
    WHEN 4 THEN NULL ELSE 'TH' END AS level, kanwil, province, s_name AS branch
FROM {{supplier}} JOIN {{places}} ON place = s_nationkey"""


@check(f"""{domain.with_tables("places")}, branches AS ({_cte(_BRANCHES)})
SELECT s_suppkey, {mart_sql.zone("level", "kanwil", "province")} AS zone,
  s_suppkey || ' - ' || {mart_sql.zone("level", "kanwil", "province")} || ' - ' || branch AS work_location FROM branches""")
def courier_zone(s: Source) -> DataFrame:
    places = domain.frames(s.spark, s.sf_dir, ["places"])["places"]
    rows = s.rows(_BRANCHES, supplier=s.supplier, places=places)
    zone = courier.courier_zone(F.col("level"), F.col("kanwil"), F.col("province"))
    rows = rows.withColumn("zone", zone)
    return rows.select(
        "s_suppkey", "zone", values.joined(F.col("s_suppkey").cast("string"), "zone", "branch").alias("work_location")
    )


@check(f"""{domain.with_tables("waybill_waybill", "res_user")}
SELECT waybill_no, CAST(w.update_time AS VARCHAR) AS update_time,
  CASE pickup_courier_id WHEN 0 THEN vip_customer_id ELSE pickup_courier_id END AS courier_id,
  CASE pickup_courier_name WHEN '' THEN signer ELSE pickup_courier_name END AS courier_name,
  CASE u.enabled WHEN '1' THEN 'active' WHEN '0' THEN 'inactive' END AS account,
  CASE WHEN (u.enabled = '1' OR o.enabled = '1') AND (u.deleted = '0' OR o.deleted = '0') THEN 'active'
    ELSE 'inactive' END AS any_account
FROM waybill_waybill w LEFT JOIN res_user u ON u.id = pickup_courier_id LEFT JOIN res_user o ON o.id = vip_customer_id""")
def courier_fallback(s: Source) -> DataFrame:
    t = domain.tables(s.spark, s.sf_dir)
    rows = t["waybill_waybill"]
    for key, prefix in (("pickup_courier_id", "u"), ("vip_customer_id", "o")):
        take = {f"{prefix}_enabled": "enabled", f"{prefix}_deleted": "deleted"}
        rows = lookup(rows, t["res_user"], {key: "id"}, take)
    return rows.select(
        "waybill_no",
        "update_time",
        values.sentinel_pick(F.col("pickup_courier_id"), 0, F.col("vip_customer_id")).alias("courier_id"),
        values.sentinel_pick(F.col("pickup_courier_name"), "", F.col("signer")).alias("courier_name"),
        courier.account_state(F.col("u_enabled")).alias("account"),
        courier.any_account_active(
            F.col("u_enabled"), F.col("u_deleted"), F.col("o_enabled"), F.col("o_deleted")
        ).alias("any_account"),
    )


@check("""
SELECT c_mktsegment, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS orders,
  count(*) FILTER (o_totalprice > 200000) AS large, round(sum(o_totalprice), 2) AS revenue,
  count(DISTINCT CAST(o_orderdate AS DATE)) AS days
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3""")
def vip_rollup(s: Source) -> DataFrame:
    rows = s.orders.join(s.customer, F.col("c_custkey") == F.col("o_custkey")).withColumn("day", F.to_date("o_orderdate"))
    return rows.groupBy("c_mktsegment", "o_orderstatus", "day").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(values.flag(F.col("o_totalprice") > 200000)).alias("large"),
        F.round(F.sum("o_totalprice"), 2).alias("revenue"),
        F.max(values.flag(F.col("day").isNotNull())).alias("days"),
    )


@check("""
SELECT o_orderkey, CASE WHEN days <= 0 THEN 'today' WHEN days <= 2 THEN '1-2' WHEN days <= 14 THEN '3-14' ELSE '15+' END
  AS bucket, (days = 0)::BIGINT AS aging_0day, (days BETWEEN 3 AND 14)::BIGINT AS aging_3_14day
FROM (SELECT o_orderkey, o_custkey % 30 AS days FROM orders) AS t""")
def aging_buckets(s: Source) -> DataFrame:
    days = F.col("o_custkey") % 30
    return s.orders.select(
        "o_orderkey",
        buckets(days, [(None, 0, "today"), (1, 2, "1-2"), (3, 14, "3-14"), (15, None, "15+")]).alias("bucket"),
        values.flag(days == 0).alias("aging_0day"),
        values.flag(days.between(3, 14)).alias("aging_3_14day"),
    )
