"""Checks of lookups, joins, merges and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.checks.registry import Registry, Source
from parceltrail.functions.clock import Clock, band, date_of, recent, utc_range
from parceltrail.functions.values import joined
from parceltrail.operators.keyed import latest_per_key
from parceltrail.operators.lookup import (
    Dimension,
    Labels,
    decode,
    having_key,
    left_join_heavy_right,
    lookup,
    lookup_roles,
    with_value,
    without_value,
)
from parceltrail.operators.merge import merge, only_left, only_right, prefer_left, right_once_set
from parceltrail.operators.sets import stack_rows

registry = Registry()
check = registry.check

EVENT_CLOCK = Clock.at("2024-01-31T03:00:00Z")
ORDER_CLOCK = Clock.at("2001-08-01T00:00:00Z", "UTC")

_CODES = """SELECT * FROM (VALUES ('orderStatus', 'O', 'Open'), ('orderStatus', 'F', 'Filled'), ('flag', 'P', 'Wrong'))
AS codes(type_option, option_value, option_name)"""


@check(f"""
WITH codes AS ({_CODES})
SELECT o_orderkey, option_name AS status_label FROM orders
LEFT JOIN codes ON type_option = 'orderStatus' AND option_value = o_orderstatus""")
def code_decode(s: Source) -> DataFrame:
    rows = decode(s.orders, Labels.read(s.rows(_CODES)), "o_orderstatus", "orderStatus", "status_label")
    return rows.select("o_orderkey", "status_label")


@check(f"""
WITH codes AS ({_CODES})
SELECT o_orderkey, option_name AS status_label FROM orders
LEFT JOIN codes ON type_option = 'orderStatus' AND option_value = o_orderstatus""")
def code_decode_joined(s: Source) -> DataFrame:
    """The form for option tables of any size."""
    rows = decode(s.orders, s.rows(_CODES), "o_orderstatus", "orderStatus", "status_label")
    return rows.select("o_orderkey", "status_label")


@check("""
SELECT a.n_name AS seller_nation, b.n_name AS buyer_nation, count(*) AS n FROM lineitem
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation a ON a.n_nationkey = s_nationkey
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation b ON b.n_nationkey = c_nationkey GROUP BY 1, 2""")
def role_lookup(s: Source) -> DataFrame:
    keyed = lambda rows, key: Dimension(rows, (key,), True)
    rows = lookup(s.lineitem, keyed(s.supplier, "s_suppkey"), {"l_suppkey": "s_suppkey"}, {"seller": "s_nationkey"})
    rows = lookup(rows, keyed(s.orders, "o_orderkey"), {"l_orderkey": "o_orderkey"}, {"buyer_id": "o_custkey"})
    rows = lookup(rows, keyed(s.customer, "c_custkey"), {"buyer_id": "c_custkey"}, {"buyer": "c_nationkey"})
    rows = lookup_roles(
        rows,
        Dimension.counted(s.nation, ["n_nationkey"]),
        [
            ({"seller": "n_nationkey"}, {"seller_nation": "n_name"}),
            ({"buyer": "n_nationkey"}, {"buyer_nation": "n_name"}),
        ],
    )
    return rows.groupBy("seller_nation", "buyer_nation").agg(F.count(F.lit(1)).alias("n"))


@check("""
SELECT s_suppkey, n_name AS nation, r_name AS region FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def chained_lookup(s: Source) -> DataFrame:
    rows = lookup(
        s.supplier, s.nation, {"s_nationkey": "n_nationkey"}, {"nation": "n_name", "__region": "n_regionkey"}
    )
    rows = lookup(rows, s.region, {"__region": "r_regionkey"}, {"region": "r_name"})
    return rows.select("s_suppkey", "nation", "region")


_PRICES = """SELECT l_partkey, l_suppkey, l_extendedprice AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_extendedprice DESC) AS place
  FROM lineitem) AS t WHERE place = 1"""


@check(f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, round(p.price, 4) AS newest_price
FROM lineitem l LEFT JOIN ({_PRICES}) AS p ON p.l_partkey = l.l_partkey AND p.l_suppkey = l.l_suppkey""")
def composite_lookup(s: Source) -> DataFrame:
    lane = ["l_partkey", "l_suppkey"]
    prices = latest_per_key(s.lineitem, lane, "l_shipdate", ["l_extendedprice"])
    rows = lookup(s.lineitem, Dimension(prices, tuple(lane), True), {c: c for c in lane}, {"newest_price": "l_extendedprice"})
    return rows.select("l_orderkey", "l_linenumber", *lane, "newest_price")


@check("""
SELECT s_suppkey, low.c_name AS buyer FROM supplier
LEFT JOIN (SELECT c_nationkey, min(c_name) AS c_name FROM customer GROUP BY 1) AS low ON low.c_nationkey = s_nationkey""")
def repeated_key_lookup(s: Source) -> DataFrame:
    """A dimension with repeated keys is reduced before the join, so fact rows do not multiply."""
    rows = lookup(s.supplier, s.customer, {"s_nationkey": "c_nationkey"}, {"buyer": "c_name"})
    return rows.select("s_suppkey", "buyer")


_NEWEST_LINE = """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
    l_suppkey DESC) AS place FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01') AS t WHERE place = 1"""


@check(f"""
SELECT coalesce(o.o_orderkey, l.l_orderkey) AS k, coalesce(o.o_orderdate, l.l_shipdate)::VARCHAR AS moment,
  CASE WHEN o.o_orderstatus IS NULL THEN o.o_orderpriority ELSE l.l_returnflag END AS account,
  round(o.o_totalprice, 4) AS ordered_price, round(l.l_extendedprice, 4) AS shipped_price
FROM (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') AS o
FULL JOIN ({_NEWEST_LINE}) AS l ON l.l_orderkey = o.o_orderkey""")
def full_merge(s: Source) -> DataFrame:
    orders = s.orders.where(F.col("o_orderpriority") != "5-LOW").withColumnRenamed("o_orderkey", "k")
    lines = s.lineitem.where(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    lines = latest_per_key(lines, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey", "l_suppkey"])
    return merge(
        orders,
        lines.withColumnRenamed("l_orderkey", "k"),
        "k",
        {
            "k": prefer_left("k"),
            "moment": prefer_left("o_orderdate", "l_shipdate"),
            "account": right_once_set("o_orderstatus", "o_orderpriority", "l_returnflag"),
            "ordered_price": only_left("o_totalprice"),
            "shipped_price": only_right("l_extendedprice"),
        },
    )


_RETURNS = """SELECT l_orderkey, max(CASE WHEN l_quantity > 10 THEN l_shipdate END) AS returned_at
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"""


def _returns(s: Source) -> DataFrame:
    rows = s.lineitem.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return rows.agg(F.max(F.when(F.col("l_quantity") > 10, F.col("l_shipdate"))).alias("returned_at"))


@check(f"""
SELECT o_orderkey, o_custkey FROM orders LEFT JOIN ({_RETURNS}) AS r ON l_orderkey = o_orderkey
WHERE returned_at IS NULL""")
def near_anti(s: Source) -> DataFrame:
    return without_value(s.orders, _returns(s), "o_orderkey", "returned_at").select("o_orderkey", "o_custkey")


@check(f"""
SELECT o_orderkey, CAST(returned_at AS VARCHAR) AS returned_at FROM orders
LEFT JOIN ({_RETURNS}) AS r ON l_orderkey = o_orderkey WHERE returned_at IS NOT NULL""")
def near_semi(s: Source) -> DataFrame:
    return with_value(s.orders, _returns(s), "o_orderkey", "returned_at").select("o_orderkey", "returned_at")


@check(f"""
WITH codes AS ({_CODES})
SELECT o_orderkey, option_name AS status_label FROM orders
LEFT JOIN codes ON type_option = 'orderStatus' AND option_value = o_orderstatus WHERE option_name = 'Open'""")
def outer_filter_inner(s: Source) -> DataFrame:
    rows = decode(s.orders, s.rows(_CODES), "o_orderstatus", "orderStatus", "status_label")
    return rows.where(F.col("status_label") == "Open").select("o_orderkey", "status_label")


@check("""
SELECT o_orderkey, l_partkey AS part, CAST(l_shipdate AS VARCHAR) AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST,
    l_suppkey DESC NULLS LAST) AS place
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= TIMESTAMP '1998-01-01') AS t
WHERE place = 1""")
def fanout_collapse(s: Source) -> DataFrame:
    """The right side is reduced to one row per key before the join instead of joining all rows and picking one."""
    lines = s.lineitem.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    lines = latest_per_key(lines, ["l_orderkey"], "l_shipdate", ["l_partkey", "l_suppkey"])
    rows = lookup(s.orders, lines, {"o_orderkey": "l_orderkey"}, {"part": "l_partkey", "shipped": "l_shipdate"})
    return rows.select("o_orderkey", "part", "shipped")


@check("""
SELECT c_mktsegment, count(*) AS buyers, round(sum(c_acctbal), 2) AS balance
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def unused_lookup_dropped(s: Source) -> DataFrame:
    """A lookup by a unique key whose columns are never read is left out."""
    return s.customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("buyers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@check("""
SELECT o_orderkey, o_orderstatus FROM orders
LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AS a ON l_orderkey = o_orderkey
WHERE o_orderstatus <> '' AND o_orderstatus = 'F' AND l_orderkey IS NULL AND o_orderdate > DATE '1996-06-01'""")
def flag_null_filters(s: Source) -> DataFrame:
    flagged = s.lineitem.where(F.col("l_returnflag") == "A").select("l_orderkey").distinct()
    rows = lookup(s.orders, flagged, {"o_orderkey": "l_orderkey"}, {"flagged": "l_orderkey"})
    rows = rows.where((F.col("o_orderstatus") != "") & (F.col("o_orderstatus") == "F") & F.col("flagged").isNull())
    return rows.where(F.col("o_orderdate") > F.lit("1996-06-01").cast("date")).select("o_orderkey", "o_orderstatus")


@check("SELECT * FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) AS t WHERE n >= 2")
def post_filter_nested(s: Source) -> DataFrame:
    return s.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)


@check("""
SELECT p_partkey, p_type FROM part
WHERE (p_name LIKE '%red%' AND p_type IN ('ECONOMY', 'SMALL')) OR (p_brand NOT IN ('Brand#1', 'Brand#2')
  AND p_name LIKE '%bolt%')""")
def like_in_filters(s: Source) -> DataFrame:
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    test = (name.contains("red") & kind.isin("ECONOMY", "SMALL")) | (
        ~brand.isin("Brand#1", "Brand#2") & name.contains("bolt")
    )
    return s.part.where(test).select("p_partkey", "p_type")


@check("""
SELECT event_id, user_id FROM events
WHERE CAST(ts + INTERVAL 7 HOUR AS DATE) >= DATE '2024-01-31' - 14""")
def rolling_window(s: Source) -> DataFrame:
    return s.events.where(recent("ts", 14, EVENT_CLOCK)).select("event_id", "user_id")


@check("""
SELECT o_orderkey FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-08-01' - 930 AND DATE '2001-08-01' - 780""")
def band_window(s: Source) -> DataFrame:
    return s.orders.where(band(date_of("o_orderdate"), 930, 780, ORDER_CLOCK)).select("o_orderkey")


@check("SELECT event_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def fixed_range_utc(s: Source) -> DataFrame:
    return s.events.where(utc_range("ts", "2024-01-05", "2024-01-20")).select("event_id")


@check("""
WITH keyed AS (SELECT *, CASE WHEN value > 5 THEN user_id || ' - ' || event_type END AS tag FROM events),
totals AS (SELECT user_id || ' - ' || event_type AS tag, count(*) AS n FROM events GROUP BY 1)
SELECT event_id, keyed.tag, n FROM keyed LEFT JOIN totals ON totals.tag = keyed.tag""")
def concat_key_join(s: Source) -> DataFrame:
    user = F.col("user_id").cast("string")
    tag = joined(F.when(F.col("value") > 5, user), "event_type")
    totals = s.events.groupBy(joined(user, "event_type").alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    rows = lookup(s.events.withColumn("tag", tag), totals, {"tag": "tag"}, {"n": "n"})
    return rows.select("event_id", "tag", "n")


@check("""
SELECT l_orderkey, l_partkey FROM lineitem
WHERE l_returnflag || '-' || nullif(l_linestatus, 'O') || '-' || l_linenumber IS NOT NULL""")
def null_concat_filter(s: Source) -> DataFrame:
    state = F.when(F.col("l_linestatus") != "O", F.col("l_linestatus"))
    whole = F.concat("l_returnflag", F.lit("-"), state, F.lit("-"), F.col("l_linenumber").cast("string"))
    return s.lineitem.where(whole.isNotNull()).select("l_orderkey", "l_partkey")


@check("""
SELECT n_nationkey, l_orderkey, round(l_quantity, 4) AS quantity FROM nation
LEFT JOIN lineitem ON l_suppkey = n_nationkey""")
def heavy_right_join(s: Source) -> DataFrame:
    """A small side left-joined to a large one in which one key may hold most rows."""
    lines = s.lineitem.select("l_suppkey", "l_orderkey", F.col("l_quantity").alias("quantity"))
    rows = left_join_heavy_right(s.nation, lines, "n_nationkey", "l_suppkey")
    return rows.select("n_nationkey", "l_orderkey", "quantity")


@check("SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def key_restriction(s: Source) -> DataFrame:
    buyers = s.events.where(F.col("event_type") == "purchase").select("user_id").distinct()
    return having_key(s.events, buyers, "user_id").select("event_id")


@check("""
SELECT user_id, event_type, event_type || ' - ' || half AS label, half, CAST(first_ts AS VARCHAR) AS first_ts FROM (
  SELECT user_id, event_type, 'forward' AS half, min(ts) AS first_ts FROM events WHERE value < 10 GROUP BY 1, 2
  UNION ALL SELECT user_id, event_type, 'return', min(ts) FROM events WHERE value >= 10 GROUP BY 1, 2) AS t
WHERE CAST(first_ts AS DATE) BETWEEN DATE '2024-01-31' - 28 AND DATE '2024-01-31' - 14""")
def dwell_union(s: Source) -> DataFrame:
    def half(name: str, test) -> DataFrame:
        rows = s.events.where(test).groupBy("user_id", "event_type").agg(F.min("ts").alias("first_ts"))
        return rows.where(band(date_of("first_ts"), 28, 14, EVENT_CLOCK)).select(
            "user_id",
            "event_type",
            joined("event_type", F.lit(name)).alias("label"),
            F.lit(name).alias("half"),
            "first_ts",
        )

    return stack_rows(half("forward", F.col("value") < 10), half("return", F.col("value") >= 10))


@check("""
SELECT l_orderkey, l_suppkey, l_orderkey || ' - ' || l_suppkey AS tag, count(*) AS parcels,
  round(sum(l_extendedprice), 2) AS fee FROM lineitem GROUP BY 1, 2""")
def cargo_tags(s: Source) -> DataFrame:
    tag = joined(F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))
    return s.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.first(tag).alias("tag"),
        F.count(F.lit(1)).alias("parcels"),
        F.round(F.sum("l_extendedprice"), 2).alias("fee"),
    )


@check("""
SELECT s_suppkey, round(coalesce(fee, 0), 2) AS fee, lines FROM supplier
LEFT JOIN (SELECT l_suppkey, sum(l_extendedprice) AS fee, count(*) AS lines FROM lineitem GROUP BY 1) AS t
  ON l_suppkey = s_suppkey""")
def cargo_bag_rollup(s: Source) -> DataFrame:
    totals = s.lineitem.groupBy("l_suppkey").agg(
        F.sum("l_extendedprice").alias("fee"), F.count(F.lit(1)).alias("lines")
    )
    rows = lookup(s.supplier, totals, {"s_suppkey": "l_suppkey"}, {"fee": "fee", "lines": "lines"})
    return rows.select("s_suppkey", F.round(F.coalesce("fee", F.lit(0.0)), 2).alias("fee"), "lines")


@check("""
SELECT s_suppkey, CASE WHEN s_nationkey = 7 THEN 'MH JAKARTA' ELSE n_name END AS hub FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey""")
def hub_override(s: Source) -> DataFrame:
    rows = lookup(s.supplier, s.nation, {"s_nationkey": "n_nationkey"}, {"hub": "n_name"})
    hub = F.when(F.col("s_nationkey") == 7, "MH JAKARTA").otherwise(F.col("hub"))
    return rows.select("s_suppkey", hub.alias("hub"))


@check("SELECT o_orderkey, o_orderstatus, o_custkey FROM orders ORDER BY o_orderstatus, o_orderkey")
def ordered_output(s: Source) -> DataFrame:
    return s.orders.select("o_orderkey", "o_orderstatus", "o_custkey").orderBy("o_orderstatus", "o_orderkey")
