"""Checks of the per-key operators, on orders, lineitem and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.checks.registry import Registry, Source
from parceltrail.functions.clock import local_dt
from parceltrail.operators import keyed
from parceltrail.operators.segments import branch_stays, longest_stays
from parceltrail.operators.sets import stack_rows
from parceltrail.operators.summary import at_earliest, at_latest, attach, count_where, summarise

registry = Registry()
check = registry.check


def _pick(table: str, key: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place FROM {table}) AS t WHERE place = 1"""


@check(
    _pick(
        "orders",
        "o_custkey",
        "o_orderdate DESC, o_orderkey DESC",
        "o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate",
    )
)
def latest_version(s: Source) -> DataFrame:
    rows = keyed.latest_per_key(s.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@check(
    _pick(
        "orders",
        "o_custkey",
        "o_orderdate DESC, o_orderkey DESC",
        "o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate",
    )
)
def latest_version_merged(s: Source) -> DataFrame:
    """The history comes in three parts, in no order of time; each is merged into what is current."""
    part = lambda k: s.orders.where(F.col("o_orderkey") % 3 == k)
    rows = keyed.latest_per_key(part(0), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    for k in (1, 2):
        rows = keyed.merge_latest(rows, part(k), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@check(_pick("events", "user_id", "ts ASC", "user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts"))
def first_event(s: Source) -> DataFrame:
    return keyed.first_per_key(s.events, ["user_id"], "ts").select("user_id", "event_id", "event_type", "ts")


@check(_pick("events", "user_id", "ts DESC", "user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts"))
def last_event(s: Source) -> DataFrame:
    return keyed.latest_per_key(s.events, ["user_id"], "ts").select("user_id", "event_id", "event_type", "ts")


@check("""
SELECT user_id, event_type, CAST(min(ts) AS VARCHAR) AS first_ts, CAST(max(ts) AS VARCHAR) AS last_ts,
  arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id FROM events GROUP BY 1, 2""")
def branch_first_last(s: Source) -> DataFrame:
    ts, event = F.col("ts"), F.col("event_id")
    return summarise(
        s.events,
        ["user_id", "event_type"],
        {
            "first_ts": F.min(ts),
            "last_ts": F.max(ts),
            "first_id": at_earliest(ts, event),
            "last_id": at_latest(ts, event),
        },
    )


@check(_pick("events", "user_id, event_type", "event_id ASC", "user_id, event_type, event_id, value"))
def any_row_per_key(s: Source) -> DataFrame:
    rows = keyed.any_per_key(s.events, ["user_id", "event_type"], ["event_id"])
    return rows.select("user_id", "event_type", "event_id", "value")


@check("SELECT DISTINCT user_id, event_type FROM events")
def any_row_unordered(s: Source) -> DataFrame:
    return keyed.any_per_key(s.events, ["user_id", "event_type"]).select("user_id", "event_type")


@check("""
SELECT DISTINCT user_id, event_type, count(value) OVER (PARTITION BY user_id, event_type) AS n FROM events""")
def partition_count(s: Source) -> DataFrame:
    return keyed.count_per_key(s.events, ["user_id", "event_type"], "value", "n")


@check("""
SELECT user_id, event_id, min(event_type) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS first_types,
  max(event_type) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) AS last_types,
  round(min(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)), 4) AS lowest FROM events""")
def running_extrema(s: Source) -> DataFrame:
    rows = s.events.withColumn("day", F.to_date("ts"))
    outputs = {"first_types": ("event_type", "min"), "last_types": ("event_type", "max"), "lowest": ("value", "min")}
    return keyed.running_extreme(rows, ["user_id"], "day", outputs).select("user_id", "event_id", *outputs)


@check("""
SELECT event_id, lag(event_type) OVER w AS previous_1, lag(event_type, 2) OVER w AS previous_2,
  lead(event_type) OVER w AS following FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def lag_lead_path(s: Source) -> DataFrame:
    rows = keyed.neighbours(
        s.events,
        ["user_id"],
        ["ts", "event_id"],
        {"previous_1": ("event_type", 1), "previous_2": ("event_type", 2)},
        {"following": ("event_type", 1)},
    )
    return rows.select("event_id", "previous_1", "previous_2", "following")


@check("""
SELECT event_id, user_id, rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS attempt
FROM events WHERE event_type = 'error'""")
def attempt_rank(s: Source) -> DataFrame:
    rows = s.events.where(F.col("event_type") == "error").withColumn("day", F.to_date("ts"))
    return keyed.attempt_rank(rows, ["user_id"], "day", "attempt").select("event_id", "user_id", "attempt")


@check("""
SELECT event_id, lag(user_id, 2) OVER w AS earlier, lead(user_id) OVER w AS later
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY CAST(ts AS DATE), event_id)""")
def lag_lead_hot_buckets(s: Source) -> DataFrame:
    """A few keys hold all rows, and each of their days is one time: hot buckets are cut along the rest of the order."""
    rows = s.events.withColumn("day", F.to_date("ts"))
    lags, leads = {"earlier": ("user_id", 2)}, {"later": ("user_id", 1)}
    rows = keyed.neighbours(rows, ["event_type"], ["day", "event_id"], lags, leads, hot_rows=50)
    return rows.select("event_id", "earlier", "later")


@check("""
SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS place FROM events""")
def attempt_rank_hot_buckets(s: Source) -> DataFrame:
    rows = s.events.withColumn("day", F.to_date("ts"))
    return keyed.attempt_rank(rows, ["event_type"], "day", "place", hot_rows=50).select("event_id", "place")


@check("""
SELECT event_id, max(user_id) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC) AS largest,
  round(min(value) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)), 4) AS lowest FROM events""")
def running_extrema_hot_buckets(s: Source) -> DataFrame:
    rows, outputs = s.events.withColumn("day", F.to_date("ts")), {"largest": ("user_id", "max"), "lowest": ("value", "min")}
    return keyed.running_extreme(rows, ["event_type"], "day", outputs, hot_rows=50).select("event_id", *outputs)


@check("""
SELECT user_id,
  CAST(max(CASE WHEN id = 1 THEN day END) AS VARCHAR) AS tried_1,
  CAST(max(CASE WHEN id = 2 THEN day END) AS VARCHAR) AS tried_2,
  CAST(max(CASE WHEN id = 3 THEN day END) AS VARCHAR) AS tried_3,
  round(max(CASE WHEN id = 1 THEN value END), 4) AS worth_1, round(max(CASE WHEN id = 2 THEN value END), 4) AS worth_2,
  round(max(CASE WHEN id = 3 THEN value END), 4) AS worth_3
FROM (SELECT user_id, value, CAST(ts AS DATE) AS day, rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS id
      FROM events WHERE event_type = 'error') AS attempts GROUP BY 1""")
def attempt_pivot(s: Source) -> DataFrame:
    rows = s.events.where(F.col("event_type") == "error").withColumn("day", F.to_date("ts"))
    return keyed.attempt_pivot(rows, ["user_id"], "day", 3, {"tried": "day", "worth": "value"})


def _stays(s: Source) -> DataFrame:
    rows = keyed.neighbours(
        s.events,
        ["user_id"],
        ["ts", "event_id"],
        {"before_1": ("event_type", 1), "before_2": ("event_type", 2)},
        {"after_1": ("event_type", 1)},
    )
    return branch_stays(
        rows,
        ["user_id"],
        "event_type",
        "ts",
        ["event_id", "before_1", "before_2", "after_1"],
        ["event_id"],
        {"all": (F.col("value") > 1, F.col("value") < 60)},
    )


_STAYS = """
log AS (SELECT *, lag(event_type) OVER w AS before_1, lag(event_type, 2) OVER w AS before_2,
    lead(event_type) OVER w AS after_1 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
opened AS (SELECT DISTINCT ON (user_id, event_type) * FROM log WHERE value > 1 ORDER BY user_id, event_type, ts),
closed AS (SELECT DISTINCT ON (user_id, event_type) * FROM log WHERE value < 60 ORDER BY user_id, event_type, ts DESC),
stays AS (SELECT o.user_id, o.event_type, o.event_id, o.ts AS first_time, o.before_1, o.before_2, o.after_1,
    c.event_id AS last_event_id, c.ts AS last_time
  FROM opened o LEFT JOIN closed c ON c.user_id = o.user_id AND c.event_type = o.event_type)"""


@check(f"""
WITH {_STAYS}
SELECT user_id, event_type, event_id, before_1, before_2, after_1, last_event_id, CAST(first_time AS VARCHAR) AS first_time,
  CAST(last_time AS VARCHAR) AS last_time,
  (SELECT arg_max(event_type, ts) FROM events e WHERE e.user_id = stays.user_id) AS newest_branch FROM stays""")
def branch_segments(s: Source) -> DataFrame:
    return _stays(s).drop("half", "newest_time")


@check(f"""
WITH {_STAYS}
SELECT user_id, event_type, CAST(hours AS BIGINT) AS scan_record_duration_hour,
  CAST(seconds AS BIGINT) AS scan_record_duration_sec, ranking, round(hours / 24, 4) AS scan_record_duration_day_1,
  ceil(hours / 24) AS rounded_duration_day
FROM (SELECT *, date_diff('hour', first_time, last_time) AS hours, date_diff('second', first_time, last_time) AS seconds,
    rank() OVER (PARTITION BY user_id ORDER BY date_diff('second', first_time, last_time) DESC NULLS LAST) AS ranking
  FROM stays) AS timed WHERE ranking <= 3 AND ceil(hours / 24) >= 14""")
def dwell_top3(s: Source) -> DataFrame:
    rows = longest_stays(_stays(s), "user_id", "first_time", "last_time", 3, 14)
    return rows.select(
        "user_id",
        "event_type",
        "scan_record_duration_hour",
        "scan_record_duration_sec",
        "ranking",
        "scan_record_duration_day_1",
        "rounded_duration_day",
    )


@check("""
SELECT e.event_id, CASE WHEN e.ts >= s.started THEN 'return process' ELSE 'forward delivery' END AS side
FROM events e LEFT JOIN (SELECT user_id, min(ts) AS started FROM events WHERE event_type = 'signup' GROUP BY 1) AS s
  ON s.user_id = e.user_id""")
def phase_split(s: Source) -> DataFrame:
    started = s.events.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("started"))
    side = F.when(F.col("ts") >= F.col("started"), "return process").otherwise("forward delivery")
    return s.events.join(started, "user_id", "left").select("event_id", side.alias("side"))


@check("""
SELECT user_id, CAST(min(ts) FILTER (event_type = 'error') AS VARCHAR) AS first_attempt,
  CAST(max(ts) FILTER (event_type = 'error') AS VARCHAR) AS last_attempt,
  count(*) FILTER (event_type = 'error') AS attempts FROM events GROUP BY 1""")
def attempt_summary(s: Source) -> DataFrame:
    failed = F.col("event_type") == "error"
    time = F.when(failed, F.col("ts"))
    return summarise(
        s.events,
        ["user_id"],
        {"first_attempt": F.min(time), "last_attempt": F.max(time), "attempts": count_where(failed)},
    )


@check("""
WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN value > 20 THEN props END AS reason
  FROM events WHERE event_type = 'error'),
edges AS (SELECT user_id, min(day) AS first_day, max(day) AS last_day FROM days GROUP BY 1)
SELECT user_id, CAST(first_day AS VARCHAR) AS first_day, CAST(last_day AS VARCHAR) AS last_day,
  (SELECT min(reason) FROM days d WHERE d.user_id = edges.user_id AND d.day = first_day) AS first_reason,
  (SELECT max(reason) FROM days d WHERE d.user_id = edges.user_id AND d.day = last_day) AS last_reason FROM edges""")
def problem_first_last(s: Source) -> DataFrame:
    rows = s.events.where(F.col("event_type") == "error").withColumn("day", F.to_date("ts"))
    day, reason = F.col("day"), F.when(F.col("value") > 20, F.col("props"))
    return summarise(
        rows,
        ["user_id"],
        {
            "first_day": F.min(day),
            "last_day": F.max(day),
            "first_reason": at_earliest(day, reason),
            "last_reason": at_latest(day, reason),
        },
    )


@check("""
SELECT user_id, max(event_type) AS last_place, max(props) AS last_activity, CAST(max(day) AS VARCHAR) AS last_day
FROM (SELECT *, CAST(ts AS DATE) AS day, max(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS newest FROM events) AS t
WHERE day = newest GROUP BY 1""")
def last_location(s: Source) -> DataFrame:
    rows, day = s.events.withColumn("day", F.to_date("ts")), F.col("day")
    return summarise(
        rows,
        ["user_id"],
        {
            "last_place": at_latest(day, F.col("event_type")),
            "last_activity": at_latest(day, F.col("props")),
            "last_day": F.max(day),
        },
    )


STAR_SQL = """
SELECT user_id, CAST(min(ts) FILTER (event_type = 'view') AS VARCHAR) AS first_view,
  CAST(max(ts) FILTER (event_type = 'view') AS VARCHAR) AS last_view,
  count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'error') AS errors,
  arg_max(event_type, ts) AS last_place, CAST(max(ts) AS VARCHAR) AS last_time FROM events GROUP BY 1"""


def one_pass_summary(events: DataFrame) -> DataFrame:
    """Five summaries of the log in one grouped pass."""
    ts, kind = F.col("ts"), F.col("event_type")
    viewed = F.when(kind == "view", ts)
    return summarise(
        events,
        ["user_id"],
        {
            "first_view": F.min(viewed),
            "last_view": F.max(viewed),
            "views": count_where(kind == "view"),
            "errors": count_where(kind == "error"),
            "last_place": at_latest(ts, kind),
            "last_time": F.max(ts),
        },
    )


@check(STAR_SQL)
def scan_summary_onepass(s: Source) -> DataFrame:
    return one_pass_summary(s.events)


@check(STAR_SQL)
def star_summary(s: Source) -> DataFrame:
    """The same five summaries as separate reads of the log joined to their keys."""
    views, errors = (s.events.where(F.col("event_type") == kind) for kind in ("view", "error"))
    base = s.events.select("user_id").distinct()
    parts = [
        keyed.first_per_key(views, ["user_id"], "ts").select("user_id", F.col("ts").alias("first_view")),
        keyed.latest_per_key(views, ["user_id"], "ts").select("user_id", F.col("ts").alias("last_view")),
        keyed.count_per_key(views, ["user_id"], "ts", "views"),
        keyed.count_per_key(errors, ["user_id"], "ts", "errors"),
        keyed.latest_per_key(s.events, ["user_id"], "ts").select(
            "user_id", F.col("event_type").alias("last_place"), F.col("ts").alias("last_time")
        ),
    ]
    return attach(base, parts, "user_id").fillna(0, ["views", "errors"])


@check("""
SELECT l_returnflag, l_linestatus, l_suppkey % 10 AS lane, round(sum(l_quantity), 4) AS quantity,
  round(sum(l_extendedprice), 2) AS price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem GROUP BY 1, 2, 3""")
def group_sum_multi(s: Source) -> DataFrame:
    rows = s.lineitem.withColumn("lane", F.col("l_suppkey") % 10)
    return rows.groupBy("l_returnflag", "l_linestatus", "lane").agg(
        F.sum("l_quantity").alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
    )


@check("""
SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days, count(CASE WHEN value > 20 THEN 1 END) AS large
FROM events GROUP BY 1""")
def count_distinct_days(s: Source) -> DataFrame:
    return s.events.groupBy("user_id").agg(
        F.countDistinct(F.to_date("ts")).alias("days"), count_where(F.col("value") > 20).alias("large")
    )


@check("""
SELECT l_suppkey, sum((l_returnflag = 'R')::INT)::BIGINT AS returned, sum((l_returnflag <> 'R')::INT)::BIGINT AS kept,
  sum((l_returnflag = 'R' AND l_linestatus = 'F')::INT)::BIGINT AS returned_closed FROM lineitem GROUP BY 1""")
def indicator_sums(s: Source) -> DataFrame:
    returned, closed = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    return s.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(returned, 1).otherwise(0)).alias("returned"),
        F.sum(F.when(~returned, 1).otherwise(0)).alias("kept"),
        F.sum(F.when(returned & closed, 1).otherwise(0)).alias("returned_closed"),
    )


@check("""
SELECT l_orderkey, l_suppkey, l_returnflag, sum(1)::BIGINT AS tasks, round(sum(l_quantity), 4) AS quantity
FROM lineitem GROUP BY 1, 2, 3""")
def group_dedupe(s: Source) -> DataFrame:
    rows = s.lineitem.withColumn("task", F.lit(1))
    return keyed.group_once(
        rows, ["l_orderkey", "l_suppkey", "l_returnflag"], {"tasks": "task", "quantity": "l_quantity"}
    )


@check("""
SELECT event_id, user_id, 'Pickup' AS task_type, 1 AS pickup, 0 AS pod FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id, 'POD', 0, 1 FROM events WHERE event_type = 'purchase'""")
def union_tasks(s: Source) -> DataFrame:
    def part(kind: str, task: str, pickup: int) -> DataFrame:
        return s.events.where(F.col("event_type") == kind).select(
            "event_id",
            "user_id",
            F.lit(task).alias("task_type"),
            F.lit(pickup).cast("bigint").alias("pickup"),
            F.lit(1 - pickup).cast("bigint").alias("pod"),
        )

    return stack_rows(part("view", "Pickup", 1), part("purchase", "POD", 0))


@check("""
SELECT user_id, count(*) AS errors, CAST(max(ts) + INTERVAL 7 HOUR AS VARCHAR) AS last_error
FROM events e WHERE event_type = 'error'
  AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase'
    AND p.ts > (SELECT max(ts) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error'))
GROUP BY 1 HAVING count(*) >= 2""")
def problem_check(s: Source) -> DataFrame:
    """Users with at least two errors and no purchase after the last one, in one pass."""
    kind, ts = F.col("event_type"), F.col("ts")
    rows = summarise(
        s.events,
        ["user_id"],
        {
            "errors": count_where(kind == "error"),
            "error_at": F.max(F.when(kind == "error", ts)),
            "bought_at": F.max(F.when(kind == "purchase", ts)),
        },
    )
    open_rows = rows.where((F.col("errors") >= 2) & (F.col("bought_at").isNull() | (F.col("bought_at") <= F.col("error_at"))))
    return open_rows.select("user_id", "errors", local_dt("error_at").alias("last_error"))
