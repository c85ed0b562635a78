"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import options, table, utc
from parceltrail import plans
from parceltrail.checks import domain
from parceltrail.checks.marts import MARTS
from parceltrail.functions.clock import Clock
from parceltrail.operators.keyed import latest_per_key
from parceltrail.plans.daily_report import scan_summary
from parceltrail.sources.tables import SCHEMAS, Tables, utc_date_column


@pytest.fixture(autouse=True)
def untruncated(spark):
    wide = {"spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "1000"}
    for key, value in wide.items():
        spark.conf.set(key, value)
    yield
    for key in wide:
        spark.conf.unset(key)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(MARTS))
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    plan = plan_of(MARTS[name](domain.tables(spark, sf_dir)))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


def test_version_pick_is_cut_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 3 AS k", "id AS v")
    plan = plan_of(latest_per_key(rows, ["k"], "v"))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_scan_log_is_pruned_pushed_down_and_pre_aggregated(spark, tmp_path):
    for name in ("waybill_waybill_line", "system_option", "res_problem_package"):
        table(spark, name, []).write.parquet(str(tmp_path / name))
    t = Tables.from_parquet(spark, str(tmp_path), ["waybill_waybill_line", "system_option", "res_problem_package"])
    plan = plan_of(scan_summary(t, Clock.at("2024-01-31T03:00:00Z")))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "waybill_waybill_line" in line)
    assert "GreaterThanOrEqual(record_time" in scan
    assert "bag_no" not in scan and "vehicle_tag_no" not in scan
    assert len(re.findall(r"Exchange hashpartitioning\(waybill_no", plan)) == 1
    assert "partial_max" in plan[plan.index("Exchange hashpartitioning") :]


def test_daily_report_shuffles_each_fact_once(spark, tmp_path):
    from parceltrail.plans import daily_report

    for name in SCHEMAS:
        table(spark, name, []).write.parquet(str(tmp_path / name))
    rows = table(spark, "order_order", [{"waybill_no": "A", "input_time": utc("2024-01-30 00:00:00")}])
    t = Tables.from_parquet(spark, str(tmp_path)).with_table("order_order", rows)
    report = daily_report(t, Clock.at("2024-01-31T03:00:00Z"))
    plan = plan_of(report.where(F.lit(True)))
    facts = ["waybill_waybill_line", "waybill_problem_piece", "waybill_waybill", "waybill_return_bill"]
    assert all(name in plan for name in facts)
    assert "coalesce(waybill_no" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))


def empty_tables(spark, tmp_path, **dated):
    for name in SCHEMAS:
        known = options(**domain._OPTIONS) if name == "system_option" else []
        rows = table(spark, name, [{dated[name]: utc("2024-01-30 00:00:00")}] if name in dated else known)
        if name in dated:
            rows = rows.withColumn(utc_date_column(dated[name]), F.to_date(dated[name]))
            rows.write.partitionBy(utc_date_column(dated[name])).parquet(str(tmp_path / name))
        else:
            rows.write.parquet(str(tmp_path / name))
    return Tables.from_parquet(spark, str(tmp_path), dated=dated)


def test_dwell_reads_the_log_once_and_splits_hot_parcels_by_bucket(spark, tmp_path):
    t = empty_tables(spark, tmp_path)
    plan = plan_of(plans.longest_dwell(t, domain.CLOCK))
    assert plan.count("FileScan parquet [waybill_no") - plan.count("waybill_waybill]") - plan.count("waybill_return_bill]") == 1
    assert re.search(r"hashpartitioning\(waybill_no#\d+, __bucket#\d+, \d+\), REPARTITION", plan)
    assert "__hot_" not in plan
    split = plan_of(plans.longest_dwell(t, domain.CLOCK, hot_rows=1_000_000))
    assert re.search(r"hashpartitioning\(waybill_no#\d+, __bucket#\d+, __cut#\d+, \d+\), REPARTITION", split)


DATED = {
    "order_order": "input_time",
    "waybill_waybill": "shipping_time",
    "dm_waybill_waybill": "shipping_time",
    "waybill_waybill_line": "record_time",
    "waybill_problem_piece": "operation_time",
    "waybill_return_bill": "update_time",
}


@pytest.mark.parametrize("name", ["mart_daily_report", "mart_vip_revenue", "mart_cargo_base", "mart_vip_problem_check", "mart_longest_dwell_forward"])
def test_look_backs_prune_date_partitions(spark, tmp_path, name):
    plan = plan_of(MARTS[name](empty_tables(spark, tmp_path, **DATED)))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "_utc_date" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*_utc_date", line) for line in scans)


def test_dated_tables_give_the_same_reports(spark, sf_dir, tmp_path):
    t = domain.tables(spark, sf_dir)
    for name in SCHEMAS:
        writer = t[name]
        if name in DATED:
            day = utc_date_column(DATED[name])
            writer.withColumn(day, F.to_date(DATED[name])).coalesce(1).write.partitionBy(day).parquet(str(tmp_path / name))
        else:
            writer.write.parquet(str(tmp_path / name))
    dated = Tables.from_parquet(spark, str(tmp_path), dated=DATED)
    for name in ("mart_return_backlog", "mart_cargo_base"):
        got, want = MARTS[name](dated), MARTS[name](t)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stored_dwell_marts_are_pruned(spark, sf_dir, tmp_path):
    half = plans.longest_dwell(domain.tables(spark, sf_dir), domain.CLOCK)
    half.withColumn("mart_date", F.to_date("shipping_time")).write.partitionBy("mart_date").parquet(str(tmp_path / "half"))
    stored = spark.read.parquet(str(tmp_path / "half"))
    plan = plan_of(plans.longest_dwell_union(stored, stored, domain.CLOCK))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(mart_date" in line for line in scans)


@pytest.mark.parametrize("name", sorted(MARTS))
def test_no_exchange_on_a_code_column(spark, tmp_path, name):
    plan = plan_of(MARTS[name](empty_tables(spark, tmp_path)))
    codes = "operation_type|problem_type|waybill_source|waybill_status|order_source|order_status|service_type|express_type"
    assert not re.search(rf"hashpartitioning\((?:{codes})#\d+, \d+\)", plan)
