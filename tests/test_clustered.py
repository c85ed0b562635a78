"""Clustered facts: the same reports, without exchanges and sorts of the facts."""

import re
import uuid

import pytest

from parceltrail import plans
from parceltrail.checks import domain
from parceltrail.plans.daily_report import problem_summary, scan_summary
from parceltrail.sources.clustered import READ_ORDER, HotKey, read_clustered, write_clustered
from parceltrail.sources.tables import SCHEMAS, Tables

FACTS = ["order_order", "waybill_waybill", "waybill_waybill_line", "waybill_problem_piece", "waybill_return_bill"]


@pytest.fixture(scope="module")
def both(spark, sf_dir, tmp_path_factory):
    """(the tables as folders, the same with clustered facts)."""
    root = str(tmp_path_factory.mktemp("facts"))
    t = domain.tables(spark, sf_dir)
    for name in SCHEMAS:
        t[name].coalesce(1).write.parquet(f"{root}/{name}")
    plain = clustered = Tables.from_parquet(spark, root)
    made = []
    for name in FACTS:
        made.append(f"{name}_{uuid.uuid4().hex[:8]}")
        write_clustered(plain[name], made[-1], 4, hot_rows=1 << 40, path=f"{root}/clustered/{name}")
        clustered = clustered.with_table(name, read_clustered(spark, made[-1]))
    yield plain, clustered
    for table in made:
        spark.sql(f"DROP TABLE {table}")
    spark.conf.unset(READ_ORDER)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("summary", [scan_summary, problem_summary])
def test_logs_are_neither_exchanged_nor_sorted(both, summary):
    plain, clustered = both
    got, want = summary(clustered, domain.CLOCK), summary(plain, domain.CLOCK)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = plan_of(got)
    assert "hashpartitioning(waybill_no" not in plan and not re.search(r"Sort \[waybill_no", plan)
    assert "hashpartitioning(waybill_no" in plan_of(want)


@pytest.mark.parametrize("report", [plans.daily_report, plans.return_backlog, plans.longest_dwell])
def test_reports_over_clustered_facts(both, report):
    plain, clustered = both
    got, want = report(clustered, domain.CLOCK), report(plain, domain.CLOCK)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_the_daily_report_exchanges_no_fact(both):
    assert "hashpartitioning(waybill_no" not in plan_of(plans.daily_report(both[1], domain.CLOCK))


def test_hot_keys_are_refused(spark, tmp_path):
    rows = spark.range(100).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS waybill_no")
    with pytest.raises(HotKey, match="'hot' has 34 rows"):
        write_clustered(rows, f"t_{uuid.uuid4().hex}", 2, hot_rows=30, path=str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()
