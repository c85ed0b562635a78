"""Refreshed marts equal whole ones, and only the partitions of parcels with new rows are written."""

from datetime import timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from parceltrail import checks
from parceltrail.checks import domain
from parceltrail.jobs import REFRESHED, REPORTS, run
from parceltrail.refresh import FACTS
from parceltrail.sources.tables import SCHEMAS, Tables, read_mart
from test_jobs import options, rows_of

NEW = "RFR1"


@pytest.fixture
def inputs(spark, sf_dir, tmp_path):
    root = str(tmp_path / "in")
    t = domain.tables(spark, sf_dir)
    for name in SCHEMAS:
        t[name].coalesce(1).write.parquet(f"{root}/{name}")
    return root


def files(spark, path):
    """Files of each partition."""
    found = {}
    rows = read_mart(spark, path).select("mart_date", F.col("_metadata.file_path").alias("f")).distinct().collect()
    for row in rows:
        found.setdefault(row["mart_date"], set()).add(row["f"])
    return found


def append(spark, root, name, rows):
    rows.select(*SCHEMAS[name].fieldNames()).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def whole(spark, root, name, opts):
    report, day = REPORTS[name]
    return report(Tables.from_parquet(spark, root), domain.CLOCK, None, opts).withColumn("mart_date", F.to_date(day))


@pytest.mark.parametrize("name", sorted(REFRESHED))
def test_late_rows(spark, inputs, tmp_path, name):
    opts = options(inputs, str(tmp_path / "marts"), incremental=True)
    target = f"{tmp_path}/marts/{name}"
    run(spark, name, opts)
    first = files(spark, target)
    run(spark, name, opts)
    assert files(spark, target) == first, "nothing came in, nothing is written"

    t = Tables.from_parquet(spark, inputs)
    mart = read_mart(spark, target)
    some = [r.waybill_no for r in mart.where("waybill_no is not null").select("waybill_no").distinct().orderBy("waybill_no").limit(4).collect()]
    gone, moved, scanned, backs = some
    versions = lambda key: t["waybill_waybill"].where(F.col("waybill_no") == key)
    later = F.col("update_time") + F.expr("INTERVAL 200 DAYS")
    # A parcel becomes void, one is shipped on another day, one has a late scan, one a new return bill.
    append(spark, inputs, "waybill_waybill", versions(gone).withColumns({"void_flag": F.lit("1"), "update_time": later}))
    shipped = F.col("shipping_time") - F.expr("INTERVAL 1 DAY")
    append(spark, inputs, "waybill_waybill", versions(moved).withColumns({"shipping_time": shipped, "update_time": later}))
    scans = t["waybill_waybill_line"].where(F.col("waybill_no") == scanned)
    append(spark, inputs, "waybill_waybill_line", scans.withColumn("record_time", F.col("record_time") - F.expr("INTERVAL 30 DAYS")))
    bills = t["waybill_return_bill"].limit(1).withColumns({
        "waybill_no": F.lit(backs), "update_time": F.lit(domain.CLOCK.as_of - timedelta(days=3)),
        "return_record_time": F.lit(domain.CLOCK.as_of - timedelta(days=4)), "return_pod_record_time": F.lit(None).cast("timestamp"),
    })
    append(spark, inputs, "waybill_return_bill", bills)
    if name == "daily_report":  # orders without a parcel number are one parcel
        orders = t["order_order"].where("waybill_no is null").limit(1)
        append(spark, inputs, "order_order", orders.withColumn("input_time", F.lit(domain.CLOCK.as_of)))
    run(spark, name, opts)
    want = whole(spark, inputs, name, opts)
    assert rows_of(read_mart(spark, target), want.columns) == rows_of(want)
    second = files(spark, target)
    same = [day for day in first if second.get(day) == first[day]]
    assert second != first and len(same) > len(first) // 3, "other partitions keep their files"


def test_whole_marts_are_written_where_they_must_be(spark, inputs, tmp_path):
    marts, name = str(tmp_path / "marts"), "return_backlog"
    target = f"{marts}/{name}"
    run(spark, name, options(inputs, marts, incremental=True))
    first = files(spark, target)
    # Another day.
    run(spark, name, options(inputs, marts, incremental=True, as_of="2024-02-01T03:00:00Z"))
    day = files(spark, target)
    assert not set.union(*first.values()) & set.union(*day.values())
    # A dimension changed.
    append(spark, inputs, "return_type", spark.createDataFrame([(77, "New type", 0)], SCHEMAS["return_type"]))
    run(spark, name, options(inputs, marts, incremental=True, as_of="2024-02-01T03:00:00Z"))
    assert not set.union(*day.values()) & set.union(*files(spark, target).values())


def test_all_facts_are_by_parcel():
    assert {"order_order", "waybill_waybill", "waybill_waybill_line", "waybill_problem_piece", "waybill_return_bill"} <= set(FACTS)


def test_check_derives_each_table_once(spark, sf_dir, monkeypatch):
    """The rows that come in later are read from what was written with the others, not derived from the test tables again."""
    derived, plain = [], DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        derived.extend(f for f in self._df.inputFiles() if f.endswith("/lineitem.parquet"))
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert checks.queries()["mart_refreshed"](spark, sf_dir).count() > 0
    assert len(derived) == 1
