"""Sources and sinks as queries: a sheet as CSV, a mart written and read back.

Files go below the cluster's shared folder (spark.checkpoint.dir); a local session without one gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail import plans, refresh
from parceltrail.checks import mart_sql
from parceltrail.checks.keyed_checks import STAR_SQL, one_pass_summary
from parceltrail.checks.compare import typed
from parceltrail.checks.domain import CLOCK, tables, with_tables
from parceltrail.checks.registry import Registry, Source
from parceltrail.sources.clustered import read_clustered, write_clustered
from parceltrail.sources.sheets import read_sheet, rejected_rows
from parceltrail.sources.tables import Tables, read_mart, write_mart

registry = Registry()


def folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="checks-")
    return f"{shared.rstrip('/')}/checks-{uuid.uuid4().hex}"


@registry.check(
    f"{with_tables('smu_template_2')} "
    + typed("SELECT * FROM smu_template_2", [], ["smu_weight", "total_smu_fee"], ["no_of_packages"])
)
def sheet_read(s: Source) -> DataFrame:
    path = folder(s.spark)
    tables(s.spark, s.sf_dir)["smu_template_2"].write.csv(path, header=True)
    return read_sheet(s.spark, path)


_SPOILED = "bm_code LIKE 'BM_' AND vm_code IS NOT NULL"


@registry.check(
    f"""{with_tables('smu_template_2')}
SELECT smu_booking_code, CASE WHEN vm_code = 'VM0' THEN 'report_date is no date' WHEN vm_code = 'VM1' THEN 'total_smu_fee is no number'
  ELSE 'no_of_packages is no number; report_date is no date' END AS reason
FROM smu_template_2 WHERE {_SPOILED}"""
)
def sheet_rejects(s: Source) -> DataFrame:
    """Some cells of the sheet are spoiled before it is written; exactly their rows are reported, cell by cell."""
    path, vehicle = folder(s.spark), F.col("vm_code")
    sheet = tables(s.spark, s.sf_dir)["smu_template_2"]
    spoiled = F.expr(_SPOILED)
    cells = {
        "report_date": F.when(spoiled & (vehicle != "VM1"), "31/31/2023").otherwise(F.col("report_date")),
        "total_smu_fee": F.when(spoiled & (vehicle == "VM1"), "1,5 kg").otherwise(F.col("total_smu_fee").cast("string")),
        "no_of_packages": F.when(spoiled & ~vehicle.isin("VM0", "VM1"), "two").otherwise(F.col("no_of_packages").cast("string")),
    }
    sheet.withColumns(cells).write.csv(path, header=True)
    code = F.regexp_extract("line", "SMU[0-9]+", 0).alias("smu_booking_code")
    return rejected_rows(s.spark, path).select(code, "reason")


@registry.check(mart_sql.return_backlog())
def mart_write_read(s: Source) -> DataFrame:
    path = folder(s.spark)
    report = plans.return_backlog(tables(s.spark, s.sf_dir), CLOCK)
    write_mart(report.withColumn("mart_date", F.to_date("return_regist_time")), path, ["mart_date"])
    return read_mart(s.spark, path).drop("mart_date")


@registry.check(mart_sql.dwell_union())
def dwell_union_of_stored_marts(s: Source) -> DataFrame:
    path, t = folder(s.spark), tables(s.spark, s.sf_dir)
    for half in (False, True):
        rows = plans.longest_dwell(t, CLOCK, returned=half)
        write_mart(rows.withColumn("mart_date", F.to_date("shipping_time")), f"{path}/{half}", ["mart_date"])
    forward, returned = (read_mart(s.spark, f"{path}/{half}") for half in (False, True))
    return plans.longest_dwell_union(forward, returned, CLOCK)


@registry.check(mart_sql.dwell(False))
def mart_refreshed(s: Source) -> DataFrame:
    """A mart stored from part of the facts and refreshed after the rest came in, scans of all times and versions of parcels.

    Each table is derived once: its rows are written in two parts, of which the second comes in later.
    """
    path, t = folder(s.spark), tables(s.spark, s.sf_dir)
    names = ["waybill_waybill", "waybill_return_bill", "waybill_waybill_line", "system_option"]
    late = {"waybill_waybill_line": F.col("photo_url").endswith("3"), "waybill_waybill": F.xxhash64("waybill_no", "update_time") % 7 == 0}
    for name in names:
        rows = t[name].withColumn("late", F.coalesce(late.get(name, F.lit(False)), F.lit(False)))
        rows.write.partitionBy("late").parquet(f"{path}/in/{name}")
    first, rest = ({name: f"{path}/in/{name}/late={part}" for name in names} for part in ("false", "true"))
    for part in [*first.values(), *rest.values()]:
        refresh.make_folder(s.spark, part)  # a part without rows has none
    for name in [None, *late]:
        if name:
            came = Tables.from_parquet(s.spark, path, [name], paths=rest)
            came[name].write.mode("append").parquet(first[name])
        stored = Tables.from_parquet(s.spark, path, names, paths=first)
        rows = lambda part: plans.longest_dwell(part, CLOCK).withColumn("mart_date", F.to_date("shipping_time"))
        refresh.refresh(stored, names, rows, f"{path}/mart", "mart_date", f"{path}/state", refresh.day_of(CLOCK))
    return read_mart(s.spark, f"{path}/mart").drop("mart_date")


@registry.check(STAR_SQL)
def clustered_log_summary(s: Source) -> DataFrame:
    """The one-pass summary over a log clustered by its key: no exchange and no sort."""
    table = f"clustered_{uuid.uuid4().hex}"
    write_clustered(s.events, table, 8, hot_rows=1 << 40, key="user_id", path=folder(s.spark))
    rows = one_pass_summary(read_clustered(s.spark, table))
    rows.schema  # resolved here: the external files stay when the name goes
    s.spark.sql(f"DROP TABLE {table}")
    return rows
