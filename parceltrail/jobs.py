"""Run one report as a Spark job and store it as a mart.

    spark-submit parceltrail/jobs.py daily_report --tables /data/parcels --marts /data/marts
    spark-submit parceltrail/jobs.py longest_dwell_union --tables /data/parcels --marts /data/marts

Reports that build on stored marts (the dwell union, the cargo sheet reports) read them from the same mart folder. With
`--incremental`, marts of single parcels are refreshed: see parceltrail/refresh.py. Rows of the cargo sheet that its schema
can't parse are stored beside the marts, in `smu_template_2_rejected`.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parceltrail import plans
from parceltrail.functions.clock import DEFAULT_ZONE, Clock
from parceltrail.functions.pickup import SELLER_PORTAL
from parceltrail.plans.dwell import MART_DATE
from parceltrail.refresh import day_of, refresh
from parceltrail.session import prepare
from parceltrail.sources.sheets import SHEET, read_sheet, rejected_rows
from parceltrail.sources.tables import Tables, read_mart, write_mart

Stored = Callable[[str], DataFrame]

# name -> (report from tables, clock, stored marts and options; date column to partition the mart by)
REPORTS: dict[str, tuple[Callable[[Tables, Clock, Stored, argparse.Namespace], DataFrame], str | None]] = {
    "daily_report": (lambda t, c, stored, o: plans.daily_report(t, c), "waktu_input"),
    "courier_incentive": (lambda t, c, stored, o: plans.courier_incentive(t, c), "tgl_tugas"),
    "longest_dwell_forward": (lambda t, c, stored, o: plans.longest_dwell(t, c, returned=False, hot_rows=o.hot_rows), "shipping_time"),
    "longest_dwell_returned": (lambda t, c, stored, o: plans.longest_dwell(t, c, returned=True, hot_rows=o.hot_rows), "shipping_time"),
    "longest_dwell_union": (
        lambda t, c, stored, o: plans.longest_dwell_union(
            stored("longest_dwell_forward"), stored("longest_dwell_returned"), c
        ),
        "shipping_time",
    ),
    "return_backlog": (lambda t, c, stored, o: plans.return_backlog(t, c), "return_regist_time"),
    "vip_revenue": (lambda t, c, stored, o: plans.vip_revenue(t, c), "shipping_date"),
    "seller_performance": (
        lambda t, c, stored, o: plans.seller_performance(t, c, source=o.source, username=o.username),
        "input_time",
    ),
    "vip_problem_check": (lambda t, c, stored, o: plans.vip_problem_check(t, c, min_problems=o.min_problems), None),
    "cargo_base": (lambda t, c, stored, o: plans.cargo_base(t, period(o), c.tz, ordered=False), "record_time"),
    "cargo_hubs": (lambda t, c, stored, o: plans.cargo_hubs(t), None),
    "cargo_bags": (
        lambda t, c, stored, o: plans.cargo_bags(stored("cargo_hubs"), stored("cargo_base").drop(PARTITION)),
        None,
    ),
    "cargo_parcels": (
        lambda t, c, stored, o: plans.cargo_parcels(t["smu_template_2"], stored("cargo_base").drop(PARTITION)),
        None,
    ),
}
PARTITION = MART_DATE

# Reports of single parcels, and the tables that they read: these can be refreshed.
_DWELL = ["waybill_waybill", "waybill_return_bill", "waybill_waybill_line", "system_option"]
REFRESHED: dict[str, list[str]] = {
    "longest_dwell_forward": _DWELL,
    "longest_dwell_returned": _DWELL,
    "return_backlog": ["waybill_waybill", "waybill_return_bill", "system_option", "return_type", "mapping_kanwil_area"],
    "daily_report": [
        "order_order",
        "waybill_waybill",
        "waybill_return_bill",
        "waybill_waybill_line",
        "waybill_problem_piece",
        "system_option",
        "res_problem_package",
        "mapping_kanwil_area",
        "masterdata_sla_shopee",
        "masterdata_city_mapping_area_island_new",
        "return_type",
    ],
}


def period(options: argparse.Namespace) -> plans.CargoPeriod:
    """The cargo period: the days given, the others as they are by default."""
    given = {f.name: getattr(options, f.name) for f in fields(plans.CargoPeriod) if getattr(options, f.name)}
    return plans.CargoPeriod(**given)


def tables(spark: SparkSession, options: argparse.Namespace) -> Tables:
    """The input tables, each read when the report asks for it."""
    dated = dict(pair.split("=", 1) for pair in options.dated)
    t = Tables.from_parquet(spark, options.tables, dated=dated) if options.tables else Tables({})
    for name, frame in Tables.from_catalog(spark, dict(pair.split("=", 1) for pair in options.catalog)).sources():
        t = t.with_table(name, frame)
    return t.with_table(SHEET, lambda: read_sheet(spark, options.sheet)) if options.sheet else t


def run(spark: SparkSession, name: str, options: argparse.Namespace) -> None:
    prepare(spark)
    clock = Clock.at(options.as_of, options.zone) if options.as_of else Clock.now(options.zone)
    t = tables(spark, options)
    if options.check_keys:
        t.check_unique()

    def stored(mart: str) -> DataFrame:
        return read_mart(spark, f"{options.marts}/{mart}")

    if options.sheet:
        write_mart(rejected_rows(spark, options.sheet), f"{options.marts}/{SHEET}_rejected")
    report, day = REPORTS[name]
    target = f"{options.marts}/{name}"

    def rows(tables_read: Tables) -> DataFrame:
        found = report(tables_read, clock, stored, options)
        return found if day is None else found.withColumn(PARTITION, F.to_date(day))

    if options.incremental and name in REFRESHED:
        refresh(t, REFRESHED[name], rows, target, PARTITION, f"{options.marts}/_refresh/{name}", day_of(clock))
    else:
        write_mart(rows(t), target, [PARTITION] if day is not None else [])


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("report", choices=sorted(REPORTS))
    parser.add_argument("--tables", help="folder with one Parquet folder per table")
    parser.add_argument("--catalog", action="append", default=[], metavar="NAME=TABLE", help="catalog table for an input")
    parser.add_argument(
        "--dated", action="append", default=[], metavar="NAME=TIME", help="input partitioned by the UTC date of a time"
    )
    parser.add_argument("--marts", required=True, help="folder the marts are stored in")
    parser.add_argument("--as-of", help="ISO instant the report is for; default now")
    parser.add_argument("--zone", default=DEFAULT_ZONE)
    parser.add_argument("--sheet", help="CSV export of the cargo sheet")
    parser.add_argument("--username", help="seller account of the seller report; all accounts without it")
    parser.add_argument("--source", default=SELLER_PORTAL, help="order source of the seller report")
    parser.add_argument("--min-problems", type=int, default=2, help="problem scans from which a parcel is reported")
    for field in fields(plans.CargoPeriod):
        parser.add_argument(f"--{field.name.replace('_', '-')}", help=f"cargo period, UTC day; default {field.default}")
    parser.add_argument(
        "--hot-rows", type=int, default=10_000_000, help="scans of a parcel in one hour from which they are split further"
    )
    parser.add_argument("--incremental", action="store_true", help="rewrite only partitions of parcels with new rows")
    parser.add_argument("--check-keys", action="store_true", help="fail on dimensions with repeated keys")
    options = parser.parse_args(arguments)
    run(SparkSession.builder.appName(f"parceltrail {options.report}").getOrCreate(), options.report, options)


if __name__ == "__main__":
    main()
