"""The report marts as checkable queries over the derived parcel tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parceltrail import plans
from parceltrail.checks import mart_sql
from parceltrail.checks.compare import comparable
from parceltrail.checks.domain import CLOCK, tables
from parceltrail.session import prepare
from parceltrail.sources.tables import Tables

PERIOD = plans.CargoPeriod(**mart_sql.CARGO_PERIOD)


def _union(t: Tables) -> DataFrame:
    return plans.longest_dwell_union(
        plans.longest_dwell(t, CLOCK, returned=False), plans.longest_dwell(t, CLOCK, returned=True), CLOCK
    )


def _bags(t: Tables) -> DataFrame:
    return plans.cargo_bags(plans.cargo_hubs(t), plans.cargo_base(t, PERIOD, ordered=False))


def _parcels(t: Tables) -> DataFrame:
    return plans.cargo_parcels(t["smu_template_2"], plans.cargo_base(t, PERIOD, ordered=False))


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "mart_daily_report": lambda t: plans.daily_report(t, CLOCK),
    "mart_courier_incentive": lambda t: plans.courier_incentive(t, CLOCK),
    "mart_longest_dwell_forward": lambda t: plans.longest_dwell(t, CLOCK, returned=False),
    "mart_longest_dwell_returned": lambda t: plans.longest_dwell(t, CLOCK, returned=True),
    "mart_longest_dwell_union": _union,
    "mart_return_backlog": lambda t: plans.return_backlog(t, CLOCK),
    "mart_vip_revenue": lambda t: plans.vip_revenue(t, CLOCK),
    "mart_cargo_base": lambda t: plans.cargo_base(t, PERIOD),
    "mart_cargo_hubs": plans.cargo_hubs,
    "mart_cargo_bags": _bags,
    "mart_cargo_parcels": _parcels,
    "mart_seller_performance": lambda t: plans.seller_performance(t, CLOCK, username=mart_sql.SELLER),
    "mart_seller_performance_all": lambda t: plans.seller_performance(t, CLOCK),
    "mart_vip_problem_check": lambda t: plans.vip_problem_check(t, CLOCK),
}


def _query(mart: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(mart(tables(prepare(spark), sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(mart) for name, mart in MARTS.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "mart_daily_report": mart_sql.daily(),
        "mart_courier_incentive": mart_sql.courier_incentive(),
        "mart_longest_dwell_forward": mart_sql.dwell(False),
        "mart_longest_dwell_returned": mart_sql.dwell(True),
        "mart_longest_dwell_union": mart_sql.dwell_union(),
        "mart_return_backlog": mart_sql.return_backlog(),
        "mart_vip_revenue": mart_sql.vip_revenue(),
        "mart_cargo_base": mart_sql.cargo_base(),
        "mart_cargo_hubs": mart_sql.cargo_hubs(),
        "mart_cargo_bags": mart_sql.cargo_bags(),
        "mart_cargo_parcels": mart_sql.cargo_parcels(),
        "mart_seller_performance": mart_sql.seller(mart_sql.SELLER),
        "mart_seller_performance_all": mart_sql.seller(None),
        "mart_vip_problem_check": mart_sql.vip_problem_check(),
    }
