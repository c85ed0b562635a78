"""The report marts: functions from input tables and a clock to a lazy DataFrame."""

from parceltrail.plans.cargo import CargoPeriod, cargo_bags, cargo_base, cargo_hubs, cargo_parcels
from parceltrail.plans.courier_incentive import courier_incentive
from parceltrail.plans.daily_report import daily_report
from parceltrail.plans.dwell import longest_dwell, longest_dwell_union
from parceltrail.plans.returns import return_backlog
from parceltrail.plans.seller_performance import seller_performance
from parceltrail.plans.vip_check import vip_problem_check
from parceltrail.plans.vip_revenue import vip_revenue

__all__ = [
    "CargoPeriod",
    "cargo_bags",
    "cargo_base",
    "cargo_hubs",
    "cargo_parcels",
    "courier_incentive",
    "daily_report",
    "longest_dwell",
    "longest_dwell_union",
    "return_backlog",
    "seller_performance",
    "vip_problem_check",
    "vip_revenue",
]
