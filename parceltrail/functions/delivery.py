"""Delivery service levels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from parceltrail.functions.clock import DEFAULT_ZONE, local_date, plus_days, utc_deadline
from parceltrail.functions.rules import first_match

# Sources whose deadline comes from the price list, and the day count that means "no agreed level".
PRICE_LIST_SOURCES = ["Blibli", "pt fashion marketplace indonesia", "pt fashion eservices indonesia"]
NO_SLA_DAYS = 999
SIGNED = "Signed"


def uses_price_list(source: Column) -> Column:
    return source.isin(*PRICE_LIST_SOURCES)


def sla_days(source: Column, price_days: Column, city_days: Column) -> Column:
    return F.when(uses_price_list(source), price_days).otherwise(city_days)


def sla_deadline(
    source: Column, shipped: Column, price_days: Column, city_days: Column, tz: str = DEFAULT_ZONE
) -> Column:
    """Estimated deadline: UTC-based for price-list sources, local for the rest."""
    return F.when(uses_price_list(source), utc_deadline(shipped, price_days)).otherwise(
        plus_days(local_date(shipped, tz), city_days)
    )


def lead_bucket(days: Column) -> Column:
    return first_match(
        [
            (days < 1, "0 Hari"),
            (days == 1, "1 Hari"),
            (days <= 3, "2-3 Hari"),
            (days <= 5, "4-5 Hari"),
            (days <= 7, "6-7 Hari"),
            (days > 7, "7 Hari+"),
        ]
    )


def sla_hit(lead_days: Column, allowed_days: Column) -> Column:
    return F.when(lead_days <= allowed_days, "Hit SLA").when(lead_days > allowed_days, "Not Hit")


def sla_performance(
    source: Column,
    shipped: Column,
    delivered: Column,
    price_days: Column,
    city_days: Column,
    today: date,
    tz: str = DEFAULT_ZONE,
    local_deadline: bool = False,
) -> Column:
    """Full delivery result; `shipped` and `delivered` are instants.

    The deadline is a UTC date compared with local dates; `local_deadline` uses the local date instead.
    """
    days = sla_days(source, price_days, city_days)
    due = plus_days(local_date(shipped, tz), days) if local_deadline else utc_deadline(shipped, days)
    done = local_date(delivered, tz)
    result = first_match(
        [
            (days >= NO_SLA_DAYS, "No SLA (OoC)"),
            (~uses_price_list(source) & days.isNull(), "Hit SLA"),
            (done > due, "Not Hit"),
            (done <= due, "Hit SLA"),
            (done.isNull() & (F.lit(today) > due), "Not Hit"),
        ]
    )
    return F.when(source.isNotNull(), result)


def cod_type(amount: Column, missing_is_non_cod: bool) -> Column:
    kind = F.when(amount > 0, "COD")
    return kind.otherwise("Non COD") if missing_is_non_cod else kind.when(amount == 0, "Non COD")


def delivered_flag(status: Column, delivered: Column) -> Column:
    return F.when((status == SIGNED) | delivered.isNotNull(), "Delivered")
