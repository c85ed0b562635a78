"""Every operator and report as a query, with the SQL it is compared to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parceltrail.checks import io_checks, join_checks, keyed_checks, marts, rule_checks

_PARTS = [keyed_checks.registry, join_checks.registry, rule_checks.registry, io_checks.registry]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = marts.queries()
    for part in _PARTS:
        found.update(part.queries)
    return found


def oracle_sql() -> dict[str, str]:
    found = marts.oracle_sql()
    for part in _PARTS:
        found.update(part.sql)
    return found
