"""Small scalar conversions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,9)"


def numeric(c: Column) -> Column:
    """Fixed-point number with 9 decimals."""
    return c.cast(MONEY)


def safe_int(c: Column) -> Column:
    """Whole number from text, NULL for anything else."""
    return c.try_cast("bigint")


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def sentinel_pick(value: Column, missing: int | str, fallback: Column) -> Column:
    """The fallback when the value equals its "missing" mark; a NULL value stays NULL."""
    return F.when(value == F.lit(missing), fallback).otherwise(value)


def joined(*parts: Column | str, sep: str = " - ") -> Column:
    """Parts with a separator between them; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(F.col(part) if isinstance(part, str) else part)
    return F.concat(*pieces)


def flag(test: Column) -> Column:
    """1 when the test holds, else 0 (also for NULL)."""
    return F.when(test, 1).otherwise(0)


def exactly_one(*values: Column) -> Column:
    """The only non-NULL value; NULL when none or several are set."""
    set_count = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return F.when(set_count == 1, F.coalesce(*values))
