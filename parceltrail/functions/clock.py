"""The report clock, local dates, look-back filters and boundary-counting differences.

Instants are TIMESTAMP columns in a UTC session; wall clocks are TIMESTAMP_NTZ columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Asia/Jakarta"


@dataclass(frozen=True)
class Clock:
    """One fixed "now" per report, so every today in a plan is the same instant."""

    as_of: datetime
    tz: str = DEFAULT_ZONE

    @classmethod
    def now(cls, tz: str = DEFAULT_ZONE) -> Clock:
        return cls(datetime.now(timezone.utc), tz)

    @classmethod
    def at(cls, text: str, tz: str = DEFAULT_ZONE) -> Clock:
        """From an ISO text; without an offset it is read as UTC."""
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
        return cls(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc), tz)

    @property
    def utc_today(self) -> date:
        return self.as_of.astimezone(timezone.utc).date()

    @property
    def local_today(self) -> date:
        return self.as_of.astimezone(ZoneInfo(self.tz)).date()

    def local_midnight(self, day: date) -> datetime:
        """The instant at which a local day starts."""
        return datetime.combine(day, time(0), ZoneInfo(self.tz)).astimezone(timezone.utc)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_dt(ts: Column | str, tz: str = DEFAULT_ZONE) -> Column:
    """Wall clock of an instant."""
    return F.from_utc_timestamp(_col(ts).cast("timestamp"), tz).cast("timestamp_ntz")


def local_date(ts: Column | str, tz: str = DEFAULT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(_col(ts).cast("timestamp"), tz))


def date_of(value: Column | str) -> Column:
    """Calendar date of an instant (UTC) or of a wall clock."""
    return F.to_date(_col(value))


def local_time_text(ts: Column | str, tz: str = DEFAULT_ZONE) -> Column:
    """Time of day as HH:mm:ss text, which compares like a time."""
    return F.date_format(F.from_utc_timestamp(_col(ts).cast("timestamp"), tz), "HH:mm:ss")


def past_cutoff(ts: Column | str, cutoff: str, tz: str = DEFAULT_ZONE) -> Column:
    """1 from the local cut-off time on, else 0; a missing time counts as before."""
    return F.when(local_time_text(ts, tz) >= F.lit(cutoff), 1).otherwise(0)


def recent(ts: Column | str, days: int, clock: Clock, partition_date: Column | str | None = None) -> Column:
    """Local date within `days` of the UTC today.

    The bound on the raw instant beside the date test is what reaches the Parquet scan. `partition_date` names a
    UTC-date partition column, if the table has one, for static partition pruning.
    """
    first_day = clock.utc_today - timedelta(days=days)
    start = clock.local_midnight(first_day)
    test = (_col(ts).cast("timestamp") >= F.lit(start)) & (local_date(ts, clock.tz) >= F.lit(first_day))
    if partition_date is not None:
        test = (_col(partition_date) >= F.lit(start.date())) & test
    return test


def band(value: Column | str, oldest: int, newest: int, clock: Clock) -> Column:
    """Date between `oldest` and `newest` days before the UTC today, both included."""
    return _col(value).between(
        F.lit(clock.utc_today - timedelta(days=oldest)), F.lit(clock.utc_today - timedelta(days=newest))
    )


def utc_range(ts: Column | str, first: date | str, last: date | str) -> Column:
    """UTC date between two days, both included, as a half-open instant range that the scan can use."""
    first, last = (date.fromisoformat(d) if isinstance(d, str) else d for d in (first, last))
    start = datetime.combine(first, time(0), timezone.utc)
    end = datetime.combine(last + timedelta(days=1), time(0), timezone.utc)
    instant = _col(ts).cast("timestamp")
    return (instant >= F.lit(start)) & (instant < F.lit(end))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Day boundaries crossed."""
    return F.datediff(F.to_date(_col(later)), F.to_date(_col(earlier)))


def hours_crossed(later: Column | str, earlier: Column | str) -> Column:
    """Hour boundaries crossed: 1 from 00:59 to 01:01."""

    def hour(c: Column | str) -> Column:
        return F.unix_seconds(F.date_trunc("HOUR", _col(c).cast("timestamp")))

    return ((hour(later) - hour(earlier)) / 3600).cast("bigint")


def seconds_crossed(later: Column | str, earlier: Column | str) -> Column:
    return F.unix_seconds(_col(later).cast("timestamp")) - F.unix_seconds(_col(earlier).cast("timestamp"))


def plus_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days if isinstance(days, int) else days.cast("int"))


def utc_deadline(ts: Column | str, days: Column) -> Column:
    """UTC date of an instant moved by a number of days."""
    return plus_days(F.to_date(_col(ts).cast("timestamp")), days)


def month_label(day: Column) -> Column:
    """Short month and year, such as Mar 2024."""
    return F.date_format(day, "MMM yyyy")


def sheet_date(text: Column | str) -> Column:
    """MM/DD/YYYY text to a date; one-digit months and days are accepted."""
    return F.to_date(_col(text), "M/d/yyyy")
