"""Time helpers. All timestamps are UTC instants; literals carry their offset."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(value: dt.datetime | str) -> dt.datetime:
    """Aware UTC datetime from an aware or naive (taken as UTC) one, or an ISO string."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)


def ts(value: dt.datetime | str) -> Column:
    """Timestamp literal that does not depend on the session or Python time zone."""
    return F.expr(f"timestamp'{as_utc(value):%Y-%m-%d %H:%M:%S.%f}+00:00'")


def day(value: dt.datetime | str) -> Column:
    return F.lit(as_utc(value).date())


@dataclass(frozen=True)
class Interval:
    """A processing interval ``[start, end]``; each predicate says which ends it includes."""

    start: dt.datetime
    end: dt.datetime

    @classmethod
    def of(cls, start: dt.datetime | str, end: dt.datetime | str) -> "Interval":
        return cls(as_utc(start), as_utc(end))

    def strictly_inside(self, column: Column) -> Column:
        return (column > ts(self.start)) & (column < ts(self.end))

    def covers(self, column: Column) -> Column:
        return column.between(ts(self.start), ts(self.end))

    def dates_of(self, column: Column) -> Column:
        """Predicate on a date partition column that keeps every day the interval touches."""
        return column.between(day(self.start), day(self.end))


def seconds_between(earlier: Column, later: Column) -> Column:
    """Signed difference in seconds as a double, exact to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 1000000


def days_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 86400000000


def same_day_range(column: Column, moment: dt.datetime | str) -> Column:
    """Calendar-day equality written as a half-open range; row groups prune by it, partitions by
    the days that ``Warehouse.read`` is given."""
    start = as_utc(moment).replace(hour=0, minute=0, second=0, microsecond=0)
    return (column >= ts(start)) & (column < ts(start + dt.timedelta(days=1)))


def to_zone(column: Column, zone_from: str = "UTC", zone_to: str = "Europe/Zurich") -> Column:
    """Wall-clock time in another zone, as ``timestamp_ntz``."""
    return F.convert_timezone(F.lit(zone_from), F.lit(zone_to), column.cast("timestamp_ntz"))
