"""Date differences that count calendar boundaries crossed, not complete units.

00:59 to 01:01 is one hour, 31 December to 1 January is one year. All of them are
wall-clock arithmetic, so they do not depend on the session time zone and stay
inside generated code.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = str | date | datetime | Column


def as_of_timestamp(as_of: AsOf) -> Column:
    """The instant that stands for "now"; passed in so results can be repeated."""
    value = as_of if isinstance(as_of, Column) else F.lit(str(as_of))
    return value.cast("timestamp_ntz")


def as_of_date(as_of: AsOf) -> Column:
    return as_of_timestamp(as_of).cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return days_between(start, end) * 24 + (F.hour(end) - F.hour(start))


def months_between_boundaries(start: Column, end: Column) -> Column:
    return ((F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))).cast("bigint")


def years_between(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)).cast("bigint")


def add_months_keeping_time(start: Column, months: Column) -> Column:
    """Move by calendar months from ``start``; month ends are clamped."""
    return start + F.make_ym_interval(F.lit(0), months.cast("int"))


def whole_months_between(start: Column, end: Column) -> Column:
    """Largest ``i`` such that ``start`` plus ``i`` months is not after ``end``."""
    crossed = months_between_boundaries(start, end)
    return crossed - F.when(add_months_keeping_time(start, crossed) > end, 1).otherwise(0)
