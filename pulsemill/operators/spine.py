"""Calendar spines and the dates missing from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row ``date_day`` per day from ``start`` up to, not including, ``end``.

    ``bounds`` is a one-row frame, so the ends may be literals or aggregates of data.
    An end at or before the start gives no rows.
    """
    first, last = F.to_date(F.col(start)), F.date_sub(F.to_date(F.col(end)), 1)
    days = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias("date_day"))


def missing_dates(spine: DataFrame, loaded: DataFrame, day: str = "date_day") -> DataFrame:
    """Days of the spine on which nothing was loaded, in order."""
    return (
        spine.join(loaded.select(day).distinct(), day, "left_anti")
        .select(F.col(day).alias("missing_date"))
        .orderBy("missing_date")
    )
