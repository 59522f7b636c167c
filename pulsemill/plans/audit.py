"""What was loaded, and on which days nothing was."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.operators.spine import date_spine, missing_dates


def load_audit(entities: dict[str, DataFrame], loaded_at: str = "loaded_at") -> DataFrame:
    """Rows, distinct load days, first and last load per entity.

    Loads are first summed per day, so counting distinct days needs no distinct
    aggregate and the whole of an entity never meets in one task.
    """
    tagged = [df.select(F.lit(name).alias("entity"), F.col(loaded_at).alias("at")) for name, df in entities.items()]
    daily = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("entity", F.to_date("at").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    )
    return daily.groupBy("entity").agg(
        F.sum("n").alias("total_records"),
        F.count("day").alias("distinct_days"),
        F.min("first").alias("earliest"),
        F.max("last").alias("latest"),
    )


def load_gaps(loads: DataFrame, bounds: DataFrame, loaded_at: str = "loaded_at") -> DataFrame:
    """Days of the calendar in ``bounds`` on which nothing was loaded, in order."""
    days = loads.select(F.to_date(loaded_at).alias("date_day"))
    return missing_dates(date_spine(bounds), days)
