"""Several conditional distinct counts over one identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_distinct_counts(
    df: DataFrame, keys: list[str], identifier: str, conditions: dict[str, Column]
) -> DataFrame:
    """``count(distinct case when condition then identifier end)`` per condition.

    Written as two aggregates: first one row per (keys, identifier) that remembers
    which conditions it ever met, then a plain sum. Spark's own rewrite of several
    distinct aggregates copies each input row once per condition; this one
    does not, and a hot group is spread over its identifiers before it is summed.
    """
    met = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in conditions.items()]
    once = df.where(F.col(identifier).isNotNull()).groupBy(*keys, identifier).agg(*met)
    counted = once.groupBy(*keys).agg(*[F.sum(name).cast("bigint").alias(name) for name in conditions])
    return counted
