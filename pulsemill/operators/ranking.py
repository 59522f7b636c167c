"""Row numbers within groups, also where one group is far too big for one task."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

# A group above this many rows is never sorted by one task.
HOT_ROWS = 1_000_000

# Up to this rank Spark drops surplus rows before the exchange
# (the default of spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_RANK = 1000


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality on all keys, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups above ``hot_rows`` with their size: at most ``rows / hot_rows`` of them.

    Counted exactly; the count reads only the key columns and is combined before
    the exchange. The result is written to the shared folder once.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return cut_lineage(sizes.where(F.col("_rows") > hot_rows))


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups). ``hot`` is small by construction."""
    few = F.broadcast(hot.select(*keys))
    condition = same_keys(df, few, keys)
    return df.join(few, condition, "left_anti"), df.join(few, condition, "left_semi")


def sequence_in_slices(
    df: DataFrame, keys: list[str], order: list[Column], name: str, slices: int
) -> DataFrame:
    """Row numbers for groups that do not fit one task.

    The rows are range-partitioned by (keys, order), so each partition is one
    contiguous slice of the sorted data, and written to the shared folder, which
    fixes the slice a row belongs to even if executors are lost. A row's number is
    its number inside the slice plus the rows of its group in earlier slices. Only a
    group carried over from an earlier slice has such an offset, one per slice at
    most, so the offsets may be broadcast whatever the size of the data.
    """
    sliced = cut_lineage(
        df.repartitionByRange(slices, *[F.col(k) for k in keys], *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .where("_before > 0")
        .drop("_rows")
    )
    inside = Window.partitionBy("_slice", *keys).orderBy(*order)
    numbered = sliced.withColumn("_inside", F.row_number().over(inside))
    few = F.broadcast(offsets)
    joined = numbered.join(few, same_keys(numbered, few, [*keys, "_slice"]), "left")
    position = (F.col("_inside") + F.coalesce(few["_before"], F.lit(0))).cast("bigint")
    return joined.select(*[numbered[c] for c in df.columns], position.alias(name))


def slices_for(hot: DataFrame, hot_rows: int) -> int:
    """How many slices keep each below ``hot_rows``; 0 if no group is hot."""
    total = hot.agg(F.sum("_rows")).first()[0] or 0
    return math.ceil(total / max(hot_rows, 1)) * 2


def number_plainly(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(place).cast("bigint"))


def sequence_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``, which must be total.

    Ordinary groups take one window. Groups above ``hot_rows`` are numbered in
    slices. ``hot_rows=None`` skips the look for hot groups; use it only where the
    size of a group is bounded by something other than the data.
    """
    if hot_rows is None:
        return number_plainly(df, keys, order, name)
    hot = hot_groups(df, keys, hot_rows)
    slices = slices_for(hot, hot_rows)
    if not slices:
        return number_plainly(df, keys, order, name)
    ordinary, big = split_hot(df, keys, hot)
    return number_plainly(ordinary, keys, order, name).unionByName(
        sequence_in_slices(big, keys, order, name, slices)
    )


def top_n_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    n: int,
    rank_name: str = "rank",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """First ``n`` rows of each group.

    Small ``n`` is cut per input partition before the exchange, so hot groups are
    harmless; a large ``n`` goes through the numbering that splits hot groups.
    """
    if n <= PRUNED_RANK:
        ranked = df.withColumn(rank_name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        kept = ranked.where(F.col(rank_name) <= n)
        return kept.withColumn(rank_name, F.col(rank_name).cast("bigint"))
    return sequence_within(df, keys, order, rank_name, hot_rows).where(F.col(rank_name) <= n)
