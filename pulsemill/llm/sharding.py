"""Shards of near equal size from sampled splitters.

A size-weighted sample of the keys gives quantile boundaries; records are
range-partitioned by them. Ranges that come out overfull are subdivided by a random
number fixed per row, so neither a hot key nor a dense stretch of keys meets in one
task. Exact prefix sums over the ranges then cut the ordered records into shards.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

RANGES_PER_SHARD = 16
SAMPLES_PER_RANGE = 16
BUCKET_BYTES = 64 << 20
BUCKET_ROWS = 500_000
LOWEST_KEY = -(1 << 63)


def range_of(key: Column, splitters: list[int]) -> Column:
    """Number of splitters at or below ``key``, found in two steps of about the root of their number."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    every = F.lit(splitters)
    blocks = splitters[step - 1 :: step]
    before = F.size(F.filter(F.lit(blocks), lambda x: x <= key)) * step
    inside = F.size(F.filter(F.slice(every, before + 1, F.lit(step)), lambda x: x <= key))
    return before + inside


def quantiles(sample: list[int], ranges: int) -> list[int]:
    """At most ``ranges - 1`` distinct boundaries that cut a sorted sample evenly."""
    if not sample:
        return []
    picked = (sample[i * len(sample) // ranges] for i in range(1, ranges))
    return sorted(set(picked) - {sample[0]})


def shard_by_size(
    rows: DataFrame,
    key: Column,
    size: Column,
    shards: int,
    *,
    seed: int = 17,
    ranges_per_shard: int = RANGES_PER_SHARD,
    samples_per_range: int = SAMPLES_PER_RANGE,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (from 0, gapless in each shard).

    ``key`` is an integer to order by, ``size`` the weight of a row. Every shard gets
    the same share of the total size, up to half of the record on each of its
    borders. The driver sees the sample (``shards * ranges_per_shard *
    samples_per_range`` keys are expected), one figure per range and one per shard.

    Null keys sort first, null and negative sizes count as 0; if all sizes are 0 each
    row weighs 1. Equal keys and repeated rows are all kept and may lie on both sides
    of a border. No rows give no rows. Input columns named ``shard`` or ``slot`` are
    replaced. Only columns that are handed in are carried along, so pass narrow rows.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    fixed = cut_lineage(
        rows.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("record"),
            F.coalesce(key.cast("long"), F.lit(LOWEST_KEY)).alias("k"),
            F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("s"),
            F.rand(seed).alias("u"),
        )
    )
    found = fixed.agg(F.count("*").alias("n"), F.coalesce(F.sum("s"), F.lit(0)).alias("total")).first()
    if found.total == 0:
        fixed, total = fixed.withColumn("s", F.lit(1).cast("long")), max(1, found.n)
    else:
        total = found.total

    ranges = shards * ranges_per_shard
    wanted = ranges * samples_per_range
    drawn = fixed.where(F.rand(seed + 1) < F.col("s") * F.lit(wanted / total)).select("k").collect()
    splitters = quantiles(sorted(r.k for r in drawn), ranges)
    ranged = fixed.withColumn("r", range_of(F.col("k"), splitters))

    measured = {r.r: (r.n, r.size) for r in ranged.groupBy("r").agg(F.count("*").alias("n"), F.sum("s").alias("size")).collect()}
    most = min(max(1, 2 * total // ranges), bucket_bytes)
    parts, size_before, rows_before, so_far, count = [], [], [], 0, 0
    for r in range(len(splitters) + 1):
        n, weight = measured.get(r, (0, 0))
        parts.append(max(1, -(-weight // most), -(-n // bucket_rows)))
        size_before.append(so_far)
        rows_before.append(count)
        so_far, count = so_far + weight, count + n

    def of_range(values: list[int]) -> Column:
        return F.element_at(F.lit(values), F.col("r") + 1).cast("long")

    cut = ranged.withColumn("part", F.floor(F.col("u") * of_range(parts)).cast("long"))
    earlier = Window.partitionBy("r").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    buckets = cut.groupBy("r", "part").agg(F.count("*").alias("n"), F.sum("s").alias("size"))
    offsets = buckets.select(
        "r",
        "part",
        (of_range(size_before) + F.coalesce(F.sum("size").over(earlier), F.lit(0))).alias("size_offset"),
        (of_range(rows_before) + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("row_offset"),
    )
    inside = Window.partitionBy("r", "part").orderBy("k", "u")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        cut.withColumns({"sum_to": F.sum("s").over(upto), "place": F.row_number().over(inside)})
        .join(offsets, ["r", "part"])
        .select(
            "record",
            (F.col("row_offset") + F.col("place") - 1).alias("place"),
            (2 * (F.col("size_offset") + F.col("sum_to")) - F.col("s")).alias("middle"),
        )
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"middle * {shards} div {2 * total}")).cast("int"))
        .drop("middle")
    )
    placed = cut_lineage(placed)
    first = {r.shard: r.first for r in placed.groupBy("shard").agg(F.min("place").alias("first")).collect()}
    starts = F.lit([first.get(i, 0) for i in range(shards)])
    return placed.select(
        *[F.col("record").getField(c).alias(c) for c in kept],
        "shard",
        (F.col("place") - F.element_at(starts, F.col("shard") + 1)).cast("long").alias("slot"),
    )
