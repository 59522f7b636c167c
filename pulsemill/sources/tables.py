"""Published tables: immutable versions behind a log that says what is current.

``path/data/version=N`` holds the rows of one write and is never changed again.
``path/log/version=N`` is one small file, written last: for every partition value of the
table the version that its rows are in, and the schema. A version without its log entry
does not exist, so a job that is lost halfway leaves the table as it was, and whoever
read it before goes on reading the same files. Old versions stay; give the folder a retention rule.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pulsemill.operators.upsert import upsert
from pulsemill.session import cut_lineage, dropping_shuffles

# Types are given: an empty or new log must not be guessed at.
LOG = "part string, held bigint, partition string, schema string, origin string, since bigint, version bigint"
VERSION = "version"

# A large version is written by so many writes at most, each of about this many rows or more.
MOST_WRITES, WRITE_ROWS = 4, 1_000_000

# Rows of a table without partitions, and the name of the NULL partition.
WHOLE, NULL_PART = "", "\0null"


@dataclass(frozen=True)
class Snapshot:
    """What is current: for each partition value (as text) the version with its rows.

    There are as many entries as the table has partitions (months or buckets, not rows).
    """

    version: int
    partition: str | None
    schema: StructType
    held: dict[str, int]
    since: int
    origin: str | None = None


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def existing(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet files at ``path``, None if there is no such folder; any other failure is raised."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def log_of(spark: SparkSession, path: str) -> DataFrame | None:
    return existing(spark, f"{path}/log", LOG)


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest committed version, None if there is none.

    Versions are read off the names of the log's files, so only the newest entry is opened.
    """
    log = log_of(spark, path)
    versions = [int(m[1]) for f in log.inputFiles() if (m := re.search(rf"/{VERSION}=(\d+)/", f))] if log is not None else []
    if not versions:
        return None
    rows = log.where(F.col(VERSION) == max(versions)).collect()
    return Snapshot(
        version=max(versions),
        partition=rows[0].partition,
        schema=StructType.fromJson(json.loads(rows[0].schema)),
        # An emptied table has one entry without a part, for its schema.
        held={r.part: r.held for r in rows if r.part is not None},
        since=rows[0].since,
        origin=rows[0].origin,
    )


def grown(old: StructType, new: StructType) -> StructType:
    """The old columns, then those that only the new schema has; a column keeps its type."""
    known = {f.name: f for f in old}
    for field in new:
        if field.name in known and known[field.name].dataType != field.dataType:
            raise ValueError(f"column {field.name} is {known[field.name].dataType.simpleString()}, not {field.dataType.simpleString()}")
    return StructType([*old, *(f for f in new if f.name not in known)])


def as_part(partition: str) -> Column:
    return F.coalesce(F.col(f"`{partition}`").cast("string"), F.lit(NULL_PART))


def read_snapshot(spark: SparkSession, path: str, found: Snapshot) -> DataFrame:
    """The rows of a snapshot. Columns that came later are NULL in older rows.

    Folders are named by version and filtered by partition value; filters on the
    partition column prune as in any partitioned table.
    """
    names = found.schema.fieldNames()
    if not found.held:
        return spark.createDataFrame([], found.schema)
    versions = sorted(set(found.held.values()))
    schema = StructType([*found.schema, StructField(VERSION, LongType())]) if VERSION not in names else found.schema
    folders = [f"{path}/data/{VERSION}={v:012d}" for v in versions]
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    if found.partition is not None:
        current = F.lit(False)
        for v in versions:
            parts = [part for part, held in found.held.items() if held == v]
            current = current | ((F.col(VERSION) == v) & as_part(found.partition).isin(parts))
        rows = rows.where(current)
    return rows.select(*[f"`{c}`" for c in names])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a published table, or plain Parquet files that something else wrote."""
    found = snapshot(spark, path)
    return spark.read.parquet(path) if found is None else read_snapshot(spark, path, found)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The published table at ``path``, None if there is none yet."""
    found = snapshot(spark, path)
    return None if found is None else read_snapshot(spark, path, found)


def of_parts(partition: str, values: list) -> Column:
    found = F.col(f"`{partition}`").isin([v for v in values if v is not None])
    return found | F.col(f"`{partition}`").isNull() if None in values else found


def batches_of(sizes: dict[object, int]) -> list[list]:
    """The partition values of ``sizes`` (value: rows), dealt to a few writes of about as many rows each."""
    total = sum(sizes.values())
    writes = max(1, min(MOST_WRITES, math.ceil(total / WRITE_ROWS)))
    batches, held = [], 0
    for value, n in sizes.items():
        if not batches or len(batches) < writes and held * writes >= total * len(batches):
            batches.append([])
        batches[-1].append(value)
        held += n
    return batches


def write_rows(
    rows: DataFrame,
    path: str,
    partition: str | None,
    version: int,
    derived: dict[str, Column] | None = None,
    order: list[str] | None = None,
    batches: list[list] | None = None,
) -> None:
    """The rows of one version; what a lost job left under its number is replaced.

    ``derived`` columns follow from the others of their row, so they are worked out behind the
    exchange instead of being sent through it. Files are sorted by ``order``: rows that are
    alike lie together and pack better. Writing sorts by partition anyway, so it is one sort.

    ``batches`` lists all partition values by the write that takes them. The shuffle of one is
    gone when the next begins, so that of all rows never lies on the disks at once; ``rows`` is
    worked out for each of them and should read from tables.
    """
    columns = [F.col(f"`{partition}`")] if partition else []
    derived = {name: value for name, value in (derived or {}).items() if name in rows.columns}
    for number, values in enumerate(batches or [None]):
        some = rows if values is None else rows.where(of_parts(partition, values))
        dealt = some.drop(*derived).hint("rebalance", *columns)
        if order:
            dealt = dealt.sortWithinPartitions(*columns, *[F.col(f"`{c}`") for c in order])
        dealt = dealt.withColumns(derived).select(*[f"`{c}`" for c in rows.columns])
        writer = dealt.write.mode("append" if number else "overwrite").option("compression", "zstd")
        if partition:
            writer = writer.partitionBy(partition)
        with dropping_shuffles(rows.sparkSession):
            writer.parquet(f"{path}/data/{VERSION}={version:012d}")


def parts_written(spark: SparkSession, path: str, schema: StructType, partition: str | None, version: int) -> list[str]:
    if partition is None:
        return [WHOLE]
    rows = spark.read.schema(schema).parquet(f"{path}/data/{VERSION}={version:012d}")
    return [r[0] for r in rows.select(as_part(partition)).distinct().collect()]


def commit(spark: SparkSession, path: str, entry: Snapshot, origin: str | None) -> None:
    """Write the log entry: one file, which is there whole or not at all.

    A version that another writer has committed meanwhile is an error, not replaced.
    """
    schema = entry.schema.json()
    parts = list(entry.held.items()) or [(None, None)]
    lines = [(part, held, entry.partition, schema, origin, entry.since) for part, held in parts]
    log = spark.createDataFrame(lines, LOG.rsplit(",", 1)[0])
    log.coalesce(1).write.mode("error").parquet(f"{path}/log/{VERSION}={entry.version:012d}")


def write_consumed(consumed: DataFrame | None, path: str, version: int) -> None:
    if consumed is not None:
        consumed.coalesce(1).write.mode("overwrite").parquet(f"{path}/consumed/{VERSION}={version:012d}")


def publish_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    consumed: DataFrame | None = None,
    origin: str | None = None,
    derived: dict[str, Column] | None = None,
    order: list[str] | None = None,
    batches: list[list] | None = None,
) -> DataFrame:
    """Full rebuild at ``path`` as a new version; the frame may read from the old one.

    ``consumed`` lists the source files that the rows stand for (see ``consumed_files``); it
    is committed with them and replaces what was listed before. For ``derived``, ``order`` and
    ``batches`` see ``write_rows``.
    """
    if partition_by and len(partition_by) > 1:
        raise ValueError("a published table has at most one partition column")
    spark, partition = df.sparkSession, partition_by[0] if partition_by else None
    before = snapshot(spark, path)
    version = 0 if before is None else before.version + 1
    write_rows(df, path, partition, version, derived, order, batches)
    write_consumed(consumed, path, version)
    parts = parts_written(spark, path, df.schema, partition, version)
    commit(spark, path, Snapshot(version, partition, df.schema, dict.fromkeys(parts, version), version), origin)
    return read_table(spark, path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    touched: list | None = None,
    consumed: DataFrame | None = None,
    origin: str | None = None,
    derived: dict[str, Column] | None = None,
    order: list[str] | None = None,
    batches: list[list] | None = None,
) -> None:
    """A new version in which ``df`` takes the place of all rows of the touched partitions.

    ``touched`` lists their values; without it those are replaced that ``df`` has rows of.
    One that is listed and has no rows any more is gone. The other partitions
    stay where they are. Columns that are new are added to the table.
    """
    spark, before = df.sparkSession, snapshot(df.sparkSession, path)
    if before is None:
        before = Snapshot(-1, partition, df.schema, {}, 0)
    if before.partition != partition:
        raise ValueError(f"{path} is partitioned by {before.partition}, not by {partition}")
    schema = grown(before.schema, df.schema)
    version = before.version + 1
    write_rows(df, path, partition, version, derived, order, batches)
    write_consumed(consumed, path, version)
    parts = parts_written(spark, path, df.schema, partition, version)
    gone = {NULL_PART if value is None else str(value) for value in touched or []}
    held = {part: v for part, v in before.held.items() if part not in gone} | dict.fromkeys(parts, version)
    commit(spark, path, Snapshot(version, partition, schema, held, before.since), origin)


def merge_partitions(
    spark: SparkSession, path: str, delta: DataFrame, keys: list[str], partition: str, evolve: bool = True
) -> None:
    """Keyed upsert into a partitioned table that rewrites only the touched partitions.

    A key must always fall into the same partition, as the day of a comment or of a
    daily fact does. The table is pruned to the partitions of the delta, a list as long
    as the delta has distinct partition values (days or months, not rows). Columns that only the
    delta has are added to the table, NULL in all older rows; without ``evolve`` they are left out.
    """
    target = read_table(spark, path)
    delta = cut_lineage(delta if evolve else delta.select(*target.columns))
    values = [row[0] for row in delta.select(partition).distinct().collect()]
    if not values:
        return
    replace_partitions(upsert(target.where(of_parts(partition, values)), delta, keys, evolve=evolve), path, partition, values)


CONSUMED = "source string, source_file string, loaded_at timestamp_ntz"


def files_of(sources: dict[str, DataFrame]) -> DataFrame:
    """The source files (name, load time) that the rows of each frame came from."""
    parts = [
        df.select(F.lit(name).alias("source"), "source_file", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"))
        for name, df in sources.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.distinct()


def consumed_files(spark: SparkSession, path: str) -> DataFrame:
    """All files that the current rows of a published table stand for: those listed with its
    committed versions since the last full rebuild."""
    found = snapshot(spark, path)
    listed = existing(spark, f"{path}/consumed", f"{CONSUMED}, {VERSION} bigint") if found else None
    if listed is None:
        return spark.createDataFrame([], CONSUMED)
    committed = log_of(spark, path).select(VERSION).distinct()
    return listed.where(F.col(VERSION).between(found.since, found.version)).join(committed, VERSION, "left_semi").drop(VERSION)


def not_consumed(df: DataFrame, consumed: DataFrame, source: str) -> DataFrame:
    """Rows whose file, by name and load time, is not in the list; a file of any load time is new if it is not listed."""
    done = consumed.where(F.col("source") == source).select(
        F.col("source_file").alias("_file"), F.col("loaded_at").alias("_at")
    )
    same = df["source_file"].eqNullSafe(done["_file"]) & df["loaded_at"].cast("timestamp_ntz").eqNullSafe(done["_at"])
    return df.join(done, same, "left_anti")
