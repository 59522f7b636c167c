"""Micro-batch ingest of newly landed JSON-array files."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemill.operators.dedup import latest_by_key
from pulsemill.sources.raw import array_rejects, documents_from_text, with_file_lineage
from pulsemill.sources.tables import existing, read_snapshot, replace_partitions, snapshot

# Partition of a state table: a hash of the key.
BUCKET = "bucket"
BUCKETS = 16

DOCUMENTS, REJECTS, COMMITS = "documents", "rejects", "commits"


# A backlog is taken in at most so many batches.
MOST_BATCHES = 16


def files_per_batch(files: int, at_least: int) -> int:
    """How many of ``files`` waiting files a batch takes: ``at_least``, more where that would be over
    ``MOST_BATCHES`` batches.

    A batch has costs of its own (commits, listings of what was committed, rewritten state), so
    their number must not grow with the backlog.
    """
    return max(at_least, math.ceil(files / MOST_BATCHES))


def stream_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New files below ``path`` as whole texts with their lineage."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        # Same-named files of different dates are different files.
        .option("fileNameOnly", False)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_file_lineage(reader.load(path))


def append_raw(
    spark: SparkSession, path: str, root: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append every document of every new file to RAW exactly once, and every file that
    cannot be read to the rejects, then stop.

    Both are written under the number of the batch, then one small file that commits the two
    together; ``read_raw`` and ``read_rejects`` look at committed batches only. A batch
    that is run again replaces what its lost run wrote. RAW keeps the full history; staging reduces
    it to the latest state. This is the route for large tables: a batch writes only its
    own rows. A new checkpoint needs a new ``root``.
    """

    def apply_batch(files: DataFrame, batch_id: int) -> None:
        number = f"batch={batch_id:012d}"
        committed = existing(files.sparkSession, f"{root}/{COMMITS}", "documents bigint, batch bigint")
        if committed is not None and not committed.where(F.col("batch") == batch_id).isEmpty():
            return
        documents_from_text(files).write.mode("overwrite").parquet(f"{root}/{DOCUMENTS}/{number}")
        array_rejects(files).write.mode("overwrite").parquet(f"{root}/{REJECTS}/{number}")
        done = files.sparkSession.read.parquet(f"{root}/{DOCUMENTS}/{number}").agg(F.count(F.lit(1)).alias("documents"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{root}/{COMMITS}/{number}")

    return (
        stream_files(spark, path, files_per_batch)
        .writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def committed_rows(spark: SparkSession, root: str, sink: str) -> DataFrame:
    """Rows of one sink of ``append_raw`` from batches that were committed; few batches, so few rows to look up."""
    batches = spark.read.parquet(f"{root}/{COMMITS}").select("batch")
    return spark.read.parquet(f"{root}/{sink}").join(batches, "batch", "left_semi").drop("batch")


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """All documents that ``append_raw`` has committed."""
    return committed_rows(spark, root, DOCUMENTS)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """All files that ``append_raw`` could not read, and why."""
    return committed_rows(spark, root, REJECTS)


def latest_state(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    stage: Callable[[DataFrame], DataFrame],
    keys: list[str],
    newest_first: Callable[[], list[Column]],
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep a table at the latest row per key, then stop.

    The table is cut into hash buckets of the key. A batch reads and rewrites the buckets
    that its keys fall into and commits them as one version, so its cost follows what it
    brings; give a large table so many buckets that one is a few files. A batch whose version was
    committed before a failure is not applied again (nothing else writes to the table), and a snapshot that arrives late does not replace
    a newer one. The number of buckets of a table must not change.
    """

    def apply_batch(files: DataFrame, batch_id: int) -> None:
        origin = f"{checkpoint}#{batch_id}"
        before = snapshot(files.sparkSession, table)
        if before is not None and before.origin == origin:
            return
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        rows = stage(documents_from_text(files)).withColumn(BUCKET, bucket)
        fresh = latest_by_key(rows, keys, newest_first()).persist()
        try:
            touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
            if before is not None:
                old = read_snapshot(files.sparkSession, table, before).where(F.col(BUCKET).isin(touched))
                fresh_and_old = old.unionByName(fresh, allowMissingColumns=True)
                merged = latest_by_key(fresh_and_old, keys, newest_first())
            else:
                merged = fresh
            replace_partitions(merged, table, BUCKET, touched, origin=origin)
        finally:
            fresh.unpersist()

    return (
        stream_files(spark, path, files_per_batch)
        .writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
