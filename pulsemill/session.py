"""Session settings and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Results depend on the first
# two; the others let the runtime split hot join keys and merge small partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Folders are listed by a few hundred tasks; one task for each sends more about itself than about its files.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


# With it the shuffle files of a statement go when it has ended (Spark 4.1).
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models rely on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "pulsemill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    ``shuffle_partitions`` is where adaptive execution starts from before it
    merges; on a cluster give two to three times the number of cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(RUNTIME_SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    such a folder is lost together with the machine it lives on.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="pulsemill-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, never reused folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind.

    Else these stay until the driver happens to collect its garbage, and a job of many writes
    holds the shuffles of all of them. Every write is planned anew, so none of these files is
    read again; a frame that is collected twice would be, so this is not set for the session.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def cut_lineage(df):
    """Write ``df`` once as a table below the shared folder and read on from there.

    Later stages neither recompute it nor depend on the executors that made it, and
    joins see its real size. Give columns a type: an untyped NULL cannot be written.
    """
    return written_to(df, scratch_folder(df.sparkSession, "cut"))


def written_to(df: DataFrame, path: str) -> DataFrame:
    with dropping_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``cut_lineage`` for tables that nothing reads behind the block: they go when it ends well."""
    made: list[str] = []

    def cut(df: DataFrame) -> DataFrame:
        made.append(scratch_folder(spark, "cut"))
        return written_to(df, made[-1])

    yield cut
    for path in made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
