"""Month-by-month history loads, resumable through a ledger table.

Ledger: one row per run, repository and chunk with ``status`` (completed or failed),
``issues`` and ``comments`` counts, ``error`` and ``recorded_at``. All chunks of all
repositories are one distributed job; there is no loop over chunks.

A load is committed by the ledger: ``run_backfill`` writes what it loads under an origin of
its own and then appends the ledger entries, which name that origin, as one file.
``read_backfilled`` takes landed rows only where an entry stands for them, so what a lost
run has landed does not exist, and the next run finds its chunks pending.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsemill.functions.temporal import (
    AsOf,
    add_months_keeping_time,
    as_of_timestamp,
    whole_months_between,
)
from pulsemill.operators.dedup import latest_by_key
from pulsemill.operators.upsert import upsert
from pulsemill.plans.extraction import without_pull_requests
from pulsemill.plans.quality import MAX_NULL_PERCENTAGE
from pulsemill.session import cut_lineage
from pulsemill.sources.landing import raw_documents, write_landing
from pulsemill.sources.raw import read_landing
from pulsemill.sources.tables import existing

LEDGER_KEY = ["run_id", "repository", "chunk_id"]
CHUNK = ["repository", "chunk_id"]

# The stored ledger: an entry also names the origin and the date that its rows were landed under.
STORED_LEDGER = """run_id string, repository string, chunk_id string, status string, issues bigint, comments bigint,
error string, recorded_at timestamp_ntz, origin string, load_date date"""

# Columns a loaded row must have.
REQUIRED_ISSUE_COLUMNS = ["issue_id", "issue_number", "title", "state", "created_at"]
REQUIRED_COMMENT_COLUMNS = ["comment_id", "issue_url", "created_at", "body"]

# Fixed value: consecutive failures after which a repository is given up.
MAX_CONSECUTIVE_FAILURES = 10


def ranges(
    repositories: DataFrame, as_of: AsOf, global_start: AsOf | None = None, global_end: AsOf | None = None
) -> DataFrame:
    """Period to load per repository.

    Its own dates (``custom_start``, ``custom_end``) win over the global ones; without
    either the period runs from the repository's creation to now.
    """

    def instant(value):
        return F.lit(None).cast("timestamp_ntz") if value is None else as_of_timestamp(value)

    return repositories.select(
        F.col("full_name").alias("repository"),
        F.coalesce("custom_start", instant(global_start), "created_at").alias("range_start"),
        F.coalesce("custom_end", instant(global_end), as_of_timestamp(as_of)).alias("range_end"),
    )


def chunk_name(start):
    return F.date_format(start, "yyyy-MM")


def month_chunks(periods: DataFrame) -> DataFrame:
    """Half-open month steps anchored at the start of each period, the last one clipped.

    A chunk ends where the next one starts, so there is neither gap nor overlap.
    """
    start, end = F.col("range_start"), F.col("range_end")
    steps = F.when(start < end, F.sequence(start, end, F.expr("interval 1 month")))
    stepped = periods.select("repository", "range_start", "range_end", F.posexplode(steps).alias("chunk_index", "chunk_start"))
    following = add_months_keeping_time(F.col("range_start"), F.col("chunk_index") + 1)
    return stepped.where(F.col("chunk_start") < F.col("range_end")).select(
        "repository",
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        chunk_name(F.col("chunk_start")).alias("chunk_id"),
        "chunk_start",
        F.least(following, F.col("range_end")).alias("chunk_end"),
    )


def in_chunk(df: DataFrame, start: AsOf, end: AsOf, column: str = "created_at") -> DataFrame:
    """Rows created in a half-open period."""
    created = F.col(column)
    return df.where((created >= as_of_timestamp(start)) & (created < as_of_timestamp(end)))


def parse_instant(text):
    """ISO-8601 text with Z to wall-clock time."""
    return text.try_cast("timestamp_ntz")


def with_chunk(issues: DataFrame, periods: DataFrame) -> DataFrame:
    """Issues of the loaded periods with the chunk they fall into.

    The chunk follows from the month distance to the start of the period: an equi
    join on the repository and arithmetic, not a range join against chunk rows.
    """
    created = F.col("created_at")
    index = whole_months_between(F.col("range_start"), created)
    return (
        issues.join(periods, "repository")
        .where((created >= F.col("range_start")) & (created < F.col("range_end")))
        .withColumn("chunk_index", index)
        .withColumn("chunk_id", chunk_name(add_months_keeping_time(F.col("range_start"), index)))
        .drop("range_start", "range_end")
    )


def pending_chunks(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Planned chunks that no run has completed."""
    done = ledger.where("status = 'completed'").select("repository", "chunk_id")
    return chunks.join(done, CHUNK, "left_anti")


def chunk_load_counts(
    chunks: DataFrame, chunked_issues: DataFrame, comments: DataFrame
) -> DataFrame:
    """Issues and comments per planned chunk, empty chunks included.

    Comments are counted per issue before they are joined, so one issue with very
    many comments is a single row there.
    """
    parent = ["repository", "issue_number"]
    talk = comments.groupBy(*parent).agg(F.count(F.lit(1)).alias("_comments"))
    busy = F.when(F.col("comment_count") > 0, F.col("_comments"))
    loaded = (
        chunked_issues.join(talk, parent, "left")
        .groupBy("repository", "chunk_id")
        .agg(F.count(F.lit(1)).alias("issues"), F.sum(F.coalesce(busy, F.lit(0))).alias("comments"))
    )
    none = F.lit(0).cast("bigint")
    return chunks.join(loaded, CHUNK, "left").withColumns(
        {"issues": F.coalesce("issues", none), "comments": F.coalesce("comments", none)}
    )


def ledger_entries(chunks: DataFrame, run_id: str, as_of: AsOf) -> DataFrame:
    """Chunks with ``status``, counts and ``error`` in the shape of the ledger."""
    return chunks.select(
        F.lit(run_id).alias("run_id"),
        "repository",
        "chunk_id",
        "status",
        "issues",
        "comments",
        "error",
        as_of_timestamp(as_of).alias("recorded_at"),
    )


def completed_entries(counts: DataFrame, run_id: str, as_of: AsOf) -> DataFrame:
    """Ledger rows for loaded chunks."""
    done = counts.withColumns({"status": F.lit("completed"), "error": F.lit(None).cast("string")})
    return ledger_entries(done, run_id, as_of)


def failed_entries(chunks: DataFrame, run_id: str, as_of: AsOf) -> DataFrame:
    """Ledger rows for chunks that failed with ``error``."""
    nothing = F.lit(0).cast("bigint")
    failed = chunks.withColumns({"status": F.lit("failed"), "issues": nothing, "comments": nothing})
    return ledger_entries(failed, run_id, as_of)


def update_ledger(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """Record chunks; a chunk tried again in the same run replaces its entry."""
    return upsert(ledger, entries, LEDGER_KEY)


def missing_share(rows: DataFrame, required: list[str], name: str) -> DataFrame:
    """Percentage of required values missing per chunk."""
    lacking = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in required])
    share = F.sum(lacking) * 100.0 / (F.count(F.lit(1)) * len(required))
    return rows.groupBy(*CHUNK).agg(share.alias(name))


def judge_chunks(
    todo: DataFrame,
    issues: DataFrame,
    comments: DataFrame,
    limit: float = MAX_NULL_PERCENTAGE,
    strict: bool = False,
    max_failures: int = MAX_CONSECUTIVE_FAILURES,
) -> DataFrame:
    """Planned chunks with the share of missing values and what becomes of each.

    ``status`` is failed for a chunk above the limit (only if ``strict``), completed for
    any other, and NULL for those after the point where a repository is given up.
    """
    judged = (
        todo.join(missing_share(issues, REQUIRED_ISSUE_COLUMNS, "issues_missing"), CHUNK, "left")
        .join(missing_share(comments, REQUIRED_COMMENT_COLUMNS, "comments_missing"), CHUNK, "left")
        .withColumns(
            {
                "issues_missing": F.coalesce("issues_missing", F.lit(0.0)),
                "comments_missing": F.coalesce("comments_missing", F.lit(0.0)),
            }
        )
    )
    worst = F.greatest("issues_missing", "comments_missing")
    failed = (worst > limit) & F.lit(strict)
    judged = judged.withColumns(
        {
            "status": F.when(failed, "failed").otherwise("completed"),
            "error": F.when(failed, F.concat(F.round(worst, 1).cast("string"), F.lit("% of required values missing"))),
        }
    )
    stops = failure_streaks(judged.withColumn("run_id", F.lit("")), max_failures).select(
        "repository", "stopped_at"
    )
    reached = F.col("stopped_at").isNull() | (F.col("chunk_id") <= F.col("stopped_at"))
    return (
        judged.join(stops, "repository")
        .withColumn("status", F.when(reached, F.col("status")))
        .drop("stopped_at")
    )


def load_pending(
    issues: DataFrame,
    comments: DataFrame,
    periods: DataFrame,
    ledger: DataFrame,
    root: str,
    run_id: str,
    as_of: AsOf,
    strict: bool = False,
    dry_run: bool = False,
    max_failures: int = MAX_CONSECUTIVE_FAILURES,
    repositories: DataFrame | None = None,
    origin: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load every pending chunk; gives (new ledger entries, judged chunks).

    Rows are landed under ``origin``, the run's name by default. ``repositories`` (staged, with
    documents) are landed too, dated ``as_of``, where a chunk was loaded.

    ``issues`` and ``comments`` are staged with their documents kept, so each id comes
    once. Issues without pull requests and the comments of issues that have some are
    checked per chunk and written to the landing area, dated by the end of their chunk.
    With ``strict`` a chunk that fails the check is recorded as failed and not written,
    and a repository is given up after ``max_failures`` such chunks in a row. With
    ``dry_run`` nothing is written and nothing recorded.
    """
    todo = cut_lineage(pending_chunks(month_chunks(periods), ledger))
    parent = ["repository", "issue_number"]
    loaded = cut_lineage(
        with_chunk(without_pull_requests(issues), periods).join(todo.select(*CHUNK, "chunk_end"), CHUNK)
    )
    busy = loaded.where(F.col("comment_count") > 0).select(*parent, "chunk_id", "chunk_end")
    named = comments.drop("repository").withColumnRenamed("repository_full_name", "repository")
    remarks = cut_lineage(named.join(busy, parent))
    judged = cut_lineage(judge_chunks(todo, loaded, remarks, strict=strict, max_failures=max_failures))
    if dry_run:
        return ledger.limit(0), judged

    good = judged.where("status = 'completed'")
    for entity, rows in (("issues", loaded), ("comments", remarks)):
        kept = rows.join(good.select(*CHUNK), CHUNK, "left_semi")
        day = F.to_date("chunk_end")
        write_landing(raw_documents(kept, entity, F.col("repository"), day, as_of), root, entity, origin or run_id)
    if repositories is not None:
        loaded_names = good.select(F.col("repository").alias("full_name")).distinct()
        kept = repositories.join(loaded_names, "full_name", "left_semi")
        day = as_of_timestamp(as_of).cast("date")
        documents = raw_documents(kept, "repositories", F.col("full_name"), day, as_of)
        write_landing(documents, root, "repositories", origin or run_id)
    counts = chunk_load_counts(good.select(*todo.columns), loaded, remarks)
    bad = judged.where("status = 'failed'")
    entries = completed_entries(counts, run_id, as_of).unionByName(failed_entries(bad, run_id, as_of))
    return entries, judged


def append_ledger(entries: DataFrame, root: str) -> None:
    """Add entries to the stored ledger as one file; nothing that is stored is changed."""
    entries.coalesce(1).write.mode("append").parquet(f"{root}/ledger")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The latest entry for each run, repository and chunk; empty before the first run."""
    entries = existing(spark, f"{root}/ledger", STORED_LEDGER)
    if entries is None:
        return spark.createDataFrame([], STORED_LEDGER)
    appended = entries.select("*", F.col("_metadata.file_modification_time").alias("_appended"))
    newest = [F.col("recorded_at").desc_nulls_last(), F.col("_appended").desc(), F.col("origin").desc_nulls_last()]
    return latest_by_key(appended, LEDGER_KEY, newest).drop("_appended")


def run_backfill(
    issues: DataFrame,
    comments: DataFrame,
    repositories: DataFrame,
    periods: DataFrame,
    root: str,
    run_id: str,
    as_of: AsOf,
    strict: bool = False,
    max_failures: int = MAX_CONSECUTIVE_FAILURES,
) -> DataFrame:
    """Load all pending chunks below ``root`` and record them; gives the ledger after it.

    Started again after a failure, with the same or another ``run_id``, it loads what has no
    completed entry. Two runs at once would load the same chunks.
    """
    spark = issues.sparkSession
    before = read_ledger(spark, root)
    origin = f"{run_id}.{uuid.uuid4().hex[:12]}"
    entries, judged = load_pending(
        issues,
        comments,
        periods,
        before.drop("origin", "load_date"),
        f"{root}/landing",
        run_id,
        as_of,
        strict=strict,
        max_failures=max_failures,
        repositories=repositories,
        origin=origin,
    )
    dates = judged.select(*CHUNK, F.to_date("chunk_end").alias("load_date"))
    append_ledger(entries.withColumn("origin", F.lit(origin)).join(dates, CHUNK), root)
    return read_ledger(spark, root)


def read_backfilled(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """RAW rows of ``issues``, ``comments`` or ``repositories`` that completed chunks stand for, with their run."""
    done = read_ledger(spark, root).where("status = 'completed'")
    dated = ["path_date"] if entity != "repositories" else []
    entries = done.select(
        "run_id",
        F.col("origin").alias("path_origin"),
        F.col("repository").alias("path_repository"),
        F.col("load_date").alias("path_date"),
    )
    keys = ["path_origin", "path_repository", *dated]
    return read_landing(spark, f"{root}/landing", entity).join(entries.select("run_id", *keys).distinct(), keys)


def failure_streaks(ledger: DataFrame, max_failures: int = MAX_CONSECUTIVE_FAILURES) -> DataFrame:
    """Longest run of failed chunks per run and repository, and where it was given up.

    A repository has one chunk per month, so its window is bounded by the calendar.
    """
    order = Window.partitionBy("run_id", "repository").orderBy("chunk_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ledger.withColumn("_place", F.row_number().over(order))
    last_good = F.max(F.when(F.col("status") != "failed", F.col("_place"))).over(so_far)
    streaks = placed.withColumn("_streak", F.col("_place") - F.coalesce(last_good, F.lit(0)))
    return streaks.groupBy("run_id", "repository").agg(
        F.max("_streak").cast("bigint").alias("longest_streak"),
        F.min(F.when(F.col("_streak") >= max_failures, F.col("chunk_id"))).alias("stopped_at"),
        (F.max("_streak") >= max_failures).alias("is_stopped"),
    )


def repository_status(
    chunks: DataFrame, ledger: DataFrame, max_failures: int = MAX_CONSECUTIVE_FAILURES
) -> DataFrame:
    """Progress of each planned repository: not_started, in_progress, completed or failed."""
    tried = ledger.groupBy("repository", "chunk_id").agg(
        F.bool_or(F.col("status") == "completed").alias("_done")
    )
    progress = (
        chunks.join(tried, CHUNK, "left")
        .groupBy("repository")
        .agg(
            F.count(F.lit(1)).alias("planned_chunks"),
            F.count_if(F.col("_done")).alias("completed_chunks"),
            F.count_if(~F.col("_done")).alias("failed_chunks"),
        )
    )
    stopped = (
        failure_streaks(ledger, max_failures)
        .groupBy("repository")
        .agg(F.bool_or("is_stopped").alias("_stopped"))
    )
    status = (
        F.when(F.col("completed_chunks") == F.col("planned_chunks"), "completed")
        .when(F.coalesce("_stopped", F.lit(False)), "failed")
        .when(F.col("completed_chunks") + F.col("failed_chunks") == 0, "not_started")
        .otherwise("in_progress")
    )
    return progress.join(stopped, "repository", "left").withColumn("status", status).drop("_stopped")


def resumable_repositories(status: DataFrame) -> DataFrame:
    return status.where(F.col("status").isin("not_started", "in_progress"))


def last_processed_chunk(ledger: DataFrame) -> DataFrame:
    """Latest completed chunk per repository."""
    return ledger.where("status = 'completed'").groupBy("repository").agg(
        F.max("chunk_id").alias("last_processed_chunk"), F.count(F.lit(1)).alias("chunks_completed")
    )


def run_summary(ledger: DataFrame) -> DataFrame:
    """Chunks and loaded records by run and status."""
    return ledger.groupBy("run_id", "status").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_distinct("repository").alias("repositories"),
        F.sum("issues").alias("total_issues"),
        F.sum("comments").alias("total_comments"),
    )


def list_runs(ledger: DataFrame) -> DataFrame:
    """Runs, newest first."""
    return (
        ledger.groupBy("run_id")
        .agg(
            F.min("recorded_at").alias("started_at"),
            F.max("recorded_at").alias("last_updated"),
            F.count_distinct("repository").alias("repositories"),
            F.count_if(F.col("status") == "failed").alias("total_errors"),
        )
        .orderBy(F.desc("started_at"), "run_id")
    )
