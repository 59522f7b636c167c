"""Backfill planning, loading counts and the run ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.bindings import roles
from pulsemill.bindings.roles import AS_OF, ISSUES_SQL, REPOSITORIES_SQL, Tables, binder
from pulsemill.functions import field
from pulsemill.plans import backfill
from pulsemill.session import cut_lineage, scratch_folder
from pulsemill.sources import raw_documents, write_landing

BOUND: dict = {}
bind = binder(BOUND)


def periods(t: Tables) -> DataFrame:
    """BUILDING customers have a start of their own (a month end), FURNITURE an own end."""
    segment = F.col("primary_language")
    configured = roles.repositories(t).withColumns(
        {
            "custom_start": F.when(segment == "BUILDING", F.lit("1996-01-31 10:00:00")).cast("timestamp_ntz"),
            "custom_end": F.when(segment == "FURNITURE", F.lit("2000-06-15 00:00:00")).cast("timestamp_ntz"),
        }
    )
    return backfill.ranges(configured, AS_OF)


PERIODS_SQL = f"""
{REPOSITORIES_SQL},
periods AS (
  SELECT full_name AS repository,
    CASE WHEN primary_language = 'BUILDING' THEN TIMESTAMP '1996-01-31 10:00:00' ELSE created_at END AS range_start,
    CASE WHEN primary_language = 'FURNITURE' THEN TIMESTAMP '2000-06-15' ELSE TIMESTAMP '{AS_OF}' END AS range_end
  FROM repositories
)"""

CHUNKS_SQL = f"""
{PERIODS_SQL},
numbered AS (
  SELECT *, unnest(range(0, greatest(datediff('month', range_start, range_end) + 1, 0))) AS i
  FROM periods WHERE range_start < range_end
),
chunks AS (
  SELECT repository, i AS chunk_index, strftime(range_start + to_months(CAST(i AS INT)), '%Y-%m') AS chunk_id,
         range_start + to_months(CAST(i AS INT)) AS chunk_start,
         least(range_start + to_months(CAST(i + 1 AS INT)), range_end) AS chunk_end
  FROM numbered WHERE range_start + to_months(CAST(i AS INT)) < range_end
)"""


def ledger(t: Tables) -> DataFrame:
    """One entry per run, customer and order month; months with a large order completed."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    run = F.when(F.col("o_orderstatus") == "P", "run-2").otherwise("run-1")
    good = F.max("o_totalprice") > 250000
    return t.orders.groupBy(
        run.alias("run_id"), roles.customer_name("o_custkey").alias("repository"), month.alias("chunk_id")
    ).agg(
        F.when(good, "completed").otherwise("failed").alias("status"),
        F.when(good, F.count(F.lit(1))).otherwise(0).alias("issues"),
        F.when(good, F.count(F.lit(1)) * 2).otherwise(0).alias("comments"),
        F.when(~good, "timeout").alias("error"),
        F.min("o_orderdate").alias("recorded_at"),
    )


LEDGER_SQL = """
ledger AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'run-2' ELSE 'run-1' END AS run_id,
    'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS repository,
    strftime(o_orderdate, '%Y-%m') AS chunk_id,
    CASE WHEN max(o_totalprice) > 250000 THEN 'completed' ELSE 'failed' END AS status,
    CASE WHEN max(o_totalprice) > 250000 THEN count(*) ELSE 0 END AS issues,
    CASE WHEN max(o_totalprice) > 250000 THEN count(*) * 2 ELSE 0 END AS comments,
    CASE WHEN max(o_totalprice) > 250000 THEN NULL ELSE 'timeout' END AS error,
    min(o_orderdate) AS recorded_at
  FROM orders GROUP BY 1, 2, 3
)"""


@bind("backfill_ranges", f"WITH {PERIODS_SQL} SELECT * FROM periods")
def backfill_ranges(t: Tables):
    return periods(t)


@bind("month_chunks", f"WITH {CHUNKS_SQL} SELECT * FROM chunks")
def month_chunks(t: Tables):
    return backfill.month_chunks(periods(t))


@bind(
    "chunk_filter",
    f"""
    WITH {ISSUES_SQL}
    SELECT issue_id, created_at FROM issues
    WHERE created_at >= TIMESTAMP '1998-01-31' AND created_at < TIMESTAMP '1998-02-28'
    """,
)
def chunk_filter(t: Tables):
    start = backfill.parse_instant(F.lit("1998-01-31T00:00:00Z"))
    return backfill.in_chunk(roles.issues(t), start, "1998-02-28").select("issue_id", "created_at")


@bind(
    "pending_chunks",
    f"""
    WITH {CHUNKS_SQL}, {LEDGER_SQL}
    SELECT * FROM chunks c WHERE NOT EXISTS (
      SELECT 1 FROM ledger l WHERE l.repository = c.repository AND l.chunk_id = c.chunk_id AND l.status = 'completed')
    """,
)
def pending_chunks(t: Tables):
    return backfill.pending_chunks(backfill.month_chunks(periods(t)), ledger(t))


@bind(
    "chunk_load_counts",
    f"""
    WITH {CHUNKS_SQL}, {ISSUES_SQL}
    SELECT c.repository, c.chunk_index, c.chunk_id, c.chunk_start, c.chunk_end,
           count(i.issue_id) AS issues, CAST(coalesce(sum(i.comment_count), 0) AS BIGINT) AS comments
    FROM chunks c LEFT JOIN (SELECT * FROM issues WHERE NOT is_pull_request) i
      ON i.repository = c.repository AND i.created_at >= c.chunk_start AND i.created_at < c.chunk_end
    GROUP BY 1, 2, 3, 4, 5
    """,
)
def chunk_load_counts(t: Tables):
    """All chunks of all repositories in one job."""
    span = periods(t)
    issues = roles.issues(t).where(~F.col("is_pull_request"))
    talk = roles.comments(t).select(F.col("repository_full_name").alias("repository"), "issue_number")
    return backfill.chunk_load_counts(backfill.month_chunks(span), backfill.with_chunk(issues, span), talk)


START, MIDDLE, END = "1996-01-01 00:00:00", "1997-01-01 00:00:00", "1998-07-01 00:00:00"


def document(*columns: str):
    return F.parse_json(F.to_json(F.struct(*columns))).alias("raw_data")


def regional_history(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged issues, comments and repositories with documents; every region is a repository."""
    region = t.region.select("r_regionkey", F.concat(F.lit("org/"), F.lower("r_name")).alias("full_name"))
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    of_customer = placed.select(F.col("c_name").alias("repository"), F.col("full_name").alias("_region"))
    issues = roles.issues(t).join(of_customer, "repository").drop("repository").withColumnRenamed("_region", "repository")
    issues = issues.select("*", document("issue_id", "repository"))
    comments = (
        roles.comments(t)
        .join(of_customer, F.col("repository_full_name") == F.col("repository"))
        .drop("repository", "repository_full_name")
        .withColumnRenamed("_region", "repository_full_name")
        .withColumn("issue_url", F.lit("https://example.com/none"))
    )
    comments = comments.select("*", document("comment_id", "issue_number"))
    return issues, comments, region.select("full_name", document("full_name"))


def until(t: Tables, end: str) -> DataFrame:
    names = t.region.select(F.concat(F.lit("org/"), F.lower("r_name")).alias("repository"))
    return names.select("repository", *[F.lit(x).cast("timestamp_ntz").alias(c) for x, c in ((START, "range_start"), (end, "range_end"))])


@bind(
    "backfill_load",
    f"""
    WITH {ISSUES_SQL},
    loaded AS (
      SELECT issue_id, 'org/' || lower(r_name) AS repository, created_at,
             CASE WHEN created_at < TIMESTAMP '{MIDDLE}' THEN 'run-1' ELSE 'run-2' END AS run_id
      FROM issues JOIN customer ON c_name = repository JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
      WHERE NOT is_pull_request AND created_at >= TIMESTAMP '{START}' AND created_at < TIMESTAMP '{END}')
    SELECT 'issues' AS entity, run_id, repository, CAST(date_trunc('month', created_at) + INTERVAL 1 MONTH AS DATE) AS load_date,
           count(*) AS documents, CAST(sum(issue_id) AS BIGINT) AS id_sum
    FROM loaded GROUP BY ALL
    UNION ALL
    SELECT 'comments', run_id, repository, CAST(date_trunc('month', created_at) + INTERVAL 1 MONTH AS DATE),
           count(*), CAST(sum(issue_id) AS BIGINT)
    FROM loaded JOIN lineitem ON l_orderkey = issue_id GROUP BY ALL
    UNION ALL
    SELECT 'repositories', run_id, 'org/' || lower(r_name), CAST(TIMESTAMP '{AS_OF}' AS DATE), 1, NULL
    FROM region, (VALUES ('run-1'), ('run-2')) runs(run_id)
    UNION ALL
    SELECT 'ledger completed', CASE WHEN start < TIMESTAMP '{MIDDLE}' THEN 'run-1' ELSE 'run-2' END, 'org/' || lower(r_name),
           CAST(start + INTERVAL 1 MONTH AS DATE), count(DISTINCT issue_id), count(l_orderkey)
    FROM region CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}' - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS start) months
    LEFT JOIN loaded ON repository = 'org/' || lower(r_name) AND date_trunc('month', created_at) = start
    LEFT JOIN lineitem ON l_orderkey = issue_id
    GROUP BY start, r_name
    """,
)
def backfill_load(t: Tables):
    """An extract that lands a day on which chunks end; a run; a second run that is lost between
    landing and ledger, and is started again."""
    root = scratch_folder(t.spark, "backfill")
    issues, comments, repositories = regional_history(t)
    # Staged tables, written out once: three loads read them.
    issues, comments = cut_lineage(issues), cut_lineage(comments)
    ends_that_day = raw_documents(issues.limit(1000), "issues", F.col("repository"), F.lit("1996-02-01").cast("date"), AS_OF)
    write_landing(ends_that_day, f"{root}/landing", "issues")
    backfill.run_backfill(issues, comments, repositories, until(t, MIDDLE), root, "run-1", AS_OF)
    so_far = backfill.read_ledger(t.spark, root).drop("origin", "load_date")
    # The lost run: it lands and does not get to the ledger.
    backfill.load_pending(issues, comments, until(t, END), so_far, f"{root}/landing", "run-2", AS_OF, repositories=repositories)
    ledger_after = backfill.run_backfill(issues, comments, repositories, until(t, END), root, "run-2", AS_OF)

    def summed(entity: str, identity) -> DataFrame:
        rows = backfill.read_backfilled(t.spark, root, entity).select("run_id", F.col("path_repository").alias("repository"), F.col("path_date").alias("load_date"), identity.alias("id"))
        return rows.groupBy("run_id", "repository", "load_date").agg(F.count(F.lit(1)).alias("documents"), F.sum("id").alias("id_sum")).withColumn("entity", F.lit(entity))

    def number(name: str):
        return field(F.col("raw_data"), f"$.{name}", "bigint")

    entries = ledger_after.select(
        F.concat(F.lit("ledger "), "status").alias("entity"), "run_id", "repository", "load_date", F.col("issues").alias("documents"), F.col("comments").alias("id_sum")
    )
    parts = [summed("comments", number("issue_number")), summed("repositories", F.lit(None).cast("bigint")), entries]
    every = summed("issues", number("issue_id"))
    for part in parts:
        every = every.unionByName(part)
    return every.select("entity", "run_id", "repository", "load_date", "documents", "id_sum")


@bind(
    "ledger_update",
    f"""
    WITH {LEDGER_SQL}
    SELECT run_id, repository, chunk_id, 'completed' AS status,
      CASE WHEN status = 'failed' THEN CAST(1 AS BIGINT) ELSE issues END AS issues,
      CASE WHEN status = 'failed' THEN CAST(0 AS BIGINT) ELSE comments END AS comments,
      error IS NOT NULL AND status <> 'failed' AS has_error,
      CASE WHEN status = 'failed' THEN TIMESTAMP '{AS_OF}' ELSE recorded_at END AS recorded_at
    FROM ledger
    """,
)
def ledger_update(t: Tables):
    """The failed chunks of both runs are loaded again; their entries are replaced."""
    entries = ledger(t)
    retried = entries.where("status = 'failed'").withColumns({"issues": F.lit(1).cast("bigint"), "comments": F.lit(0).cast("bigint")})
    done = [
        backfill.completed_entries(retried.where(F.col("run_id") == run), run, AS_OF) for run in ("run-1", "run-2")
    ]
    updated = backfill.update_ledger(entries, done[0].unionByName(done[1]))
    return updated.withColumn("has_error", F.col("error").isNotNull()).drop("error").withColumns(
        {"issues": F.col("issues").cast("bigint"), "comments": F.col("comments").cast("bigint")}
    )


@bind(
    "failed_chunk_streak",
    f"""
    WITH {LEDGER_SQL},
    placed AS (SELECT *, row_number() OVER (PARTITION BY run_id, repository ORDER BY chunk_id) -
                         row_number() OVER (PARTITION BY run_id, repository, status ORDER BY chunk_id) AS island
               FROM ledger),
    streaks AS (SELECT *, CASE WHEN status = 'failed' THEN
                  row_number() OVER (PARTITION BY run_id, repository, status, island ORDER BY chunk_id) ELSE 0 END AS streak
                FROM placed)
    SELECT run_id, repository, max(streak) AS longest_streak,
           min(CASE WHEN streak >= 3 THEN chunk_id END) AS stopped_at, max(streak) >= 3 AS is_stopped
    FROM streaks GROUP BY run_id, repository
    """,
)
def failed_chunk_streak(t: Tables):
    return backfill.failure_streaks(ledger(t), 3)


STATUS_SQL = f"""
{CHUNKS_SQL}, {LEDGER_SQL},
tried AS (SELECT repository, chunk_id, bool_or(status = 'completed') AS done FROM ledger GROUP BY 1, 2),
progress AS (
  SELECT c.repository, count(*) AS planned_chunks, count(*) FILTER (done) AS completed_chunks,
         count(*) FILTER (NOT done) AS failed_chunks
  FROM chunks c LEFT JOIN tried t ON t.repository = c.repository AND t.chunk_id = c.chunk_id GROUP BY c.repository),
placed AS (SELECT *, row_number() OVER (PARTITION BY run_id, repository ORDER BY chunk_id) -
                     row_number() OVER (PARTITION BY run_id, repository, status ORDER BY chunk_id) AS island FROM ledger),
streaks AS (SELECT repository, count(*) AS streak FROM placed WHERE status = 'failed' GROUP BY run_id, repository, island),
stopped AS (SELECT repository, bool_or(streak >= 3) AS is_stopped FROM streaks GROUP BY repository),
repository_status AS (
  SELECT progress.*, CASE WHEN completed_chunks = planned_chunks THEN 'completed'
                          WHEN coalesce(is_stopped, FALSE) THEN 'failed'
                          WHEN completed_chunks + failed_chunks = 0 THEN 'not_started' ELSE 'in_progress' END AS status
  FROM progress LEFT JOIN stopped ON stopped.repository = progress.repository
)"""


@bind("repository_status", f"WITH {STATUS_SQL} SELECT * FROM repository_status")
def repository_status(t: Tables):
    return backfill.repository_status(backfill.month_chunks(periods(t)), ledger(t), 3)


@bind(
    "resumable_repos",
    f"WITH {STATUS_SQL} SELECT * FROM repository_status WHERE status IN ('not_started', 'in_progress')",
)
def resumable_repos(t: Tables):
    return backfill.resumable_repositories(repository_status(t))


@bind(
    "last_processed_chunk",
    f"""
    WITH {LEDGER_SQL}
    SELECT repository, max(chunk_id) AS last_processed_chunk, count(*) AS chunks_completed
    FROM ledger WHERE status = 'completed' GROUP BY repository
    """,
)
def last_processed_chunk(t: Tables):
    return backfill.last_processed_chunk(ledger(t))


@bind(
    "run_summary",
    f"""
    WITH {LEDGER_SQL}
    SELECT run_id, status, count(*) AS chunks, count(DISTINCT repository) AS repositories,
           CAST(sum(issues) AS BIGINT) AS total_issues, CAST(sum(comments) AS BIGINT) AS total_comments
    FROM ledger GROUP BY run_id, status
    """,
)
def run_summary(t: Tables):
    return backfill.run_summary(ledger(t))


@bind(
    "list_runs",
    f"""
    WITH {LEDGER_SQL}
    SELECT run_id, min(recorded_at) AS started_at, max(recorded_at) AS last_updated,
           count(DISTINCT repository) AS repositories, count(*) FILTER (status = 'failed') AS total_errors
    FROM ledger GROUP BY run_id ORDER BY started_at DESC, run_id
    """,
)
def list_runs(t: Tables):
    return backfill.list_runs(ledger(t))
