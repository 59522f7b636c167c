"""From RAW to published marts in dependency order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.temporal import AsOf
from pulsemill.plans import incremental, marts, metrics, quality, staging
from pulsemill.session import cut_lineage, passing_cuts
from pulsemill.sources.tables import (
    batches_of,
    consumed_files,
    files_of,
    publish_table,
    publish_view,
    read_table,
    replace_partitions,
    stored,
)

# Partition columns of the incremental facts: months, so that files stay few and large.
DAILY_MONTH = "activity_month"
COMMENT_MONTH = "comment_month"

# Order of the comment fact's rows in their files: an issue's comments lie together.
COMMENT_ROWS = ["issue_id", "comment_sequence"]


def month_of(date) -> Column:
    """First day of the month; rows without a date share one month."""
    return F.coalesce(F.trunc(date, "month"), F.lit("1970-01-01").cast("date"))


def by_month(fact: DataFrame, date: str, month: str) -> DataFrame:
    return fact.withColumn(month, month_of(date))


def refresh_daily_table(
    spark: SparkSession, path: str, issues: DataFrame, repositories: DataFrame, as_of: AsOf, full_refresh: bool
) -> None:
    """Rewrite only the months that files since the last refresh touch.

    The files are committed with the rows, so a refresh that is lost halfway finds them
    new again.
    """
    consumed = files_of({incremental.ISSUES: issues, incremental.REPOSITORIES: repositories})

    def rows(some: DataFrame) -> DataFrame:
        return by_month(marts.repo_activity_daily(some, repositories, as_of), "activity_date", DAILY_MONTH)

    target = None if full_refresh else stored(spark, path)
    if target is None:
        publish_table(rows(issues), path, [DAILY_MONTH], consumed)
        return
    days = incremental.changed_days(issues, repositories, target, consumed_files(spark, path))
    months = cut_lineage(days.select(month_of("activity_date").alias(DAILY_MONTH)).distinct())
    # Months of a calendar are few.
    touched = [r[0] for r in months.collect()]
    affected = issues.join(months, month_of(issues["created_at"]) == months[DAILY_MONTH], "left_semi")
    replace_partitions(rows(affected), path, DAILY_MONTH, touched, consumed)


def changed_months(delta: DataFrame, target: DataFrame, touched: DataFrame) -> tuple[dict, list]:
    """(rows that the months to rewrite will have, those months with stored rows of issues that are not touched).

    ``touched`` is distinct. Months of a calendar are few.
    """
    parents = touched.select(*marts.COMMENT_PARENT, F.lit(True).alias("_touched"))
    marked = target.select(*marts.COMMENT_PARENT, COMMENT_MONTH).join(parents, marts.COMMENT_PARENT, "left")
    old = marked.select(COMMENT_MONTH, F.col("_touched").isNull().alias("_kept"), F.lit(False).alias("_new"))
    new = delta.select(COMMENT_MONTH, F.lit(False).alias("_kept"), F.lit(True).alias("_new"))
    counts = [F.count_if(c).alias(c) for c in ("_kept", "_new")]
    found = old.unionByName(new).groupBy(COMMENT_MONTH).agg(*counts, F.bool_and("_kept").alias("_as_before"))
    changed = found.where("NOT _as_before").orderBy(COMMENT_MONTH).collect()
    return {r[COMMENT_MONTH]: r["_kept"] + r["_new"] for r in changed}, [r[COMMENT_MONTH] for r in changed if r["_kept"]]


def refresh_comment_table(
    spark: SparkSession, path: str, comments: DataFrame, lifecycle: DataFrame, issues: DataFrame, full_refresh: bool
) -> None:
    """Number the comments of touched issues anew and rewrite the months they lie in.

    The stored rows of such a month are read only if some of them belong to other issues. What
    is numbered is written out first, so its shuffles are gone when the months are dealt.
    """
    consumed = files_of({incremental.COMMENTS: comments, incremental.ISSUES: issues})
    derived = marts.comment_derived()

    def rows(fact: DataFrame) -> DataFrame:
        return by_month(fact, "comment_date_key", COMMENT_MONTH)

    target = None if full_refresh else stored(spark, path)
    with passing_cuts(spark) as cut:
        if target is None:
            fact = rows(marts.comment_fact(comments, lifecycle))
            numbered = cut(fact.drop(*derived))
            sizes = {r[0]: r[1] for r in numbered.groupBy(COMMENT_MONTH).count().orderBy(COMMENT_MONTH).collect()}
            whole = numbered.withColumns(derived).select(*fact.columns)
            publish_table(whole, path, [COMMENT_MONTH], consumed, derived=derived, order=COMMENT_ROWS, batches=batches_of(sizes))
            return
        touched = cut(incremental.touched_parents(comments, issues, target, consumed_files(spark, path)))
        delta = cut(rows(incremental.comment_delta(comments, lifecycle, touched)).drop(*derived))
        sizes, mixed = changed_months(delta, target, touched)
        rest = target.where(F.col(COMMENT_MONTH).isin(mixed)).join(touched, marts.COMMENT_PARENT, "left_anti")
        merged = rest.drop(*derived).unionByName(delta, allowMissingColumns=True).withColumns(derived).select(*target.columns)
        replace_partitions(
            merged, path, COMMENT_MONTH, list(sizes), consumed, derived=derived, order=COMMENT_ROWS, batches=batches_of(sizes)
        )


def build_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    as_of: AsOf,
    full_refresh: bool = False,
) -> DataFrame:
    """Build every model below ``root``; gives the results of the declared checks.

    The checks of the staging models run first: if one ends in error, ``ValueError`` is
    raised and no mart is touched. Recency and freshness of RAW and the checks of the
    marts are reported.

    ``raw`` holds the RAW frames ``issues``, ``repositories`` and ``comments``. Staging is
    views; metrics and marts are tables, so each document is parsed once per build;
    facts are refreshed incrementally unless ``full_refresh`` is set.
    """
    issues = publish_view(staging.stage_issues(raw["issues"]), "stg_issues")
    repositories = publish_view(staging.stage_repositories(raw["repositories"]), "stg_repositories")
    comments = publish_table(staging.stage_comments(raw["comments"]), f"{root}/intermediate/comments")
    publish_view(comments, "stg_comments")

    issue_rows = publish_table(metrics.issue_metrics(issues, as_of), f"{root}/intermediate/int_issue_metrics")
    repo_rows = publish_table(
        metrics.repository_metrics(repositories, as_of), f"{root}/intermediate/int_repository_metrics"
    )

    staged = cut_lineage(quality.staging_checks(issue_rows, repo_rows, comments))
    quality.require_passed(staged)
    loads = [quality.table_checks(df, f"raw_{name}", loads=[quality.Load("loaded_at", as_of)]) for name, df in raw.items()]

    marts_root = f"{root}/marts"
    dates = publish_table(marts.dim_date(marts.calendar_bounds(spark, as_of), as_of), f"{marts_root}/dim_date")
    dim = publish_table(marts.dim_repository(repo_rows, as_of), f"{marts_root}/dim_repository")
    lifecycle = publish_table(
        marts.issue_lifecycle(issue_rows, repo_rows, as_of), f"{marts_root}/fct_issue_lifecycle"
    )
    daily_path = f"{marts_root}/fct_repo_activity_daily"
    refresh_daily_table(spark, daily_path, issue_rows, repo_rows, as_of, full_refresh)
    comment_path = f"{marts_root}/fct_issue_comments"
    refresh_comment_table(spark, comment_path, comments, lifecycle, issue_rows, full_refresh)

    publish_view(read_table(spark, daily_path).drop(DAILY_MONTH), "fct_repo_activity_daily")
    facts = publish_view(read_table(spark, comment_path).drop(COMMENT_MONTH), "fct_issue_comments")
    publish_view(dates, "dim_date")
    publish_view(dim, "dim_repository")
    publish_view(lifecycle, "fct_issue_lifecycle")
    publish_view(marts.issue_timeline(lifecycle, facts, as_of), "issue_timeline")
    return quality.combine(
        [
            staged,
            *loads,
            quality.mart_checks(dim, lifecycle, facts, dates),
        ]
    )
