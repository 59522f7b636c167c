"""Refreshing facts from what changed instead of from everything.

A fact knows which source files (by name and load time) its rows stand for. Rows of any
other file are new to it, whatever their event times are and whether the file is older or
younger than those before it or carries the same time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.temporal import AsOf, as_of_timestamp
from pulsemill.operators.upsert import replace_where_matched, upsert
from pulsemill.plans.marts import COMMENT_PARENT, comment_fact, repo_activity_daily
from pulsemill.session import cut_lineage
from pulsemill.sources.tables import not_consumed

# Names of the sources in the list of consumed files.
ISSUES, REPOSITORIES, COMMENTS = "issues", "repositories", "comments"


def high_water_mark(table: DataFrame, column: str) -> datetime | None:
    """Largest stored value, None for an empty table.

    Fetched as one value so that the filter built from it is a literal, which
    reaches the file scan; a subquery would not.
    """
    return table.agg(F.max(column)).first()[0]


def after_day(df: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Rows of days later than the mark's day; all rows without a mark."""
    if mark is None:
        return df
    return df.where(F.col(column) >= as_of_timestamp(mark) + F.expr("interval 1 day"))


def append_daily(
    issues: DataFrame, repositories: DataFrame, target: DataFrame, as_of: AsOf
) -> DataFrame:
    """Add days after the last stored one, by key.

    Cheap, but blind to what happens later to a stored day: see ``refresh_daily``.
    """
    fresh = after_day(issues, "created_at", high_water_mark(target, "activity_date"))
    return upsert(target, repo_activity_daily(fresh, repositories, as_of), ["fct_key"])


def day_of(column: str):
    return F.to_date(column).cast("timestamp_ntz").alias("activity_date")


def changed_days(issues: DataFrame, repositories: DataFrame, target: DataFrame, consumed: DataFrame) -> DataFrame:
    """Days of the daily fact that files outside ``consumed`` touch, whatever their event times.

    Days of issues from such files, of all issues of repositories from such files, and the
    stored days of those repositories (they may have had another name). Distinct calendar
    days, a few ten thousand in a century.
    """
    fresh = not_consumed(repositories, consumed, REPOSITORIES)
    names = fresh.select(F.col("full_name").alias("repository")).distinct()
    own = not_consumed(issues, consumed, ISSUES).select(day_of("created_at"))
    of_parents = issues.join(names, "repository", "left_semi").select(day_of("created_at"))
    before = target.join(fresh.select("repository_id").distinct(), "repository_id", "left_semi").select("activity_date")
    return own.unionByName(of_parents).unionByName(before).distinct()


def daily_delta(issues: DataFrame, repositories: DataFrame, days: DataFrame, as_of: AsOf) -> DataFrame:
    """The daily fact for the given days only, from all issues of those days."""
    on_day = F.to_date(issues["created_at"]).cast("timestamp_ntz") == days["activity_date"]
    return repo_activity_daily(issues.join(days, on_day, "left_semi"), repositories, as_of)


def refresh_daily(
    issues: DataFrame, repositories: DataFrame, target: DataFrame, consumed: DataFrame, as_of: AsOf
) -> DataFrame:
    """The daily fact after the files that the stored one does not stand for; equal to a full rebuild.

    ``issues`` and ``repositories`` carry ``source_file`` and ``loaded_at``. Days of changed
    issues and of changed repositories are recomputed, so groups that no longer exist go
    away.
    """
    days = cut_lineage(changed_days(issues, repositories, target, consumed))
    delta = daily_delta(issues, repositories, days, as_of)
    return replace_where_matched(target, delta, days, ["activity_date"])


def touched_parents(comments: DataFrame, issues: DataFrame, target: DataFrame, consumed: DataFrame) -> DataFrame:
    """Issues, as (repository, number), whose comments files outside ``consumed`` can change.

    Those of comments and of issues from such files, and those under which the fact has
    these comments and issues so far.
    """
    fresh_comments, fresh_issues = not_consumed(comments, consumed, COMMENTS), not_consumed(issues, consumed, ISSUES)
    of_issues = fresh_issues.select(F.col("repository").alias(COMMENT_PARENT[0]), F.col("issue_number").alias(COMMENT_PARENT[1]))
    # By hash, as ids are long; two ids with one hash add an issue to the list, which changes nothing.
    hashed = F.xxhash64("comment_id").alias("_hash")
    moved_comments = target.select(hashed, *COMMENT_PARENT).join(fresh_comments.select(hashed).distinct(), "_hash", "left_semi")
    moved_issues = target.join(fresh_issues.select("issue_id").distinct(), "issue_id", "left_semi")
    parts = [of_issues, moved_comments.select(*COMMENT_PARENT), moved_issues.select(*COMMENT_PARENT)]
    every = fresh_comments.select(*COMMENT_PARENT)
    for part in parts:
        every = every.unionByName(part)
    return every.dropna().distinct()


def comment_delta(comments: DataFrame, lifecycle: DataFrame, touched: DataFrame) -> DataFrame:
    """The comment fact of the touched issues, numbered from their full history."""
    return comment_fact(comments.join(touched, COMMENT_PARENT, "left_semi"), lifecycle)


def refresh_comments(
    comments: DataFrame, lifecycle: DataFrame, issues: DataFrame, target: DataFrame, consumed: DataFrame
) -> DataFrame:
    """The comment fact after the files that the stored one does not stand for; equal to a full rebuild.

    ``comments`` and ``issues`` carry ``source_file`` and ``loaded_at``; ``lifecycle`` is made
    from ``issues``. The list of touched issues is written out: joined straight from its
    grouping, the other side could not be split where one issue holds very many comments.
    """
    touched = cut_lineage(touched_parents(comments, issues, target, consumed))
    delta = comment_delta(comments, lifecycle, touched)
    return replace_where_matched(target, delta, touched, COMMENT_PARENT)
