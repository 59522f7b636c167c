"""Selecting what a daily extract keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.temporal import AsOf, as_of_date
from pulsemill.operators.ranking import HOT_ROWS, top_n_within
from pulsemill.sources.landing import raw_documents, write_landing

# Fixed value: default of the daily extract.
LOOKBACK_DAYS = 7


def updated_within(df: DataFrame, as_of: AsOf, days: int, column: str = "updated_at") -> DataFrame:
    """Rows updated since ``days`` days before the given date.

    Reading a few days again on every run picks up late changes; keeping the latest
    load per key absorbs the repeats.
    """
    since = F.date_sub(as_of_date(as_of), days).cast("timestamp_ntz")
    return df.where(F.col(column) >= since)


def newest_per_repository(
    issues: DataFrame, cap: int, key: str = "issue_id", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """The ``cap`` most recently updated issues of each repository."""
    order = [F.col("updated_at").desc_nulls_last(), F.col(key).asc_nulls_last()]
    return top_n_within(issues, ["repository"], order, cap, "recency_rank", hot_rows)


def without_pull_requests(issues: DataFrame) -> DataFrame:
    return issues.where(~F.col("is_pull_request"))


def issue_pr_split(issues: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many items are plain issues and how many are pull requests."""
    is_pr = F.col("is_pull_request")
    return issues.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(~is_pr).alias("issue_count"),
        F.count_if(is_pr).alias("pull_request_count"),
    )


def land_daily_extract(
    issues: DataFrame,
    comments: DataFrame,
    repositories: DataFrame,
    enabled: DataFrame,
    root: str,
    day: str,
    lookback_days: int = LOOKBACK_DAYS,
    cap: int | None = None,
) -> None:
    """Land what one day's extract keeps of the enabled repositories.

    The frames are staged with their documents kept; ``enabled`` has ``full_name``.
    Issues (pull requests included) are those updated within the lookback, all of them
    unless ``cap`` asks for the newest of each repository only; comments are those updated within the lookback. Landing a
    day again replaces it.
    """

    def of_enabled(rows: DataFrame, name: str) -> DataFrame:
        names = enabled.select(F.col("full_name").alias(name))
        return rows.join(names, name, "left_semi")

    kept_issues = updated_within(of_enabled(issues, "repository"), day, lookback_days)
    if cap is not None:
        kept_issues = newest_per_repository(kept_issues, cap)
    kept_comments = updated_within(of_enabled(comments, "repository_full_name"), day, lookback_days)
    for entity, rows, name in (
        ("issues", kept_issues, "repository"),
        ("comments", kept_comments, "repository_full_name"),
        ("repositories", of_enabled(repositories, "full_name"), "full_name"),
    ):
        write_landing(raw_documents(rows, entity, F.col(name), F.lit(day), day), root, entity)


def children_of(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Comments of the given issues; issues that say they have none are skipped."""
    busy = parents.where(F.col("comment_count") > 0).select(*keys)
    return children.join(busy, keys, "left_semi")
