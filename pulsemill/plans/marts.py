"""Dimensions, facts and the event timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.buckets import labelled
from pulsemill.functions.temporal import (
    AsOf,
    as_of_date,
    as_of_timestamp,
    days_between,
    hours_between,
)
from pulsemill.functions.text import coalesce_null, surrogate_key
from pulsemill.operators.dedup import latest_by_key
from pulsemill.operators.ranking import (
    HOT_ROWS,
    hot_groups,
    number_plainly,
    sequence_in_slices,
    slices_for,
    split_hot,
)
from pulsemill.operators.spine import date_spine

# Fixed value: columns of the repository dimension.
REPOSITORY_DIMENSION = """
repository_id repository_name full_name owner_username owner_type description
primary_language topics_count license_name is_private is_fork is_archived is_disabled
has_issues_enabled has_projects_enabled has_wiki_enabled has_pages_enabled has_downloads_enabled
stars_count forks_count watchers_count open_issues_count size_kb
popularity_tier engagement_rate fork_rate issue_density activity_status
age_in_days age_in_months age_in_years days_since_last_push
created_at updated_at pushed_at html_url homepage_url default_branch extraction_date loaded_at
""".split()

# First day of the calendar, days after "now" it ends (exclusive).
CALENDAR_START = "2015-01-01"
CALENDAR_LEAD_DAYS = 7

# Age in days above which an open issue takes a label, in order.
OPEN_STAGES = [(90, "Stale"), (30, "Long-running")]


def dim_repository(repositories: DataFrame, as_of: AsOf) -> DataFrame:
    """Current row per repository."""
    newest = [
        F.col("loaded_at").desc_nulls_last(),
        F.col("updated_at").desc_nulls_last(),
        F.col("full_name").desc_nulls_last(),
    ]
    return latest_by_key(repositories.select(*REPOSITORY_DIMENSION), ["repository_id"], newest).withColumn(
        "dbt_updated_at", as_of_timestamp(as_of)
    )


def calendar_bounds(spark, as_of: AsOf) -> DataFrame:
    return spark.range(1).select(
        F.to_date(F.lit(CALENDAR_START)).alias("start_date"),
        F.date_add(as_of_date(as_of), CALENDAR_LEAD_DAYS).alias("end_date"),
    )


def dim_date(bounds: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per day with its calendar parts; weeks are ISO, Sunday is day 0."""
    day, today = F.col("date_day"), as_of_date(as_of)
    weekday = F.dayofweek(day) - 1
    return date_spine(bounds).select(
        day.alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        weekday.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias("year_quarter"),
        F.date_format(day, "MMM yyyy").alias("month_name"),
        F.dayname(day).alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        (day == today).alias("is_today"),
        (F.year(day) == F.year(today)).alias("is_current_year"),
    )


def repo_activity_daily(issues: DataFrame, repositories: DataFrame, as_of: AsOf) -> DataFrame:
    """Activity per creation day and repository; unknown repositories share a group.

    ``issues`` is the metrics model, one row per issue, and each issue reaches a
    group once, so counting rows equals counting distinct issues. That leaves one
    distinct aggregate (contributors): no row is copied per aggregate, and the first
    exchange is by group *and* contributor, which spreads a hot group. Sums and the
    median's value counts are combined before each exchange.

    The repository side is joined without a hint: it is broadcast only if its
    measured size allows, otherwise sort-merged with hot names split at run time.
    """
    issue = issues.select(
        "issue_id",
        F.to_date("created_at").cast("timestamp_ntz").alias("activity_date"),
        F.col("closed_at").isNotNull().alias("is_closed"),
        "is_pull_request",
        "comment_count",
        "author_username",
        "has_assignee",
        "has_labels",
        "hours_to_close",
        "repository",
    )
    repo = repositories.select(
        "repository_id",
        "repository_name",
        F.col("full_name").alias("repository_full_name"),
        "owner_username",
        "stars_count",
        "forks_count",
        "open_issues_count",
    )
    joined = issue.join(repo, issue["repository"] == repo["repository_full_name"], "left")

    def issues_where(condition):
        return F.count(F.when(condition, F.col("issue_id")))

    is_pr, closed = F.col("is_pull_request"), F.col("is_closed")
    hours_if_closed = F.when(closed, F.col("hours_to_close"))
    keys = ["activity_date", "repository_id", "repository_name", "repository_full_name", "owner_username"]
    grouped = joined.groupBy(*keys).agg(
        F.count("issue_id").alias("total_issues_created"),
        issues_where(is_pr).alias("pull_requests_created"),
        issues_where(~is_pr).alias("issues_created"),
        issues_where(closed).alias("issues_closed"),
        issues_where(closed & is_pr).alias("pull_requests_closed"),
        F.sum("comment_count").alias("total_comments"),
        F.avg("comment_count").alias("avg_comments_per_issue"),
        F.count_distinct("author_username").alias("unique_contributors"),
        issues_where(F.col("has_assignee")).alias("assigned_issues"),
        issues_where(F.col("has_labels")).alias("labeled_issues"),
        F.avg(hours_if_closed).alias("avg_hours_to_close"),
        F.median(hours_if_closed).alias("median_hours_to_close"),
        F.max("stars_count").alias("current_stars"),
        F.max("forks_count").alias("current_forks"),
        F.max("open_issues_count").alias("current_open_issues"),
    )
    day = F.date_format("activity_date", "yyyy-MM-dd")
    key = F.concat(day, F.lit("_"), coalesce_null(F.col("repository_id"), "unknown"))
    return grouped.select(
        key.alias("fct_key"), *grouped.columns, as_of_timestamp(as_of).alias("dbt_updated_at")
    )


def issue_lifecycle(issues: DataFrame, repositories: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per issue with its repository, durations and stage."""
    issue = issues.select(
        "issue_id",
        "issue_number",
        "title",
        F.col("repository").alias("repository_full_name"),
        "created_at",
        "updated_at",
        "closed_at",
        "state",
        "is_pull_request",
        "author_username",
        "author_id",
        "comment_count",
        F.col("labels_json").alias("labels"),
        "html_url",
    )
    repo = repositories.select("repository_id", F.col("full_name").alias("_full_name"), "owner_username")
    joined = issue.join(repo, issue["repository_full_name"] == repo["_full_name"], "left")

    now, created = as_of_timestamp(as_of), F.col("created_at")
    until = F.coalesce(F.col("closed_at"), now)
    state, age = F.col("state"), days_between(created, now)
    stage_rules = [(state == "closed", "Completed")]
    stage_rules += [(age > limit, label) for limit, label in OPEN_STAGES]
    return joined.select(
        "issue_id",
        "issue_number",
        "title",
        "repository_id",
        "repository_full_name",
        "owner_username",
        "created_at",
        "updated_at",
        "closed_at",
        F.to_date("created_at").alias("created_date"),
        F.to_date("closed_at").alias("closed_date"),
        F.to_date("updated_at").alias("updated_date"),
        "state",
        labelled([(state == "closed", "Closed"), (state == "open", "Open")], "Unknown").alias("status_label"),
        days_between(created, until).alias("duration_days"),
        hours_between(created, until).alias("duration_hours"),
        labelled(stage_rules, "Active").alias("lifecycle_stage"),
        "is_pull_request",
        "author_username",
        "author_id",
        "comment_count",
        "labels",
        "html_url",
        surrogate_key(F.col("issue_id")).alias("issue_key"),
    )


COMMENT_PARENT = ["repository_full_name", "issue_number"]


def comment_key():
    return surrogate_key(F.col("comment_id"))


def comment_derived():
    """Columns of the comment fact that follow from its other ones."""
    return {"comment_key": comment_key(), "comment_length": F.length("comment_body"), "comment_date_key": F.to_date("comment_date")}


def comment_order():
    return [F.col("created_at").asc_nulls_last(), F.col("comment_id").asc_nulls_last()]


def comment_fact(comments: DataFrame, lifecycle: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row per comment on a known issue, with its place in the discussion.

    An issue is one (repository, number), so comments are numbered by those columns
    *before* the join: the window's exchange and order serve the join as well, and
    the wide comment rows move once. An issue with more than ``hot_rows`` comments is
    numbered in slices instead, and its few parent rows are broadcast.
    """
    comment = comments.select(
        "comment_id",
        *COMMENT_PARENT,
        "created_at",
        "updated_at",
        "author_username",
        "author_id",
        "body",
        "html_url",
    ).dropna(subset=COMMENT_PARENT)
    parent = lifecycle.select("issue_id", *COMMENT_PARENT).where(F.col("issue_id").isNotNull())

    def attach(numbered: DataFrame, parents: DataFrame) -> DataFrame:
        return numbered.join(parents, COMMENT_PARENT)

    def plainly(rows: DataFrame) -> DataFrame:
        return attach(number_plainly(rows, COMMENT_PARENT, comment_order(), "comment_sequence"), parent)

    slices = 0
    if hot_rows is not None:
        hot = hot_groups(comment, COMMENT_PARENT, hot_rows)
        slices = slices_for(hot, hot_rows)
    if slices:
        ordinary, big = split_hot(comment, COMMENT_PARENT, hot)
        numbered = sequence_in_slices(big, COMMENT_PARENT, comment_order(), "comment_sequence", slices)
        few = hot.select(*COMMENT_PARENT)
        hot_parents = parent.join(F.broadcast(few), COMMENT_PARENT, "left_semi")
        facts = plainly(ordinary).unionByName(attach(numbered, hot_parents))
    else:
        facts = plainly(comment)
    return facts.select(
        "comment_id",
        "issue_id",
        "issue_number",
        "repository_full_name",
        F.col("created_at").alias("comment_date"),
        F.col("updated_at").alias("comment_updated_at"),
        F.to_date("created_at").alias("comment_date_key"),
        "author_username",
        "author_id",
        F.col("body").alias("comment_body"),
        F.length("body").alias("comment_length"),
        "html_url",
        "comment_sequence",
        comment_key().alias("comment_key"),
    )


def issue_timeline(lifecycle: DataFrame, comments: DataFrame, as_of: AsOf) -> DataFrame:
    """Start, comment and end events of every issue at one grain.

    Start and end come from one pass over the issues. Open issues end today, so that
    their bar has a length. Comments take title, state and stage from their issue.
    """
    issue = lifecycle.select(
        "issue_id",
        F.col("title").alias("issue_title"),
        "state",
        "lifecycle_stage",
        "created_at",
        "closed_at",
    )
    today = as_of_date(as_of).cast("timestamp_ntz")
    ends = F.array(
        F.struct(F.col("created_at").alias("event_date"), F.lit("ISSUE_START").alias("event_type")),
        F.struct(
            F.coalesce(F.col("closed_at"), today).alias("event_date"), F.lit("ISSUE_END").alias("event_type")
        ),
    )
    shown = ["issue_id", "issue_title", "state", "lifecycle_stage"]
    bars = issue.select(*shown, F.inline(ends)).withColumn("comment_body", F.lit(None).cast("string"))
    remarks = (
        comments.select("issue_id", "comment_date", "comment_body")
        .join(issue, "issue_id")
        .select(
            *shown,
            F.col("comment_date").alias("event_date"),
            F.lit("COMMENT").alias("event_type"),
            "comment_body",
        )
    )
    return bars.unionByName(remarks)


def within_dates(fact: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Rows of any fact whose date key is one of the calendar's days."""
    return fact.join(calendar.select(F.col("date_key").alias(day)), day, "left_semi")
