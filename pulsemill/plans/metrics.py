"""Derived columns of issues and repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.buckets import flag, guarded_ratio, labelled, ladder
from pulsemill.functions.temporal import (
    AsOf,
    as_of_timestamp,
    days_between,
    hours_between,
    months_between_boundaries,
    years_between,
)

# Upper limits (exclusive) and labels, in order.
RESOLUTION_HOURS = [(1, "Closed <1 hour"), (24, "Closed <1 day")]
RESOLUTION_DAYS = [(7, "Closed <1 week"), (30, "Closed <1 month")]
RESOLUTION_OPEN = "Open"
RESOLUTION_SLOW = "Closed >1 month"
PUSH_AGE_DAYS = [(7, "Very Active"), (30, "Active"), (90, "Moderate"), (365, "Low Activity")]
PUSH_AGE_OLD = "Inactive"
TITLE_LENGTHS = [(30, "Short"), (80, "Medium")]
TITLE_LONG = "Long"
# Lower limits (inclusive) and labels, in order.
STAR_TIERS = [
    (10000, "Very Popular (10K+ stars)"),
    (1000, "Popular (1K-10K stars)"),
    (100, "Growing (100-1K stars)"),
]
STAR_TIER_LOWEST = "Emerging (<100 stars)"
# Inclusive ranges of the comment count and labels.
COMMENT_RANGES = [(0, 0, "No comments"), (1, 5, "Low activity"), (6, 20, "Medium activity")]
COMMENTS_MANY = "High activity"


def resolution_bucket(created: Column, closed: Column) -> Column:
    hours, days = hours_between(created, closed), days_between(created, closed)
    rules = [(closed.isNull(), RESOLUTION_OPEN)]
    rules += [(hours < limit, label) for limit, label in RESOLUTION_HOURS]
    rules += [(days < limit, label) for limit, label in RESOLUTION_DAYS]
    return labelled(rules, RESOLUTION_SLOW)


def activity_level(comments: Column) -> Column:
    return labelled(
        [(comments.between(low, high), label) for low, high, label in COMMENT_RANGES], COMMENTS_MANY
    )


def title_category(title: Column) -> Column:
    return ladder(F.length(title), TITLE_LENGTHS, TITLE_LONG)


def activity_status(days_since_push: Column) -> Column:
    return ladder(days_since_push, PUSH_AGE_DAYS, PUSH_AGE_OLD)


def popularity_tier(stars: Column) -> Column:
    return labelled([(stars >= limit, label) for limit, label in STAR_TIERS], STAR_TIER_LOWEST)


def issue_metrics(issues: DataFrame, as_of: AsOf) -> DataFrame:
    """Staged issues with time to close, age, labels and flags."""
    created, closed = F.col("created_at"), F.col("closed_at")
    return issues.withColumns(
        {
            "hours_to_close": hours_between(created, closed),
            "days_to_close": days_between(created, closed),
            "age_in_days": days_between(created, as_of_timestamp(as_of)),
            "resolution_time_bucket": resolution_bucket(created, closed),
            "activity_level": activity_level(F.col("comment_count")),
            "has_assignee": F.col("assignee_username").isNotNull(),
            "has_labels": flag(F.col("label_count") > 0),
            "has_milestone": F.col("milestone_title").isNotNull(),
            "issue_type": F.when(F.col("is_pull_request"), "Pull Request").otherwise("Issue"),
            "title_length_category": title_category(F.col("title")),
        }
    )


def repository_metrics(repositories: DataFrame, as_of: AsOf) -> DataFrame:
    """Staged repositories with age, activity, popularity and ratios per star."""
    now, created, stars = as_of_timestamp(as_of), F.col("created_at"), F.col("stars_count")
    since_push = days_between(F.col("pushed_at"), now)
    return repositories.withColumns(
        {
            "age_in_days": days_between(created, now),
            "age_in_months": months_between_boundaries(created, now),
            "age_in_years": years_between(created, now),
            "days_since_last_push": since_push,
            "activity_status": activity_status(since_push),
            "popularity_tier": popularity_tier(stars),
            "engagement_rate": guarded_ratio(F.col("watchers_count"), stars),
            "fork_rate": guarded_ratio(F.col("forks_count"), stars),
            "issue_density": guarded_ratio(F.col("open_issues_count"), stars),
        }
    )
