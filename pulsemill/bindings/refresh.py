"""Incremental refreshes; each must give what a full rebuild gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.bindings import roles
from pulsemill.bindings.models import (
    DAILY_SQL,
    FACTS_WITH,
    countable,
    issue_metrics,
    known_metrics,
)
from pulsemill.bindings.roles import AS_OF, Tables, binder
from pulsemill.plans import build, incremental, marts, metrics
from pulsemill.session import cut_lineage, scratch_folder
from pulsemill.sources import files_of, publish_table, read_table

BOUND: dict = {}
bind = binder(BOUND)

EARLIER = "2000-01-01 00:00:00"
FIRST_LOAD, SECOND_LOAD = "2001-01-01 00:00:00", "2001-02-01 00:00:00"
NOT_COMPARED = ("dbt_updated_at", build.DAILY_MONTH, build.COMMENT_MONTH)
EARLY_FILE, LATE_FILE = "load/1.json", "load/2.json"


def loaded(df: DataFrame, late) -> DataFrame:
    """``df`` with the file and the time of the load that brought each row: the second one where ``late``."""

    def either(second: str, first: str):
        return F.when(late, F.lit(second)).otherwise(F.lit(first))

    return df.withColumns({"loaded_at": either(SECOND_LOAD, FIRST_LOAD).cast("timestamp_ntz"), "source_file": either(LATE_FILE, EARLY_FILE)})


def staged(df: DataFrame) -> DataFrame:
    """Written out once, as a build does with what it stages: a refresh reads it many times."""
    return cut_lineage(df)


def first_load(df: DataFrame) -> DataFrame:
    return df.where(F.col("source_file") == EARLY_FILE)


def before(column: str):
    return F.col(column) < F.lit(EARLIER).cast("timestamp_ntz")


def as_seen_earlier(issues: DataFrame) -> DataFrame:
    """The issues of the first load, with later changes undone."""
    undone = F.col("source_file") == LATE_FILE
    return issues.where(before("created_at")).withColumns(
        {
            "closed_at": F.when(~undone, F.col("closed_at")),
            "comment_count": F.when(undone, 0).otherwise(F.col("comment_count")),
            "loaded_at": F.lit(FIRST_LOAD).cast("timestamp_ntz"),
            "source_file": F.lit(EARLY_FILE),
        }
    )


def daily_twice(t: Tables, first_issues, issues, first_repositories=None, repositories=None) -> DataFrame:
    """The partitioned daily fact after a build from the first load and a refresh."""
    repositories = loaded(known_metrics(t), F.lit(False)) if repositories is None else repositories
    path = scratch_folder(t.spark, "daily")
    build.refresh_daily_table(t.spark, path, first_issues, repositories if first_repositories is None else first_repositories, AS_OF, False)
    build.refresh_daily_table(t.spark, path, issues, repositories, AS_OF, False)
    return read_table(t.spark, path).drop(*NOT_COMPARED)


@bind("incremental_daily", DAILY_SQL)
def incremental_daily(t: Tables):
    """Days after the last stored one are added by key."""
    issues = issue_metrics(t)
    fact = marts.repo_activity_daily(issues.where(before("created_at")), known_metrics(t), EARLIER)
    target = publish_table(fact, scratch_folder(t.spark, "daily"))
    return incremental.append_daily(issues, known_metrics(t), target, AS_OF).drop("dbt_updated_at")


def changed_issues(t: Tables) -> DataFrame:
    return loaded(roles.issues(t), ~before("created_at") | ~before("updated_at"))


@bind("incremental_daily_late_changes", DAILY_SQL)
def incremental_daily_late_changes(t: Tables):
    """Days whose issues changed since the stored refresh are recomputed."""
    issues = staged(changed_issues(t))
    return daily_twice(t, metrics.issue_metrics(as_seen_earlier(issues), EARLIER), metrics.issue_metrics(issues, AS_OF))


@bind("incremental_full_refresh", DAILY_SQL)
def incremental_full_refresh(t: Tables):
    """The stored table is ignored and everything rebuilt."""
    issues, parents = changed_issues(t), loaded(known_metrics(t), F.lit(False))
    path = scratch_folder(t.spark, "daily")
    build.refresh_daily_table(t.spark, path, metrics.issue_metrics(as_seen_earlier(issues), EARLIER), parents, EARLIER, False)
    build.refresh_daily_table(t.spark, path, metrics.issue_metrics(issues, AS_OF), parents, AS_OF, True)
    return read_table(t.spark, path).drop(*NOT_COMPARED)


@bind("incremental_equal_marks", DAILY_SQL)
def incremental_equal_marks(t: Tables):
    """After the first file a second one with the very same load time and a third one with an
    older time arrive; no time tells that they are new."""
    third = F.col("issue_id") % 3
    issues = metrics.issue_metrics(
        roles.issues(t).withColumns(
            {
                "source_file": F.concat(F.lit("load/"), third.cast("string"), F.lit(".json")),
                "loaded_at": F.when(third == 2, F.lit(EARLIER)).otherwise(F.lit(FIRST_LOAD)).cast("timestamp_ntz"),
            }
        ),
        AS_OF,
    )
    parents = loaded(known_metrics(t), F.lit(False))
    path = scratch_folder(t.spark, "daily")
    for seen in (third == 0, third < 2, third < 3):
        build.refresh_daily_table(t.spark, path, issues.where(seen), parents, AS_OF, False)
    return read_table(t.spark, path).drop(*NOT_COMPARED)


@bind("incremental_backfilled_history", DAILY_SQL)
def incremental_backfilled_history(t: Tables):
    """Issues of the years before arrive after the later ones were built."""
    issues = metrics.issue_metrics(loaded(roles.issues(t), before("created_at")), AS_OF)
    return daily_twice(t, first_load(issues), issues)


@bind("incremental_repository_change", DAILY_SQL)
def incremental_repository_change(t: Tables):
    """A third of the repositories becomes known later, another third has new figures and a new name."""
    third = F.col("repository_id") % 3
    parents = loaded(known_metrics(t), third != 0)
    issues = loaded(issue_metrics(t), F.lit(False))
    earlier = parents.where(third != 1).withColumns(
        {
            "stars_count": F.when(third == 2, F.lit(150)).otherwise(F.col("stars_count")),
            "repository_name": F.when(third == 2, "formerly").otherwise(F.col("repository_name")),
            "loaded_at": F.lit(FIRST_LOAD).cast("timestamp_ntz"),
            "source_file": F.lit(EARLY_FILE),
        }
    )
    return daily_twice(t, issues, issues, earlier, parents)


def parents_of(t: Tables, issues: DataFrame) -> DataFrame:
    return marts.issue_lifecycle(issues, known_metrics(t), AS_OF)


def comments_twice(t: Tables, first_comments, comments, first_issues, issues) -> DataFrame:
    path = scratch_folder(t.spark, "comments")
    for some_comments, some_issues in ((first_comments, first_issues), (comments, issues)):
        build.refresh_comment_table(t.spark, path, some_comments, parents_of(t, some_issues), some_issues, False)
    stored = read_table(t.spark, path).drop(*NOT_COMPARED)
    return countable(stored)


COMMENTS_REBUILT = f"{FACTS_WITH} SELECT * FROM comment_fact"


@bind("incremental_comments", COMMENTS_REBUILT)
def incremental_comments(t: Tables):
    """Comments after the stored ones; touched issues are numbered anew."""
    comments, issues = staged(loaded(roles.comments(t), ~before("created_at"))), staged(loaded(issue_metrics(t), F.lit(False)))
    parents = parents_of(t, issues)
    target = publish_table(marts.comment_fact(first_load(comments), parents), scratch_folder(t.spark, "comments"))
    consumed = files_of({incremental.COMMENTS: first_load(comments), incremental.ISSUES: issues})
    return countable(incremental.refresh_comments(comments, parents, issues, target, consumed))


@bind("incremental_comment_edit", COMMENTS_REBUILT)
def incremental_comment_edit(t: Tables):
    """First comments of all issues are edited long after they were written."""
    edited = F.col("body").endswith(" 1")
    comments, issues = staged(loaded(roles.comments(t), edited)), staged(loaded(issue_metrics(t), F.lit(False)))
    earlier = comments.withColumns({"body": F.when(edited, "before").otherwise(F.col("body")), "loaded_at": F.lit(FIRST_LOAD).cast("timestamp_ntz"), "source_file": F.lit(EARLY_FILE)})
    return comments_twice(t, earlier, comments, issues, issues)


@bind("incremental_late_parent", COMMENTS_REBUILT)
def incremental_late_parent(t: Tables):
    """Every second issue arrives after its comments."""
    comments = staged(loaded(roles.comments(t), F.lit(False)))
    issues = staged(loaded(issue_metrics(t), F.col("issue_number") % 2 == 0))
    return comments_twice(t, comments, comments, first_load(issues), issues)
