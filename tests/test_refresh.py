from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import replace_where_matched, upsert
from pulsemill.plans import incremental, marts, metrics
from pulsemill.sources import files_of

NOW = "2024-03-01 00:00:00"
BASE = datetime(2024, 1, 1)

ISSUE_SCHEMA = """issue_id long, issue_number long, title string, state string, repository string,
created_at timestamp_ntz, updated_at timestamp_ntz, closed_at timestamp_ntz, comment_count long,
author_username string, author_id long, assignee_username string, label_count long, milestone_title string,
is_pull_request boolean, labels_json string, html_url string, loaded_at timestamp_ntz, source_file string"""


def issue(i, day, repo="o/a", closed=None, updated=None):
    created = BASE + timedelta(days=day, hours=3)
    done = None if closed is None else BASE + timedelta(days=closed)
    seen = BASE + timedelta(days=updated) if updated is not None else (done or created)
    return (i, i, f"t{i}", "closed" if done else "open", repo, created, seen, done, 1, f"u{i % 2}", i % 2,
            None, 0, None, False, None, None, seen, f"{i}-{seen}")


@pytest.fixture
def frames(spark):
    def make(rows, now=NOW):
        return metrics.issue_metrics(spark.createDataFrame(rows, ISSUE_SCHEMA), now)

    return make


@pytest.fixture
def repos(spark):
    schema = """repository_id long, repository_name string, full_name string, owner_username string,
    stars_count long, forks_count long, open_issues_count long, loaded_at timestamp_ntz, source_file string"""
    return spark.createDataFrame([(1, "a", "o/a", "o", 1, 2, 3, BASE, "r"), (2, "b", "o/b", "o", 4, 5, 6, BASE, "r")], schema)


def rows(df):
    return sorted(str(r) for r in df.drop("dbt_updated_at").collect())


def test_daily_counts(frames, repos):
    issues = frames([issue(1, 0), issue(2, 0, closed=2), issue(3, 0, "x/unknown"), issue(4, 0, "y/unknown")])
    fact = {r["fct_key"]: r for r in marts.repo_activity_daily(issues, repos, NOW).collect()}
    assert set(fact) == {"2024-01-01_1", "2024-01-01_unknown"}
    known, unknown = fact["2024-01-01_1"], fact["2024-01-01_unknown"]
    assert (known["total_issues_created"], known["issues_closed"], known["unique_contributors"]) == (2, 1, 2)
    assert known["median_hours_to_close"] == 45.0
    assert unknown["total_issues_created"] == 2 and unknown["repository_full_name"] is None


def test_late_changes_are_picked_up(frames, repos):
    before = [issue(1, 0), issue(2, 1), issue(3, 10), issue(4, 2, "o/new")]
    target = marts.repo_activity_daily(frames(before), repos, BASE + timedelta(days=20))
    consumed = files_of({"issues": frames(before), "repositories": repos})
    after = [issue(1, 0, closed=25), issue(2, 1), issue(3, 10), issue(4, 2, "o/b", updated=26), issue(5, 30)]
    full = marts.repo_activity_daily(frames(after), repos, NOW)
    refreshed = incremental.refresh_daily(frames(after), repos, target, consumed, NOW)
    assert rows(refreshed) == rows(full)
    # The cheap mode sees the new day only.
    appended = incremental.append_daily(frames(after), repos, target, NOW)
    assert appended.count() == 5 and rows(appended) != rows(full)


def test_refresh_is_idempotent(frames, repos):
    issues = frames([issue(1, 0), issue(2, 5, closed=6)])
    empty = marts.repo_activity_daily(issues, repos, NOW).limit(0)
    none = files_of({"issues": issues.limit(0)})
    once = incremental.refresh_daily(issues, repos, empty, none, NOW)
    twice = incremental.refresh_daily(issues, repos, once, none, NOW)
    nothing_new = incremental.refresh_daily(issues, repos, once, files_of({"issues": issues, "repositories": repos}), NOW)
    assert rows(nothing_new) == rows(once)
    assert rows(once) == rows(twice) == rows(marts.repo_activity_daily(issues, repos, NOW))


def test_empty_target_loads_everything(frames, repos):
    issues = frames([issue(1, 0), issue(2, 1)])
    empty = marts.repo_activity_daily(issues, repos, NOW).limit(0)
    assert incremental.append_daily(issues, repos, empty, NOW).count() == 2


COMMENT_SCHEMA = """comment_id long, issue_number long, repository_full_name string, created_at timestamp_ntz,
updated_at timestamp_ntz, author_username string, author_id long, body string, html_url string, loaded_at timestamp_ntz, source_file string"""


def comment(i, number, day, repo="o/a"):
    at = BASE + timedelta(days=day)
    return (i, number, repo, at, at, "u", 1, f"text {i}", None, at, f"c{i}")


def test_sequence_goes_on_over_refreshes(spark, frames, repos):
    issues = frames([issue(1, 0), issue(2, 0)])
    lifecycle = marts.issue_lifecycle(issues, repos, NOW)
    first = [comment(10, 1, 1), comment(11, 1, 2), comment(12, 2, 1), comment(13, 99, 1), comment(14, None, 1)]
    later = [comment(15, 1, 30), comment(16, 2, 31), comment(17, 1, 30)]

    def frame(data):
        return spark.createDataFrame(data, COMMENT_SCHEMA)

    target = marts.comment_fact(frame(first), lifecycle)
    consumed = files_of({"comments": frame(first), "issues": issues})
    full = marts.comment_fact(frame(first + later), lifecycle)
    refreshed = incremental.refresh_comments(frame(first + later), lifecycle, issues, target, consumed)
    assert rows(refreshed) == rows(full)
    places = {r["comment_id"]: r["comment_sequence"] for r in refreshed.collect()}
    assert places == {10: 1, 11: 2, 15: 3, 17: 4, 12: 1, 16: 2}


def test_timeline_has_an_end_for_open_issues(spark, frames, repos):
    lifecycle = marts.issue_lifecycle(frames([issue(1, 0), issue(2, 0, closed=4)]), repos, NOW)
    comments = marts.comment_fact(spark.createDataFrame([comment(10, 1, 1)], COMMENT_SCHEMA), lifecycle)
    events = {(r["issue_id"], r["event_type"]): r for r in marts.issue_timeline(lifecycle, comments, NOW).collect()}
    assert len(events) == 5
    assert events[1, "ISSUE_END"]["event_date"] == datetime(2024, 3, 1)
    assert events[2, "ISSUE_END"]["event_date"] == BASE + timedelta(days=4)
    assert events[1, "COMMENT"]["issue_title"] == "t1" and events[1, "COMMENT"]["comment_body"] == "text 10"


@pytest.mark.parametrize("age, stage", [(30, "Active"), (31, "Long-running"), (90, "Long-running"), (91, "Stale")])
def test_stage_edges(frames, repos, age, stage):
    now = BASE + timedelta(days=age)
    fact = marts.issue_lifecycle(frames([issue(1, 0)], now), repos, now).first()
    assert (fact["lifecycle_stage"], fact["duration_days"]) == (stage, age)


def test_upsert_properties(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    delta = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    once = upsert(target, delta, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, upsert(once, delta, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    wider = delta.withColumn("extra", F.lit(1))
    assert upsert(target, wider, ["k"]).columns == ["k", "v"]
    assert sorted(map(tuple, upsert(target, wider, ["k"], evolve=True).collect())) == [
        (1, "a", None),
        (2, "B", 1),
        (3, "C", 1),
    ]
    scope = spark.createDataFrame([(1,), (2,)], "k long")
    assert sorted(map(tuple, replace_where_matched(target, delta, scope, ["k"]).collect())) == [(2, "B"), (3, "C")]
