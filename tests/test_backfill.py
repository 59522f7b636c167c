import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsemill.plans import backfill, staging
from pulsemill.sources import read_landing

NOW = "2024-04-20 00:00:00"
LEDGER = """run_id string, repository string, chunk_id string, status string, issues long, comments long,
error string, recorded_at timestamp_ntz"""


@pytest.fixture
def periods(spark):
    rows = [("o/a_b", "2024-01-31 10:00:00", None, None), ("o/c", "2024-01-01 00:00:00", "2024-03-01 00:00:00", None)]
    frame = spark.createDataFrame(rows, "full_name string, created string, s string, e string").select(
        "full_name",
        F.col("created").cast("timestamp_ntz").alias("created_at"),
        F.col("s").cast("timestamp_ntz").alias("custom_start"),
        F.col("e").cast("timestamp_ntz").alias("custom_end"),
    )
    return backfill.ranges(frame, NOW)


def test_range_precedence(spark):
    row = spark.sql(
        """select 'o/r' as full_name, timestamp_ntz'2020-01-01' as created_at,
           cast(null as timestamp_ntz) as custom_start, timestamp_ntz'2021-01-01' as custom_end"""
    )
    got = backfill.ranges(row, NOW, global_start="2020-06-01", global_end="2022-01-01").first()
    assert (got["range_start"], got["range_end"]) == (datetime(2020, 6, 1), datetime(2021, 1, 1))
    got = backfill.ranges(row, NOW).first()
    assert got["range_start"] == datetime(2020, 1, 1)


def test_chunks_neither_overlap_nor_leave_gaps(periods):
    chunks = backfill.month_chunks(periods).orderBy("repository", "chunk_index").collect()
    mine = [c for c in chunks if c["repository"] == "o/a_b"]
    assert [c["chunk_id"] for c in mine] == ["2024-01", "2024-02", "2024-03"]
    assert mine[1]["chunk_start"] == datetime(2024, 2, 29, 10)
    assert all(a["chunk_end"] == b["chunk_start"] for a, b in zip(mine, mine[1:]))
    assert mine[-1]["chunk_end"] == datetime(2024, 4, 20)


def test_period_that_ends_before_it_starts_has_no_chunks(spark):
    periods = spark.sql(
        "select 'r' as repository, timestamp_ntz'2024-02-01' as range_start, timestamp_ntz'2024-01-01' as range_end"
    )
    assert backfill.month_chunks(periods).count() == 0


def test_chunk_of_an_instant(spark, periods):
    times = ["2024-01-31 09:59:59", "2024-01-31 10:00:00", "2024-02-29 09:59:59", "2024-02-29 10:00:00", "2024-04-20 00:00:00"]
    issues = spark.createDataFrame([("o/a_b", t) for t in times], "repository string, t string").select(
        "repository", F.col("t").cast("timestamp_ntz").alias("created_at")
    )
    got = {str(r["created_at"]): r["chunk_id"] for r in backfill.with_chunk(issues, periods).collect()}
    assert got == {times[1]: "2024-01", times[2]: "2024-01", times[3]: "2024-02"}


def test_failure_streaks(spark):
    states = "fcffffcf"
    rows = [
        ("r1", "a", f"2024-{i:02d}", "failed" if s == "f" else "completed", 0, 0, None, datetime(2024, 1, 1))
        for i, s in enumerate(states, 1)
    ]
    rows.append(("r1", "b", "2024-01", "completed", 0, 0, None, datetime(2024, 1, 1)))
    got = {r["repository"]: r for r in backfill.failure_streaks(spark.createDataFrame(rows, LEDGER), 3).collect()}
    assert (got["a"]["longest_streak"], got["a"]["stopped_at"], got["a"]["is_stopped"]) == (4, "2024-05", True)
    assert (got["b"]["longest_streak"], got["b"]["stopped_at"], got["b"]["is_stopped"]) == (0, None, False)


def test_repository_status(spark, periods):
    chunks = backfill.month_chunks(periods)
    none = spark.createDataFrame([], LEDGER)
    status = {r["repository"]: r["status"] for r in backfill.repository_status(chunks, none).collect()}
    assert set(status.values()) == {"not_started"}
    at = datetime(2024, 1, 1)
    rows = [("r1", "o/c", c, "completed", 1, 1, None, at) for c in ("2024-01", "2024-02", "2024-03", "2024-04")]
    rows += [("r1", "o/a_b", c, "failed", 0, 0, "x", at) for c in ("2024-01", "2024-02")]
    ledger = spark.createDataFrame(rows, LEDGER)

    def by_repository(limit):
        found = backfill.repository_status(chunks, ledger, limit)
        resumable = {r["repository"] for r in backfill.resumable_repositories(found).collect()}
        return {r["repository"]: r["status"] for r in found.collect()}, resumable

    assert by_repository(10) == ({"o/c": "completed", "o/a_b": "in_progress"}, {"o/a_b"})
    assert by_repository(2) == ({"o/c": "completed", "o/a_b": "failed"}, set())


@pytest.fixture
def history(raw):
    def issue(i, created, repo="o/a_b", **more):
        doc = {"id": i, "number": i, "title": "t", "state": "open", "created_at": created, "comments": 1,
               "repository_url": f"https://x/repos/{repo}", **more}
        return (json.dumps(doc), "2024-01-01", "f", i)

    def comment(i, number):
        doc = {"id": i, "body": "b", "created_at": "2024-02-02T00:00:00Z",
               "issue_url": f"https://x/repos/o/a_b/issues/{number}"}
        return (json.dumps(doc), "2024-01-01", "f", i)

    issues = raw(
        issue(1, "2024-02-01T00:00:00Z"),
        issue(2, "2024-03-05T00:00:00Z", comments=0),
        issue(3, "2024-03-06T00:00:00Z", pull_request={"url": "u"}),
        issue(4, "2024-03-07T00:00:00Z"),
        issue(5, "2023-01-01T00:00:00Z"),
    )
    comments = raw(comment(10, 1), comment(11, 1), comment(12, 2), comment(13, 3), comment(14, 4))
    return staging.stage_issues(issues, True), staging.stage_comments(comments, True)


def landed(spark, root, entity):
    docs = read_landing(spark, str(root), entity).select(F.try_variant_get("raw_data", "$.id", "long"))
    return sorted(r[0] for r in docs.collect())


def test_load_and_resume(spark, tmp_path, history, periods):
    issues, comments = history
    ledger = spark.createDataFrame([], LEDGER)
    root = tmp_path / "landing"

    entries, checks = backfill.load_pending(issues, comments, periods, ledger, str(root), "r1", NOW, dry_run=True)
    assert entries.count() == 0 and not root.exists()

    entries, checks = backfill.load_pending(issues, comments, periods, ledger, str(root), "r1", NOW)
    assert landed(spark, root, "issues") == [1, 2, 4] and landed(spark, root, "comments") == [10, 11, 14]
    counts = {(r["repository"], r["chunk_id"]): (r["issues"], r["comments"]) for r in entries.collect()}
    assert counts["o/a_b", "2024-01"] == (1, 2) and counts["o/a_b", "2024-02"] == (2, 1)
    assert counts["o/a_b", "2024-03"] == (0, 0) and counts["o/c", "2024-03"] == (0, 0)
    assert {r["status"] for r in checks.collect()} == {"completed"}

    done = backfill.update_ledger(ledger, entries)
    again, _ = backfill.load_pending(issues, comments, periods, done, str(root), "r2", NOW)
    assert again.count() == 0
    assert landed(spark, root, "issues") == [1, 2, 4]


def bare(raw, *created):
    """Issues that have neither title nor state."""
    docs = [{"id": i, "created_at": at, "repository_url": "x/repos/o/a_b"} for i, at in enumerate(created)]
    return staging.stage_issues(raw(*[(json.dumps(d), "2024-01-01", "f", n) for n, d in enumerate(docs)]), True)


def test_strict_check_fails_the_chunk_only(spark, tmp_path, raw, history, periods):
    issues, comments = history
    poor = bare(raw, "2024-02-03T00:00:00Z", "2024-02-04T00:00:00Z").withColumn("issue_id", F.col("issue_id") + 100)
    ledger = spark.createDataFrame([], LEDGER)
    root = tmp_path / "landing"
    entries, judged = backfill.load_pending(
        issues.unionByName(poor), comments, periods, ledger, str(root), "r", NOW, strict=True
    )
    got = {(r["repository"], r["chunk_id"]): (r["status"], r["issues"], r["error"]) for r in entries.collect()}
    assert got["o/a_b", "2024-01"] == ("failed", 0, "40.0% of required values missing")
    assert got["o/a_b", "2024-02"] == ("completed", 2, None)
    assert landed(spark, root, "issues") == [2, 4] and landed(spark, root, "comments") == [14]
    # The failed chunk is still to do; without the strict check it is loaded.
    done = backfill.update_ledger(ledger, entries)
    again, _ = backfill.load_pending(issues.unionByName(poor), comments, periods, done, str(root), "r2", NOW)
    assert [(r["chunk_id"], r["issues"]) for r in again.collect()] == [("2024-01", 3)]


def test_repository_is_given_up_after_failures_in_a_row(spark, tmp_path, raw, history, periods):
    poor = bare(raw, "2024-02-03T00:00:00Z", "2024-03-04T00:00:00Z", "2024-04-04T00:00:00Z")
    entries, judged = backfill.load_pending(
        poor, history[1], periods, spark.createDataFrame([], LEDGER), str(tmp_path / "l"), "r", NOW, strict=True, max_failures=2
    )
    mine = {r["chunk_id"]: r["status"] for r in entries.where("repository = 'o/a_b'").collect()}
    assert mine == {"2024-01": "failed", "2024-02": "failed"}
    assert judged.where("repository = 'o/a_b' and status is null").count() == 1


def test_a_lost_run_is_done_again(spark, tmp_path, raw, history, periods, monkeypatch):
    issues, comments = history
    repositories = staging.stage_repositories(
        raw(*[(json.dumps({"id": i, "full_name": n}), "2024-01-01", "f", i) for i, n in enumerate(["o/a_b", "o/c", "o/off"])]), True
    )
    root = str(tmp_path)

    def run(run_id):
        return backfill.run_backfill(issues, comments, repositories, periods, root, run_id, NOW)

    def seen(entity):
        rows = backfill.read_backfilled(spark, root, entity)
        return sorted((r[0], r[1]) for r in rows.select(F.try_variant_get("raw_data", "$.id", "long"), "run_id").collect())

    assert backfill.read_ledger(spark, root).count() == 0
    with monkeypatch.context() as lost:
        lost.setattr(backfill, "append_ledger", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run("r1")
    assert landed(spark, tmp_path / "landing", "issues") == [1, 2, 4] and seen("issues") == []
    ledger = run("r1")
    assert ledger.count() == 5 and {r["status"] for r in ledger.collect()} == {"completed"}
    assert seen("issues") == [(1, "r1"), (2, "r1"), (4, "r1")]
    assert seen("comments") == [(10, "r1"), (11, "r1"), (14, "r1")]
    assert seen("repositories") == [(0, "r1"), (1, "r1")]
    # Nothing is left to do, and the first attempt's rows are still not there.
    assert run("r2").count() == 5 and len(seen("issues")) == 3


def test_the_latest_entry_counts(spark, tmp_path):
    rows = [("r", "o/a", "2024-01", status, 1, 0, None, datetime(2024, 1, day), f"r.{day}", None) for status, day in (("failed", 1), ("completed", 2))]
    for row in rows:
        backfill.append_ledger(spark.createDataFrame([row], backfill.STORED_LEDGER), str(tmp_path))
    assert [(r["status"], r["origin"]) for r in backfill.read_ledger(spark, str(tmp_path)).collect()] == [("completed", "r.2")]
