import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsemill.functions import field
from pulsemill.plans import staging
from pulsemill.plans.build import build_all
from pulsemill.sources import read_table
from pulsemill.streaming import append_raw, latest_state, read_raw, read_rejects


def issue(i, created, closed=None, **more):
    return {"id": i, "number": i, "title": f"issue {i}", "state": "closed" if closed else "open", "created_at": created,
            "updated_at": closed or created, "closed_at": closed, "comments": 1, "user": {"login": "u", "id": 1},
            "labels": [], "source_repository": "o/r", **more}


def comment(i, number, created):
    return {"id": i, "body": f"c{i}", "created_at": created, "issue_url": f"https://x/repos/o/r/issues/{number}"}


REPO = {"id": 1, "name": "r", "full_name": "o/r", "owner": {"login": "o", "id": 2, "type": "User"},
        "created_at": "2020-01-01T00:00:00Z", "pushed_at": "2024-01-01T00:00:00Z", "stargazers_count": 150}


@pytest.fixture
def raws(raw):
    def make(issues, comments, at):
        return {
            "issues": raw(*[(json.dumps(d), at, "i", n) for n, d in enumerate(issues)]),
            "repositories": raw((json.dumps(REPO), at, "r", 0)),
            "comments": raw(*[(json.dumps(d), at, "c", n) for n, d in enumerate(comments)]),
        }

    return make


def views(spark):
    out = {}
    for name in ("fct_repo_activity_daily", "fct_issue_comments", "fct_issue_lifecycle", "issue_timeline", "dim_repository"):
        df = spark.table(name)
        kept = [c for c in sorted(df.columns) if c not in ("labels", "dbt_updated_at")]
        out[name] = sorted(str(r) for r in df.select(*kept).collect())
    return out


def test_incremental_build_equals_full_build(spark, tmp_path, raws):
    first = raws(
        [issue(1, "2024-01-01T05:00:00Z"), issue(2, "2024-01-02T05:00:00Z")],
        [comment(10, 1, "2024-01-03T00:00:00Z"), comment(11, 2, "2024-01-03T00:00:00Z")],
        "2024-01-04 00:00:00",
    )
    later = raws(
        [issue(1, "2024-01-01T05:00:00Z", closed="2024-02-01T00:00:00Z"), issue(2, "2024-01-02T05:00:00Z"), issue(3, "2024-02-02T00:00:00Z")],
        [comment(10, 1, "2024-01-03T00:00:00Z"), comment(11, 2, "2024-01-03T00:00:00Z"), comment(12, 1, "2024-02-01T00:00:00Z"), comment(13, 77, "2024-02-01T00:00:00Z")],
        "2024-02-03 00:00:00",
    )
    root = str(tmp_path / "warehouse")
    checks = build_all(spark, first, root, "2024-01-04 00:00:00")
    assert {r["status"] for r in checks.collect()} == {"pass"}
    assert checks.count() == 31
    assert checks.where("check_name IN ('recency', 'freshness')").count() == 6
    build_all(spark, later, root, "2024-02-03 00:00:00")
    grown = views(spark)
    build_all(spark, later, root, "2024-02-03 00:00:00", full_refresh=True)
    assert grown == views(spark)
    assert spark.table("fct_issue_comments").count() == 3
    assert spark.table("issue_timeline").count() == 9
    assert spark.table("dim_date").agg(F.max("date_key")).first()[0].isoformat() == "2024-02-09"


def test_failing_staging_check_stops_the_marts(spark, tmp_path, raws):
    odd = raws([issue(1, "2024-01-01T05:00:00Z") | {"state": "odd"}], [comment(10, 1, "2024-01-03T00:00:00Z")], "2024-01-04 00:00:00")
    with pytest.raises(ValueError, match="accepted_values"):
        build_all(spark, odd, str(tmp_path / "warehouse"), "2024-01-04 00:00:00")
    assert not (tmp_path / "warehouse" / "marts").exists()


def put(folder, name, documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(documents, indent=1))


def stage(raw):
    return staging.type_issues(raw).select("issue_id", "title", "updated_at")


def newest():
    return [F.col("updated_at").desc_nulls_last(), F.col("title").desc_nulls_last()]


def test_stream_keeps_the_latest_state(spark, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "progress")

    def run():
        latest_state(spark, str(landing), table, progress, stage, ["issue_id"], newest, files_per_batch=1).awaitTermination()
        return {r["issue_id"]: r["title"] for r in read_table(spark, table).collect()}

    put(landing / "2024/01/01", "a.json", [issue(1, "2024-01-01T00:00:00Z"), issue(2, "2024-01-01T00:00:00Z")])
    put(landing / "2024/01/02", "a.json", [{**issue(1, "2024-01-02T00:00:00Z"), "title": "newer"}])
    assert run() == {1: "newer", 2: "issue 2"}
    # A late file with an older state changes nothing; a new key is added.
    put(landing / "2024/01/03", "b.json", [{**issue(1, "2023-01-01T00:00:00Z"), "title": "late"}, issue(3, "2024-01-01T00:00:00Z")])
    assert run() == {1: "newer", 2: "issue 2", 3: "issue 3"}
    assert run() == {1: "newer", 2: "issue 2", 3: "issue 3"}


def test_stream_appends_each_document_once(spark, tmp_path):
    landing, table, progress = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "progress")
    put(landing / "2024/01/01", "a.json", [issue(1, "2024-01-01T00:00:00Z")])
    (landing / "2024/01/01" / "broken.json").write_text('[{"id":')
    append_raw(spark, str(landing), table, progress).awaitTermination()
    put(landing / "2024/01/02", "a.json", [issue(2, "2024-01-01T00:00:00Z"), issue(3, "2024-01-01T00:00:00Z")])
    append_raw(spark, str(landing), table, progress).awaitTermination()
    stored = read_raw(spark, table)
    assert [(r["source_file"].rsplit("/", 1)[1], r["reason"]) for r in read_rejects(spark, table).collect()] == [("broken.json", "truncated")]
    assert sorted(r[0] for r in stored.select(field(F.col("raw_data"), "$.id", "long")).collect()) == [1, 2, 3]
    assert stored.columns == ["raw_data", "loaded_at", "source_file", "tie_breaker"]
    assert stored.first()["loaded_at"] > datetime(2020, 1, 1)


def test_batch_without_its_commit_is_not_there(spark, tmp_path):
    landing, table, progress = tmp_path / "in", tmp_path / "raw", str(tmp_path / "progress")
    put(landing / "2024/01/01", "a.json", [issue(1, "2024-01-01T00:00:00Z")])
    append_raw(spark, str(landing), str(table), progress).awaitTermination()
    # A lost batch has written its documents only.
    for sink in ("documents", "rejects"):
        shutil.copytree(table / sink / "batch=000000000000", table / sink / "batch=000000000001")
    assert read_raw(spark, str(table)).count() == 1
    put(landing / "2024/01/02", "a.json", [issue(2, "2024-01-01T00:00:00Z"), issue(3, "2024-01-01T00:00:00Z")])
    append_raw(spark, str(landing), str(table), progress).awaitTermination()
    assert read_raw(spark, str(table)).count() == 3


def test_batch_rewrites_its_buckets_only(spark, tmp_path):
    landing, table, progress = tmp_path / "in", tmp_path / "state", str(tmp_path / "progress")

    def run():
        latest_state(spark, str(landing), str(table), progress, stage, ["issue_id"], newest, buckets=16).awaitTermination()
        return {f.parent.parent.name + "/" + f.parent.name for f in (table / "data").rglob("*.parquet")}

    put(landing / "2024/01/01", "a.json", [issue(i, "2024-01-01T00:00:00Z") for i in range(300)])
    first = run()
    assert len(first) == 16
    put(landing / "2024/01/02", "a.json", [{**issue(7, "2024-01-02T00:00:00Z"), "title": "newer"}])
    assert len(run() - first) == 1
    titles = {r["issue_id"]: r["title"] for r in read_table(spark, str(table)).collect()}
    assert len(titles) == 300 and titles[7] == "newer" and titles[8] == "issue 8"
