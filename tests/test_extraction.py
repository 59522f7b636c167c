import json

from pyspark.sql import functions as F

from pulsemill.plans import extraction, staging
from pulsemill.sources import read_landing


def landed(spark, root, entity):
    docs = read_landing(spark, root, entity).select(
        F.try_variant_get("raw_data", "$.id", "long"), F.try_variant_get("raw_data", "$.source_repository", "string")
    )
    return sorted(map(tuple, docs.collect()))


def test_daily_extract(spark, tmp_path, raw):
    def issue(i, repo, updated, **more):
        return {"id": i, "number": i, "updated_at": updated, "repository_url": f"x/repos/{repo}", **more}

    issues = [
        issue(1, "o/a", "2024-01-10T00:00:00Z"),
        issue(2, "o/a", "2024-01-09T00:00:00Z", pull_request={"url": "u"}),
        issue(3, "o/a", "2024-01-08T00:00:00Z"),
        issue(4, "o/a", "2024-01-02T23:59:59Z"),
        issue(5, "o/my_repo", "2024-01-03T00:00:00Z"),
        issue(6, "o/off", "2024-01-10T00:00:00Z"),
    ]
    comments = [
        {"id": 7, "updated_at": "2024-01-09T00:00:00Z", "issue_url": "x/repos/o/a/issues/1"},
        {"id": 8, "updated_at": "2023-01-09T00:00:00Z", "issue_url": "x/repos/o/a/issues/1"},
    ]
    repositories = [{"id": 20, "full_name": "o/a"}, {"id": 21, "full_name": "o/off"}]

    def frame(docs):
        return raw(*[(json.dumps(d), "2024-01-10", "f", n) for n, d in enumerate(docs)])

    enabled = spark.createDataFrame([("o/a",), ("o/my_repo",)], "full_name string")
    root = str(tmp_path / "landing")
    for _ in range(2):
        extraction.land_daily_extract(
            staging.stage_issues(frame(issues), True),
            staging.stage_comments(frame(comments), True),
            staging.stage_repositories(frame(repositories), True),
            enabled,
            root,
            "2024-01-10",
            cap=2,
        )
        assert landed(spark, root, "issues") == [(1, "o/a"), (2, "o/a"), (5, "o/my_repo")]
        assert landed(spark, root, "comments") == [(7, "o/a")]
        assert landed(spark, root, "repositories") == [(20, "o/a")]
