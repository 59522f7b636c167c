import json
from datetime import datetime

from pulsemill.plans import staging

DAY1, DAY2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def issue(**fields):
    return json.dumps({"id": 1, "number": 1, **fields})


def staged(frame):
    return {row["issue_id"]: row for row in staging.stage_issues(frame).collect()}


def test_pull_request_needs_a_value(raw):
    rows = staged(
        raw(
            (json.dumps({"id": 1}), DAY1, "f", 0),
            (json.dumps({"id": 2, "pull_request": None}), DAY1, "f", 1),
            (json.dumps({"id": 3, "pull_request": {"url": "u"}}), DAY1, "f", 2),
        )
    )
    assert {k: r["is_pull_request"] for k, r in rows.items()} == {1: False, 2: False, 3: True}


def test_arrays_and_nested_objects(raw):
    rows = staged(
        raw(
            (json.dumps({"id": 1, "labels": None, "assignee": None}), DAY1, "f", 0),
            (json.dumps({"id": 2, "labels": [], "assignee": {"login": "a"}}), DAY1, "f", 1),
            (json.dumps({"id": 3, "labels": [{"name": "x"}, {"name": "y"}], "user": {"login": "u", "id": 7}}), DAY1, "f", 2),
        )
    )
    assert [rows[i]["label_count"] for i in (1, 2, 3)] == [None, 0, 2]
    assert rows[1]["labels_json"] is None and rows[2]["labels_json"] is not None
    assert [rows[i]["assignee_username"] for i in (1, 2, 3)] == [None, "a", None]
    assert (rows[3]["author_username"], rows[3]["author_id"]) == ("u", 7)


def test_repository_falls_back_to_the_url(raw):
    rows = staged(
        raw(
            (json.dumps({"id": 1, "source_repository": "o/r", "repository_url": "https://x/repos/a/b"}), DAY1, "f", 0),
            (json.dumps({"id": 2, "repository_url": "https://x/repos/org/my_repo"}), DAY1, "f", 1),
            (json.dumps({"id": 3, "repository_url": "https://x/none"}), DAY1, "f", 2),
        )
    )
    assert [rows[i]["repository"] for i in (1, 2, 3)] == ["o/r", "org/my_repo", None]


def test_latest_load_wins_whatever_the_order(raw):
    loads = [
        (issue(title="old"), DAY1, "a", 0),
        (issue(title="new"), DAY2, "a", 0),
        (issue(title="same file, later place"), DAY2, "a", 1),
        (issue(title="later file"), DAY2, "b", 0),
    ]
    for order in (loads, loads[::-1], loads[2:] + loads[:2]):
        rows = staged(raw(*order))
        assert rows[1]["title"] == "later file"


def test_wrong_types_become_null(raw):
    rows = staged(raw((json.dumps({"id": 1, "number": "x", "created_at": "yesterday", "comments": {}}), DAY1, "f", 0)))
    assert (rows[1]["issue_number"], rows[1]["created_at"], rows[1]["comment_count"]) == (None, None, None)


def test_times_keep_their_digits(raw):
    rows = staged(raw((issue(created_at="2024-05-06T07:08:09Z"), DAY1, "f", 0)))
    assert rows[1]["created_at"] == datetime(2024, 5, 6, 7, 8, 9)


def test_comment_links_and_reactions(raw):
    url = "https://x/repos/org/my_repo/issues/42"
    frame = raw(
        (json.dumps({"id": 1, "issue_url": url, "reactions": {"plus1": 2, "-1": 3}, "body": "hello"}), DAY1, "f", 0),
        (json.dumps({"id": 2, "issue_url": "https://x/none", "reactions": {"+1": 5, "minus1": 6}}), DAY1, "f", 1),
    )
    rows = {r["comment_id"]: r for r in staging.stage_comments(frame).collect()}
    assert (rows[1]["issue_number"], rows[1]["repository_full_name"]) == (42, "org/my_repo")
    assert (rows[2]["issue_number"], rows[2]["repository_full_name"]) == (None, None)
    assert [(r["thumbs_up_count"], r["thumbs_down_count"]) for r in (rows[1], rows[2])] == [(2, 3), (5, 6)]
    assert rows[1]["body_length"] == 5


def test_contract_columns(raw):
    frame = raw((issue(), DAY1, "f", 0))
    issues = set(staging.stage_issues(frame).columns)
    assert issues >= {
        "issue_id", "issue_number", "node_id", "title", "state", "is_locked", "author_username", "author_id",
        "author_type", "assignee_username", "assignees_json", "assignee_count", "labels_json", "label_count",
        "milestone_title", "milestone_number", "created_at", "updated_at", "closed_at", "comment_count",
        "is_pull_request", "html_url", "api_url", "body", "body_length", "repository", "extraction_date",
        "source_file", "loaded_at",
    }
    assert "tie_breaker" not in issues
    assert len(staging.stage_repositories(frame).columns) == 36
    assert len(staging.stage_comments(frame).columns) == 28
