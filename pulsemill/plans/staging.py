"""RAW documents to typed rows, one per entity: its latest load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.text import capture
from pulsemill.functions.variants import (
    array_length,
    field,
    is_present,
    member,
    subdocument,
    typed_document,
)
from pulsemill.operators.dedup import latest_by_key

# Patterns that find the repository and the issue number in an API URL.
REPOSITORY_IN_ISSUE_URL = "repos/([^/]+/[^/]+)/"
REPOSITORY_IN_URL = "repos/([^/]+/[^/]+)"
ISSUE_NUMBER_IN_URL = "/issues/([0-9]+)"

# Output column, path in the document, type.
ISSUE_FIELDS = [
    ("issue_id", "id", "bigint"),
    ("issue_number", "number", "bigint"),
    ("node_id", "node_id", "string"),
    ("title", "title", "string"),
    ("state", "state", "string"),
    ("is_locked", "locked", "boolean"),
    ("author_username", "user.login", "string"),
    ("author_id", "user.id", "bigint"),
    ("author_type", "user.type", "string"),
    ("assignee_username", "assignee.login", "string"),
    ("milestone_title", "milestone.title", "string"),
    ("milestone_number", "milestone.number", "bigint"),
    ("created_at", "created_at", "timestamp_ntz"),
    ("updated_at", "updated_at", "timestamp_ntz"),
    ("closed_at", "closed_at", "timestamp_ntz"),
    ("comment_count", "comments", "bigint"),
    ("html_url", "html_url", "string"),
    ("api_url", "url", "string"),
    ("body", "body", "string"),
    ("extraction_date", "extraction_date", "date"),
]
REPOSITORY_FIELDS = [
    ("repository_id", "id", "bigint"),
    ("node_id", "node_id", "string"),
    ("repository_name", "name", "string"),
    ("full_name", "full_name", "string"),
    ("owner_username", "owner.login", "string"),
    ("owner_id", "owner.id", "bigint"),
    ("owner_type", "owner.type", "string"),
    ("description", "description", "string"),
    ("is_private", "private", "boolean"),
    ("is_fork", "fork", "boolean"),
    ("is_archived", "archived", "boolean"),
    ("is_disabled", "disabled", "boolean"),
    ("created_at", "created_at", "timestamp_ntz"),
    ("updated_at", "updated_at", "timestamp_ntz"),
    ("pushed_at", "pushed_at", "timestamp_ntz"),
    ("stars_count", "stargazers_count", "bigint"),
    ("watchers_count", "watchers_count", "bigint"),
    ("forks_count", "forks_count", "bigint"),
    ("open_issues_count", "open_issues_count", "bigint"),
    ("size_kb", "size", "bigint"),
    ("primary_language", "language", "string"),
    ("license_name", "license.name", "string"),
    ("license_key", "license.key", "string"),
    ("has_issues_enabled", "has_issues", "boolean"),
    ("has_projects_enabled", "has_projects", "boolean"),
    ("has_wiki_enabled", "has_wiki", "boolean"),
    ("has_pages_enabled", "has_pages", "boolean"),
    ("has_downloads_enabled", "has_downloads", "boolean"),
    ("html_url", "html_url", "string"),
    ("homepage_url", "homepage", "string"),
    ("default_branch", "default_branch", "string"),
    ("extraction_date", "extraction_date", "date"),
]
COMMENT_FIELDS = [
    ("comment_id", "id", "bigint"),
    ("node_id", "node_id", "string"),
    ("body", "body", "string"),
    ("author_username", "user.login", "string"),
    ("author_id", "user.id", "bigint"),
    ("author_type", "user.type", "string"),
    ("issue_url", "issue_url", "string"),
    ("created_at", "created_at", "timestamp_ntz"),
    ("updated_at", "updated_at", "timestamp_ntz"),
    ("html_url", "html_url", "string"),
    ("api_url", "url", "string"),
    ("reaction_count", "reactions.total_count", "bigint"),
    ("laugh_count", "reactions.laugh", "bigint"),
    ("hooray_count", "reactions.hooray", "bigint"),
    ("confused_count", "reactions.confused", "bigint"),
    ("heart_count", "reactions.heart", "bigint"),
    ("rocket_count", "reactions.rocket", "bigint"),
    ("eyes_count", "reactions.eyes", "bigint"),
    ("repository", "source_repository", "string"),
    ("extraction_date", "extraction_date", "date"),
    ("author_association", "author_association", "string"),
]


def newest_load_first() -> list[Column]:
    """Latest load wins; file name and place in the file settle equal load times."""
    return [
        F.col("loaded_at").desc_nulls_last(),
        F.col("source_file").desc_nulls_last(),
        F.col("tie_breaker").desc_nulls_last(),
    ]


def typed(
    raw: DataFrame, fields: list[tuple[str, str, str]], helpers: list[tuple[str, str]], keep_document: bool
) -> DataFrame:
    """RAW rows with the document as a struct ``doc`` and its plain fields as columns."""
    wanted = [(path, kind) for _, path, kind in fields] + helpers
    kept = lineage(keep_document)
    return raw.select(typed_document(F.col("raw_data"), wanted).alias("doc"), *kept).select(
        *[member("doc", path).alias(name) for name, path, _ in fields], *kept, "doc"
    )


def lineage(keep_document: bool) -> list[str]:
    return ["source_file", "loaded_at", "tie_breaker"] + (["raw_data"] if keep_document else [])


# Parts of a document that are read on the way to a column.
ISSUE_HELPERS = [
    ("assignees", "variant"),
    ("labels", "variant"),
    ("pull_request", "variant"),
    ("source_repository", "string"),
    ("repository_url", "string"),
]
REPOSITORY_HELPERS = [("topics", "variant")]
# Thumb reactions are keyed by a word in some documents and by a sign in others.
COMMENT_HELPERS = [
    ("reactions.plus1", "bigint"),
    ("reactions.+1", "bigint"),
    ("reactions.minus1", "bigint"),
    ("reactions.-1", "bigint"),
]


def type_issues(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    """Every load of every issue as a typed row."""
    labels, assignees = member("doc", "labels"), member("doc", "assignees")
    from_url = capture(member("doc", "repository_url"), REPOSITORY_IN_URL)
    return (
        typed(raw, ISSUE_FIELDS, ISSUE_HELPERS, keep_document)
        .withColumns(
            {
                "assignees_json": subdocument(assignees, "$"),
                "assignee_count": array_length(assignees, "$"),
                "labels_json": subdocument(labels, "$"),
                "label_count": array_length(labels, "$"),
                "is_pull_request": is_present(member("doc", "pull_request"), "$"),
                "repository": F.coalesce(member("doc", "source_repository"), from_url),
                "body_length": F.length("body"),
            }
        )
        .drop("doc")
    )


def type_repositories(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    topics = member("doc", "topics")
    return (
        typed(raw, REPOSITORY_FIELDS, REPOSITORY_HELPERS, keep_document)
        .withColumns({"topics_json": subdocument(topics, "$"), "topics_count": array_length(topics, "$")})
        .drop("doc")
    )


def type_comments(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    def thumbs(word: str, sign: str) -> Column:
        return F.coalesce(member("doc", f"reactions.{word}"), member("doc", f"reactions.{sign}"))

    return (
        typed(raw, COMMENT_FIELDS, COMMENT_HELPERS, keep_document)
        .withColumns(
            {
                "thumbs_up_count": thumbs("plus1", "+1"),
                "thumbs_down_count": thumbs("minus1", "-1"),
                "body_length": F.length("body"),
                "issue_number": capture(F.col("issue_url"), ISSUE_NUMBER_IN_URL).try_cast("bigint"),
                "repository_full_name": capture(F.col("issue_url"), REPOSITORY_IN_ISSUE_URL),
            }
        )
        .drop("doc")
    )


def latest_load(raw: DataFrame, id_path: str) -> DataFrame:
    """The latest load of every document, chosen before the documents are typed.

    Of a document only its id is read here: the other fields are then taken from one load each,
    not from all that are thrown away. Documents without an id count as one.
    """
    of_document = raw.withColumn("_id", field(F.col("raw_data"), f"$.{id_path}", "bigint"))
    return latest_by_key(of_document, ["_id"], newest_load_first()).drop("_id")


def stage_issues(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    return type_issues(latest_load(raw, "id"), keep_document).drop("tie_breaker")


def stage_repositories(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    return type_repositories(latest_load(raw, "id"), keep_document).drop("tie_breaker")


def stage_comments(raw: DataFrame, keep_document: bool = False) -> DataFrame:
    return type_comments(latest_load(raw, "id"), keep_document).drop("tie_breaker")
