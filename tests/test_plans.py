"""The plans keep their shape: what is pushed down, moved once, split and never crossed."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pulsemill.bindings import models, roles
from pulsemill.bindings.documents import raw_comments, raw_issues
from pulsemill.operators import latest_by_key
from pulsemill.plans import incremental, marts, staging
from pulsemill.session import cut_lineage
from pulsemill.sources import publish_table, read_landing

FOLDER = contract.SMOKE_DATA


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def tables(spark):
    return roles.Tables(spark, FOLDER)


@contextlib.contextmanager
def settings(spark, **values):
    names = {key: "spark.sql." + key.replace("__", ".") for key in values}
    before = {key: spark.conf.get(name, None) for key, name in names.items()}
    try:
        for key, value in values.items():
            spark.conf.set(names[key], value)
        yield
    finally:
        for key, value in before.items():
            if value is None or value == "<undefined>":
                spark.conf.unset(names[key])
            else:
                spark.conf.set(names[key], value)


LAZY = [
    "repo_activity_daily", "issue_lifecycle", "comment_fact", "issue_timeline", "stage_issues", "chunk_load_counts",
    "pending_chunks", "repository_status", "dq_summary", "cross_grain_date_filter", "load_audit", "load_gap_check",
]


@pytest.mark.parametrize("name", LAZY)
def test_nothing_is_crossed_or_run_in_python(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_daily_fact_copies_no_rows(tables):
    text = plan(models.repo_activity_daily(tables))
    assert "Expand" not in text
    # Spread by contributor first, then brought together per group.
    assert len(re.findall(r"Exchange hashpartitioning\(activity_date.*author_username", text)) == 1


def test_documents_are_parsed_and_walked_once(tables):
    text = plan(staging.stage_issues(raw_issues(tables)))
    assert text.count("WindowGroupLimit") == 2
    optimized = staging.type_issues(raw_issues(tables))._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("parseJson") == 1


def test_only_the_latest_load_is_typed(tables):
    for staged in (staging.stage_issues(raw_issues(tables)), staging.stage_comments(raw_comments(tables))):
        above_window = staged._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[0]
        assert "variant_get(raw_data" in above_window


def test_comments_move_once(tables):
    comments = tables.lineitem.select(
        F.col("l_partkey").alias("comment_id"),
        F.col("l_orderkey").alias("issue_number"),
        F.lit("o/r").alias("repository_full_name"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.lit("u").alias("author_username"),
        F.lit(1).alias("author_id"),
        F.lit("text").alias("body"),
        F.lit("url").alias("html_url"),
    )
    text = plan(marts.comment_fact(comments, models.lifecycle(tables)))
    above_join = text.split("Join", 1)[0]
    assert "Exchange" not in above_join
    assert len(re.findall(r"Exchange hashpartitioning\(repository_full_name", text)) <= 2
    assert text.count("Window [row_number()") == 1


def test_unneeded_columns_are_not_read(tables):
    text = plan(models.lifecycle(tables).select("issue_id", "state"))
    assert "l_shipdate" not in text and "o_totalprice" not in text


def test_watermark_reaches_the_scan(spark, tmp_path, tables):
    issues = publish_table(models.issue_metrics(tables), str(tmp_path / "issues"))
    target = marts.repo_activity_daily(
        issues.where("created_at < timestamp_ntz'2000-01-01'"), models.known_metrics(tables), roles.AS_OF
    )
    stored = publish_table(target, str(tmp_path / "daily"))
    text = plan(incremental.append_daily(issues, models.known_metrics(tables), stored, roles.AS_OF))
    assert "GreaterThanOrEqual(created_at,1999-12-31T00:00)" in text or "GreaterThanOrEqual(created_at,2000" in text


def test_landing_reads_only_the_dates(spark, tmp_path, tables):
    from datetime import date

    from pulsemill.bindings.loads import landed_events

    root = str(tmp_path / "landing")
    landed_events(tables.events, root)
    text = plan(read_landing(spark, root, "issues", date(2024, 1, 3), date(2024, 1, 4)))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    assert "entity" in filters and "load_date" in filters


def test_hot_key_sends_one_row_per_input_partition(spark):
    df = spark.range(0, 40_000, 1, 8).select((F.col("id") % 1).alias("k"), "id")
    latest = latest_by_key(df, ["k"], [F.col("id").desc()])
    assert "Partial" in plan(latest)
    assert latest.first()["id"] == 39_999


def test_hot_repository_is_split_in_the_join(spark):
    """A third of the issues belong to one repository; the join splits it at run time."""
    keys = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id").cast("string")))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    issues = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("issue_id"), F.col("id").alias("issue_number"), F.sha2(F.col("id").cast("string"), 512).alias("title"),
        keys.alias("repository"), stamp.alias("created_at"), stamp.alias("updated_at"), stamp.alias("closed_at"),
        F.lit("open").alias("state"), F.lit(False).alias("is_pull_request"), F.lit("u").alias("author_username"),
        F.lit(1).alias("author_id"), F.lit(0).alias("comment_count"), F.lit(None).cast("string").alias("labels_json"),
        F.lit("u").alias("html_url"),
    )
    names = cut_lineage(issues.select("repository").distinct())
    repos = names.select(
        F.xxhash64("repository").alias("repository_id"), F.col("repository").alias("full_name"), F.lit("o").alias("owner_username")
    )
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="100k",
        shuffle__partitions="16",
    ):
        fact = marts.issue_lifecycle(issues, repos, "2024-02-01")
        rows = fact.collect()
        assert len(rows) == 60_000 and all(r["repository_id"] is not None for r in rows)
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
