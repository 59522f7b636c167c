from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsemill.functions import (
    capture,
    days_between,
    full_name_from_file_safe,
    guarded_ratio,
    hours_between,
    months_between_boundaries,
    surrogate_key,
    whole_months_between,
    years_between,
)
from pulsemill.plans import metrics


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, hours, days, months, years",
    [
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00", 1, 0, 0, 0),
        ("2024-01-01 01:01:00", "2024-01-01 01:59:00", 0, 0, 0, 0),
        ("2023-12-31 23:59:59", "2024-01-01 00:00:00", 1, 1, 1, 1),
        ("2024-03-01 00:00:00", "2024-02-28 23:00:00", -25, -2, -1, 0),
        ("2024-01-31 00:00:00", "2024-02-01 00:00:00", 24, 1, 1, 0),
    ],
)
def test_differences_count_boundaries(spark, start, end, hours, days, months, years):
    a, b = at(start), at(end)
    row = spark.range(1).select(
        hours_between(a, b), days_between(a, b), months_between_boundaries(a, b), years_between(a, b)
    ).first()
    assert tuple(row) == (hours, days, months, years)


def test_differences_do_not_depend_on_the_session_zone(spark):
    a, b = at("2024-03-10 01:30:00"), at("2024-03-10 03:30:00")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, hours_between(a, b)) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "start, end, months",
    [
        ("2024-01-31 10:00:00", "2024-02-29 09:00:00", 0),
        ("2024-01-31 10:00:00", "2024-02-29 10:00:00", 1),
        ("2024-01-31 10:00:00", "2024-03-31 09:00:00", 1),
        ("2024-01-15 00:00:00", "2025-01-15 00:00:00", 12),
    ],
)
def test_whole_months(spark, start, end, months):
    assert one(spark, whole_months_between(at(start), at(end))) == months


def test_capture_gives_null_without_a_match(spark):
    assert one(spark, capture(F.lit("repos/a/b/issues/7"), "/issues/([0-9]+)")) == "7"
    assert one(spark, capture(F.lit("nothing"), "/issues/([0-9]+)")) is None
    assert one(spark, capture(F.lit(None).cast("string"), "(x)")) is None


def test_only_the_first_underscore_separates(spark):
    assert one(spark, full_name_from_file_safe(F.lit("org_my_repo"))) == "org/my_repo"
    assert one(spark, full_name_from_file_safe(F.lit("plain"))) == "plain"


def test_surrogate_key_tells_null_from_text(spark):
    null, text = F.lit(None).cast("string"), F.lit("null")
    assert one(spark, surrogate_key(null)) != one(spark, surrogate_key(text))
    assert one(spark, surrogate_key(F.lit(1))) == "c4ca4238a0b923820dcc509a6f75849b"


def test_guarded_ratio(spark):
    assert one(spark, guarded_ratio(F.lit(1), F.lit(3))) == 0.3333
    assert one(spark, guarded_ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, guarded_ratio(F.lit(1), F.lit(None).cast("int"))) == 0.0


@pytest.mark.parametrize(
    "function, expected",
    [
        (
            metrics.popularity_tier,
            {
                0: "Emerging (<100 stars)",
                99: "Emerging (<100 stars)",
                100: "Growing (100-1K stars)",
                999: "Growing (100-1K stars)",
                1000: "Popular (1K-10K stars)",
                9999: "Popular (1K-10K stars)",
                10000: "Very Popular (10K+ stars)",
            },
        ),
        (
            metrics.activity_level,
            {
                0: "No comments",
                1: "Low activity",
                5: "Low activity",
                6: "Medium activity",
                20: "Medium activity",
                21: "High activity",
            },
        ),
        (
            metrics.activity_status,
            {
                6: "Very Active",
                7: "Active",
                29: "Active",
                30: "Moderate",
                89: "Moderate",
                90: "Low Activity",
                364: "Low Activity",
                365: "Inactive",
            },
        ),
        (
            lambda n: metrics.title_category(F.repeat(F.lit("x"), n.cast("int"))),
            {29: "Short", 30: "Medium", 79: "Medium", 80: "Long"},
        ),
    ],
)
def test_bucket_edges(spark, function, expected):
    for value, label in expected.items():
        assert one(spark, function(F.lit(value))) == label


@pytest.mark.parametrize(
    "closed, label",
    [
        (None, "Open"),
        ("2024-01-01 10:59:00", "Closed <1 hour"),
        ("2024-01-01 11:00:00", "Closed <1 day"),
        ("2024-01-02 09:59:00", "Closed <1 day"),
        ("2024-01-02 10:00:00", "Closed <1 week"),
        ("2024-01-07 23:00:00", "Closed <1 week"),
        ("2024-01-08 00:00:00", "Closed <1 month"),
        ("2024-01-30 23:00:00", "Closed <1 month"),
        ("2024-01-31 00:00:00", "Closed >1 month"),
    ],
)
def test_resolution_edges(spark, closed, label):
    created = at("2024-01-01 10:00:00")
    done = F.lit(closed).cast("timestamp_ntz")
    assert one(spark, metrics.resolution_bucket(created, done)) == label


def test_as_of_accepts_python_times(spark):
    from pulsemill.functions import as_of_timestamp

    assert one(spark, as_of_timestamp(datetime(2024, 1, 2, 3))) == datetime(2024, 1, 2, 3)
