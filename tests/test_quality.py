from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import date_spine
from pulsemill.plans import audit, quality


def first(df):
    return df.first().asDict()


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert first(quality.unique(df, "m", "k"))["failing_rows"] == 1


def test_column_checks_in_one_pass(spark):
    df = spark.createDataFrame([(1, "open"), (None, "closed"), (3, "odd"), (4, None)], "k long, s string")
    got = {
        (r["check_name"], r["column_name"]): (r["failing_rows"], r["status"])
        for r in quality.column_checks(df, "m", ["k"], {"s": quality.ISSUE_STATES}).collect()
    }
    assert got == {("not_null", "k"): (1, "error"), ("accepted_values", "s"): (1, "error")}


def test_relationships_count_rows(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p long")
    assert first(quality.relationships(child, "m", "k", parent, "p"))["failing_rows"] == 2


@pytest.mark.parametrize(
    "now, recency, freshness",
    [
        ("2024-01-02 00:00:00", "pass", "pass"),
        ("2024-01-02 00:00:01", "pass", "warn"),
        ("2024-01-03 00:00:01", "error", "error"),
    ],
)
def test_age_checks(spark, now, recency, freshness):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as at")
    assert first(quality.recency(df, "m", "at", now))["status"] == recency
    assert first(quality.freshness(df, "m", "at", now))["status"] == freshness


def test_age_checks_fail_on_an_empty_table(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as at where false")
    assert first(quality.recency(df, "m", "at", "2024-01-01"))["status"] == "error"
    assert first(quality.freshness(df, "m", "at", "2024-01-01"))["status"] == "error"


def test_null_percentage(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    row = first(quality.null_percentage(df, "m", ["a", "b"]))
    assert (row["failing_rows"], row["measured"], row["status"]) == (1, 25.0, "warn")
    assert first(quality.null_percentage(df, "m", ["a", "b"], strict=True))["status"] == "error"
    assert first(quality.null_percentage(df, "m", ["a"]))["status"] == "pass"
    # Neither rows nor fields: nothing is missing.
    assert first(quality.null_percentage(df.limit(0), "m", ["a"]))["measured"] == 0.0
    assert first(quality.null_percentage(df, "m", []))["measured"] == 0.0


def test_rows_missing_fields(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, "x", "y")], "id long, a string, b string")
    got = {r["id"]: r["missing_fields"] for r in quality.rows_missing_fields(df, ["a", "b"]).collect()}
    assert got == {1: "a,b", 2: "b"}


def test_required_fields_of_documents(raw):
    frame = raw(
        ('{"id":1,"name":"r","full_name":"o/r","created_at":"2024-01-01T00:00:00Z"}', "2024-01-01", "a", 0),
        ('{"id":2,"name":null,"full_name":"o/s"}', "2024-01-01", "b", 0),
    )
    fields = quality.required_of_documents(frame, quality.REQUIRED_REPOSITORY)
    row = first(quality.null_percentage(fields, "repositories", quality.REQUIRED_REPOSITORY))
    assert (row["failing_rows"], row["measured"], row["status"]) == (2, 25.0, "warn")
    lacking = quality.rows_missing_fields(fields, quality.REQUIRED_REPOSITORY)
    assert [(r["source_file"], r["missing_fields"]) for r in lacking.collect()] == [("b", "name,created_at")]


def test_thin_months_report_empty_ones(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-06",), ("2024-03-01",)], "d string")
    got = quality.thin_months(df.select(F.to_timestamp_ntz("d").alias("at")), "m", "at", 2).collect()
    assert {(r["month"], r["row_count"]) for r in got} == {(date(2024, 2, 1), 0), (date(2024, 3, 1), 1)}


def test_summary_and_gate(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    results = quality.combine([quality.unique(df, "m", "k"), quality.column_checks(df, "m", ["k"])])
    assert {r["status"]: r["checks"] for r in quality.summary(results).collect()} == {"error": 1, "pass": 1}
    with pytest.raises(ValueError, match="unique"):
        quality.require_passed(results)
    quality.require_passed(results.where("status = 'pass'"))


def test_gaps_are_exactly_the_removed_days(spark):
    bounds = spark.sql("select date'2024-02-01' as start_date, date'2024-03-10' as end_date")
    removed = ["2024-02-01", "2024-02-29", "2024-03-09"]
    loads = date_spine(bounds).where(~F.col("date_day").cast("string").isin(removed))
    twice = loads.union(loads).withColumnRenamed("date_day", "loaded_at")
    got = [str(r["missing_date"]) for r in audit.load_gaps(twice, bounds).collect()]
    assert got == removed


def test_spine_end_is_exclusive(spark):
    def count(start, end):
        return date_spine(spark.sql(f"select date'{start}' as start_date, date'{end}' as end_date")).count()

    assert count("2024-01-01", "2024-01-03") == 2
    assert count("2024-01-01", "2024-01-01") == 0
    assert count("2024-01-02", "2024-01-01") == 0


def test_audit_counts_days(spark):
    df = spark.sql("select explode(array(timestamp'2024-01-01 01:00:00', timestamp'2024-01-01 02:00:00', null)) as loaded_at")
    row = first(audit.load_audit({"A": df}))
    assert (row["total_records"], row["distinct_days"]) == (3, 1)


def test_one_scan_gives_what_the_single_checks_give(spark, tmp_path):
    rows = [(1, "open", "2024-01-02"), (1, "odd", None), (2, None, "2024-01-01"), (None, "closed", None), (None, "x", "2024-01-03")]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "k long, s string, at string").withColumn("at", F.col("at").cast("timestamp_ntz")).write.parquet(path)
    for df in (spark.read.parquet(path), spark.read.parquet(path).where("k > 99")):
        single = quality.combine(
            [
                quality.unique(df, "m", "k"),
                quality.column_checks(df, "m", ["k", "s"], {"s": quality.ISSUE_STATES}),
                quality.recency(df, "m", "at", "2024-01-04 06:00:00"),
                quality.freshness(df, "m", "at", "2024-01-04 06:00:00"),
                quality.null_percentage(df, "m", ["k", "at"]),
            ]
        )
        loads = [quality.Load("at", "2024-01-04 06:00:00")]
        for key in ("k", None):
            at_once = quality.table_checks(df, "m", key, ["k", "s"], {"s": quality.ISSUE_STATES}, loads, ["k", "at"])
            wanted = single if key else single.where("check_name <> 'unique'")
            assert sorted(map(str, at_once.collect())) == sorted(map(str, wanted.collect()))
            plan = at_once._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Relation [") == 1


def test_all_checks_scan_each_table_once(spark):
    from pulsemill.bindings import quality as bound
    from pulsemill.bindings.roles import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    plan = bound.all_checks(t)._jdf.queryExecution().optimizedPlan().toString()
    # Orders and line items: their own checks, once as issues, and in the two references.
    assert plan.count("Relation [event_id") == 1
    assert plan.count("Relation [l_orderkey") + plan.count("Relation [o_orderkey") <= 9
