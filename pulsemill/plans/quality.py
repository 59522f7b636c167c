"""Declarative data checks. Every check gives rows of one result table.

Columns: ``check_name``, ``model``, ``column_name``, ``failing_rows``, ``measured`` (the
figure compared with a limit), ``status`` (pass, warn or error).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.temporal import AsOf, as_of_timestamp
from pulsemill.functions.variants import subdocument

# Limits of the declared checks.
FRESH_WARN_HOURS = 24
FRESH_ERROR_HOURS = 48
MAX_NULL_PERCENTAGE = 5.0
MIN_ROWS_PER_MONTH = 1
ISSUE_STATES = ["open", "closed"]
STATUS_LABELS = ["Open", "Closed", "Unknown"]

# Fields a landed document must have.
REQUIRED_ISSUE = ["id", "number", "title", "state", "created_at"]
REQUIRED_REPOSITORY = ["id", "name", "full_name", "created_at"]
REQUIRED_COMMENT = ["id", "issue_url", "created_at", "body"]


def result(
    check: str, model: str, column: str, failing: Column, measured: Column | None = None, status: Column | None = None
) -> list[Column]:
    failing = failing.cast("bigint")
    if status is None:
        status = F.when(failing > 0, "error").otherwise("pass")
    return [
        F.lit(check).alias("check_name"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        failing.alias("failing_rows"),
        (failing if measured is None else measured).cast("double").alias("measured"),
        status.alias("status"),
    ]


def column_checks(
    df: DataFrame,
    model: str,
    not_null: list[str] | None = None,
    accepted: dict[str, list] | None = None,
) -> DataFrame:
    """All not-null and accepted-values checks of a model in one pass over it."""
    counts, rows = [], []
    for column in not_null or []:
        counts.append(F.count_if(F.col(column).isNull()).alias(f"null_{column}"))
        rows.append(F.struct(*result("not_null", model, column, F.col(f"null_{column}"))))
    for column, values in (accepted or {}).items():
        counts.append(F.count_if(~F.col(column).isin(values)).alias(f"other_{column}"))
        rows.append(F.struct(*result("accepted_values", model, column, F.col(f"other_{column}"))))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Counts the values that occur more than once; NULLs do not collide."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return repeated.agg(F.count_if(F.col("_n") > 1).alias("_failing")).select(
        *result("unique", model, column, F.col("_failing"))
    )


def relationships(
    child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Counts child rows whose key is not in the parent.

    Both sides are reduced to one row per key before the join, so neither a parent with
    very many children nor one that is repeated gathers in one task.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(parent_column).alias("_parent")).distinct()
    orphans = keys.join(parents, F.col(column) == F.col("_parent"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_failing")).select(
        *result("relationships", model, column, F.col("_failing"))
    )


def hours_since(newest: Column, as_of: AsOf) -> Column:
    micros = F.unix_micros(as_of_timestamp(as_of).cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))
    return micros / F.lit(3_600_000_000)


def age_in_hours(df: DataFrame, column: str, as_of: AsOf) -> DataFrame:
    """Hours since the newest value; NULL for an empty table."""
    return df.agg(hours_since(F.max(column), as_of).alias("_age"))


def recency_result(model: str, column: str, age: Column, hours: int = FRESH_ERROR_HOURS) -> list[Column]:
    return result("recency", model, column, F.coalesce(age > hours, F.lit(True)).cast("int"), age)


def freshness_result(
    model: str, column: str, age: Column, warn_hours: int = FRESH_WARN_HOURS, error_hours: int = FRESH_ERROR_HOURS
) -> list[Column]:
    status = (
        F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    )
    return result("freshness", model, column, (status != "pass").cast("int"), age, status)


AGE_RESULTS = {"recency": recency_result, "freshness": freshness_result}


def recency(df: DataFrame, model: str, column: str, as_of: AsOf, hours: int = FRESH_ERROR_HOURS) -> DataFrame:
    """Fails if nothing was loaded in the last ``hours``, or ever."""
    return age_in_hours(df, column, as_of).select(*recency_result(model, column, F.col("_age"), hours))


def freshness(
    df: DataFrame,
    model: str,
    column: str,
    as_of: AsOf,
    warn_hours: int = FRESH_WARN_HOURS,
    error_hours: int = FRESH_ERROR_HOURS,
) -> DataFrame:
    """Two-level age check: warn, then error."""
    return age_in_hours(df, column, as_of).select(
        *freshness_result(model, column, F.col("_age"), warn_hours, error_hours)
    )


def missing_result(
    model: str, required: list[str], missing: Column, values: Column, limit: float = MAX_NULL_PERCENTAGE, strict: bool = False
) -> list[Column]:
    share = F.when(values > 0, missing * 100.0 / values).otherwise(0.0)
    status = F.when(share > limit, "error" if strict else "warn").otherwise("pass")
    return result("null_percentage", model, ",".join(required), missing, share, status)


def null_percentage(
    df: DataFrame,
    model: str,
    required: list[str],
    limit: float = MAX_NULL_PERCENTAGE,
    strict: bool = False,
) -> DataFrame:
    """Share of required values that are missing, over all rows and fields."""
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in required], F.lit(0))
    totals = df.agg(
        F.coalesce(F.sum(missing), F.lit(0)).cast("bigint").alias("_missing"),
        (F.count(F.lit(1)) * len(required)).alias("_values"),
    )
    return totals.select(*missing_result(model, required, F.col("_missing"), F.col("_values"), limit, strict))


def required_of_documents(raw: DataFrame, required: list[str]) -> DataFrame:
    """One column per required field of RAW documents, NULL where a document lacks it.

    Feed it to ``null_percentage`` or ``rows_missing_fields``.
    """
    parts = [subdocument(F.col("raw_data"), f"$.{name}").alias(name) for name in required]
    return raw.select("source_file", *parts)


def rows_missing_fields(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows that lack a required field, with the names of the fields they lack."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return df.withColumn("missing_fields", F.array_join(names, ",")).where(F.size(names) > 0)


def thin_months(
    df: DataFrame, model: str, column: str, minimum: int = MIN_ROWS_PER_MONTH
) -> DataFrame:
    """Months between the first and the last row that have fewer rows than wanted.

    Months without any row are reported too, with count 0.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.trunc(F.to_date(column), "MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    span = counted.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    months = span.where("first is not null").select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month")
    )
    return (
        months.join(counted, "month", "left")
        .select(F.lit(model).alias("model"), "month", F.coalesce("_n", F.lit(0)).alias("row_count"))
        .where(F.col("row_count") < minimum)
    )


@dataclass(frozen=True)
class Load:
    """When the newest row of a table was loaded, judged at ``as_of``."""

    column: str
    as_of: AsOf
    checks: tuple[str, ...] = ("recency", "freshness")


def table_checks(
    df: DataFrame,
    model: str,
    key: str | None = None,
    not_null: list[str] | None = None,
    accepted: dict[str, list] | None = None,
    loads: list[Load] | None = None,
    required: list[str] | None = None,
) -> DataFrame:
    """Uniqueness of ``key``, not-null, accepted values, age of the newest load and share of
    missing ``required`` values, all from one scan of the table.

    Rows are summed by key, combined before the exchange, and the sums once more: a key that comes
    twice is a group of two rows, and the other figures are sums over the groups. Without a key there is no
    exchange of rows at all. The rows are those of the single checks.
    """
    counts: dict[str, Column] = {}
    rows: list[Column] = []

    def counted(name: str, condition: Column) -> Column:
        counts[name] = F.count_if(condition)
        return F.coalesce(F.col(name), F.lit(0))

    if key is not None:
        rows.append(F.struct(*result("unique", model, key, F.col("_repeated"))))
    for column in not_null or []:
        rows.append(F.struct(*result("not_null", model, column, counted(f"_null_{column}", F.col(column).isNull()))))
    for column, values in (accepted or {}).items():
        rows.append(F.struct(*result("accepted_values", model, column, counted(f"_other_{column}", ~F.col(column).isin(values)))))
    if required:
        missing = reduce(lambda a, b: a + b, [counted(f"_null_{c}", F.col(c).isNull()) for c in required])
        rows.append(F.struct(*missing_result(model, required, missing, F.col("_rows") * len(required))))
    newest = {f"_newest_{load.column}": F.max(load.column) for load in loads or []}
    for load in loads or []:
        age = hours_since(F.col(f"_newest_{load.column}"), load.as_of)
        for check in load.checks:
            rows.append(F.struct(*AGE_RESULTS[check](model, load.column, age)))

    sums = [value.alias(name) for name, value in counts.items()] + [value.alias(name) for name, value in newest.items()]
    size = F.count(F.lit(1))
    if key is None:
        totals = df.agg(size.alias("_rows"), *sums)
    else:
        by_key = df.groupBy(F.col(key).alias("_key")).agg(size.alias("_rows"), *sums)
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1))
        totals = by_key.agg(
            repeated.alias("_repeated"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
            *[F.sum(name).alias(name) for name in counts],
            *[F.max(name).alias(name) for name in newest],
        )
    return totals.select(F.inline(F.array(*rows)))


def combine(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def summary(results: DataFrame) -> DataFrame:
    """How many checks ended in each status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("failing_rows").alias("failing_rows")
    )


def require_passed(results: DataFrame) -> None:
    """Gate: raise if a check ended in error. Reads one row per check."""
    bad = results.where("status = 'error'").select("check_name", "model", "column_name", "failing_rows").collect()
    if bad:
        raise ValueError("failed checks: " + "; ".join(str(row.asDict()) for row in bad))


def staging_checks(issues: DataFrame, repositories: DataFrame, comments: DataFrame) -> DataFrame:
    """The checks declared for the staging models; each is scanned once."""
    return combine(
        [
            table_checks(issues, "stg_issues", "issue_id", ["issue_id", "created_at"], {"state": ISSUE_STATES}),
            table_checks(repositories, "stg_repositories", "repository_id", ["repository_id", "repository_name"]),
            table_checks(comments, "stg_comments", "comment_id", ["comment_id"]),
        ]
    )


def mart_checks(
    repositories: DataFrame, lifecycle: DataFrame, comments: DataFrame, dates: DataFrame
) -> DataFrame:
    """The checks declared for the marts; each is scanned once, and two of them for the reference between them."""
    return combine(
        [
            table_checks(repositories, "dim_repository", "repository_id", ["repository_id"]),
            table_checks(
                lifecycle,
                "fct_issue_lifecycle",
                "issue_key",
                ["issue_key", "issue_id", "created_date", "duration_days"],
                {"status_label": STATUS_LABELS},
            ),
            table_checks(
                comments,
                "fct_issue_comments",
                "comment_key",
                ["comment_key", "comment_id", "issue_id", "comment_date_key"],
            ),
            relationships(comments, "fct_issue_comments", "issue_id", lifecycle, "issue_id"),
            table_checks(dates, "dim_date", "date_key", ["date_key"]),
        ]
    )
