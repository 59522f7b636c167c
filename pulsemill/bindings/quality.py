"""Data checks over whole tables."""

from __future__ import annotations

from pulsemill.bindings import roles
from pulsemill.bindings.models import accepted_lifecycle, lifecycle
from pulsemill.bindings.roles import AS_OF, ISSUES_SQL, REPOSITORIES_SQL, Tables, binder
from pulsemill.plans import quality

BOUND: dict = {}
bind = binder(BOUND)


def check_sql(check: str, model: str, column: str, failing: str, source: str) -> str:
    return f"""
    SELECT '{check}' AS check_name, '{model}' AS model, '{column}' AS column_name, failing AS failing_rows,
           CAST(failing AS DOUBLE) AS measured, CASE WHEN failing > 0 THEN 'error' ELSE 'pass' END AS status
    FROM (SELECT CAST({failing} AS BIGINT) AS failing FROM {source})"""


def repeated(column: str, source: str) -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"


UNIQUE_SQL = (
    check_sql("unique", "orders", "o_orderkey", "count(*)", repeated("o_orderkey", "orders"))
    + " UNION ALL "
    + check_sql("unique", "lineitem", "l_orderkey", "count(*)", repeated("l_orderkey", "lineitem"))
)


@bind("dq_unique", UNIQUE_SQL)
def dq_unique(t: Tables):
    return quality.combine(
        [quality.unique(t.orders, "orders", "o_orderkey"), quality.unique(t.lineitem, "lineitem", "l_orderkey")]
    )


NOT_NULL_SQL = f"WITH {ISSUES_SQL} " + " UNION ALL ".join(
    check_sql("not_null", "issues", c, f"count(*) FILTER ({c} IS NULL)", "issues")
    for c in ("issue_id", "closed_at", "milestone_title")
)


@bind("dq_not_null", NOT_NULL_SQL)
def dq_not_null(t: Tables):
    return quality.column_checks(roles.issues(t), "issues", ["issue_id", "closed_at", "milestone_title"])


ACCEPTED_SQL = (
    f"WITH {ISSUES_SQL} "
    + check_sql("accepted_values", "issues", "state", "count(*) FILTER (state NOT IN ('open', 'closed'))", "issues")
    + " UNION ALL "
    + check_sql(
        "accepted_values",
        "issues",
        "author_username",
        "count(*) FILTER (author_username NOT IN ('author-1','author-2','author-3','author-4','author-5'))",
        "issues",
    )
)


@bind("dq_accepted_values", ACCEPTED_SQL)
def dq_accepted_values(t: Tables):
    authors = [f"author-{i}" for i in range(1, 6)]
    return quality.column_checks(
        roles.issues(t), "issues", accepted={"state": quality.ISSUE_STATES, "author_username": authors}
    )


RELATION_SQL = (
    f"WITH {ISSUES_SQL}, {REPOSITORIES_SQL} "
    + check_sql(
        "relationships",
        "issues",
        "repository",
        "count(*)",
        "issues WHERE repository NOT IN (SELECT full_name FROM repositories WHERE is_known)",
    )
    + " UNION ALL "
    + check_sql(
        "relationships", "lineitem", "l_orderkey", "count(*)", "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"
    )
)


@bind("dq_relationships", RELATION_SQL)
def dq_relationships(t: Tables):
    return quality.combine(
        [
            quality.relationships(
                roles.issues(t), "issues", "repository", roles.known_repositories(t), "full_name"
            ),
            quality.relationships(t.lineitem, "lineitem", "l_orderkey", t.orders, "o_orderkey"),
        ]
    )


def age_sql(check: str, table: str, column: str, as_of: str, failing: str, status: str) -> str:
    return f"""
    SELECT '{check}' AS check_name, '{table}' AS model, '{column}' AS column_name,
           CAST({failing} AS BIGINT) AS failing_rows, age AS measured, {status} AS status
    FROM (SELECT (epoch_us(TIMESTAMP '{as_of}') - epoch_us(max({column}))) / 3600000000 AS age FROM {table})"""


LOADS = [("events", "ts", "2024-02-01 00:00:00"), ("events", "ts", "2024-02-02 12:00:00"), ("orders", "o_orderdate", AS_OF)]

RECENCY_SQL = " UNION ALL ".join(
    age_sql("recency", *load, "age > 48", "CASE WHEN age > 48 THEN 'error' ELSE 'pass' END") for load in LOADS
)
FRESHNESS_SQL = " UNION ALL ".join(
    age_sql(
        "freshness",
        *load,
        "age > 24",
        "CASE WHEN age > 48 THEN 'error' WHEN age > 24 THEN 'warn' ELSE 'pass' END",
    )
    for load in LOADS
)


@bind("dq_recency", RECENCY_SQL)
def dq_recency(t: Tables):
    return quality.combine(
        [quality.recency(getattr(t, table), table, column, now) for table, column, now in LOADS]
    )


@bind("dq_freshness", FRESHNESS_SQL)
def dq_freshness(t: Tables):
    """One load is fresh, one is late, one is too old."""
    return quality.combine(
        [quality.freshness(getattr(t, table), table, column, now) for table, column, now in LOADS]
    )


REQUIRED = ["issue_id", "closed_at", "milestone_title", "created_at"]

NULL_SHARE_SQL = f"""
    WITH {ISSUES_SQL}
    SELECT 'null_percentage' AS check_name, 'issues' AS model, '{",".join(REQUIRED)}' AS column_name,
      CAST(missing AS BIGINT) AS failing_rows, CAST(missing AS DOUBLE) * 100.0::DOUBLE / n_values AS measured,
      CASE WHEN CAST(missing AS DOUBLE) * 100 / n_values > 5 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT sum({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in REQUIRED)}) AS missing,
                 count(*) * {len(REQUIRED)} AS n_values FROM issues)"""


@bind("dq_null_percentage", NULL_SHARE_SQL)
def dq_null_percentage(t: Tables):
    return quality.null_percentage(roles.issues(t), "issues", REQUIRED)


@bind(
    "dq_required_fields",
    f"""
    WITH {ISSUES_SQL}
    SELECT issue_id, concat_ws(',', CASE WHEN closed_at IS NULL THEN 'closed_at' END,
                                    CASE WHEN milestone_title IS NULL THEN 'milestone_title' END) AS missing_fields
    FROM issues WHERE closed_at IS NULL OR milestone_title IS NULL
    """,
)
def dq_required_fields(t: Tables):
    return quality.rows_missing_fields(roles.issues(t), REQUIRED).select("issue_id", "missing_fields")


@bind(
    "dq_min_monthly_rows",
    """
    WITH counted AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1),
    months AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM counted)
    SELECT 'orders' AS model, CAST(months.m AS DATE) AS month, coalesce(n, 0) AS row_count
    FROM months LEFT JOIN counted ON counted.m = months.m WHERE coalesce(n, 0) < 185
    """,
)
def dq_min_monthly_rows(t: Tables):
    return quality.thin_months(t.orders, "orders", "o_orderdate", 185)


ALL_SQL = f"""
    SELECT status, count(*) AS checks, CAST(sum(failing_rows) AS BIGINT) AS failing_rows
    FROM (SELECT * FROM ({UNIQUE_SQL}) UNION ALL SELECT * FROM ({NOT_NULL_SQL})
          UNION ALL SELECT * FROM ({ACCEPTED_SQL}) UNION ALL SELECT * FROM ({RELATION_SQL})
          UNION ALL SELECT * FROM ({RECENCY_SQL}) UNION ALL SELECT * FROM ({FRESHNESS_SQL})
          UNION ALL SELECT * FROM ({NULL_SHARE_SQL}))
    GROUP BY status"""


@bind("dq_summary", ALL_SQL)
def dq_summary(t: Tables):
    """All checks; every table is scanned once for its own ones."""
    return quality.summary(all_checks(t))


def all_checks(t: Tables):
    authors = [f"author-{i}" for i in range(1, 6)]
    accepted = {"state": quality.ISSUE_STATES, "author_username": authors}
    events = [quality.Load(column, now) for table, column, now in LOADS if table == "events"]
    issues = quality.table_checks(
        roles.issues(t), "issues", None, ["issue_id", "closed_at", "milestone_title"], accepted, required=REQUIRED
    )
    return quality.combine(
        [
            quality.table_checks(t.orders, "orders", "o_orderkey", loads=[quality.Load("o_orderdate", AS_OF)]),
            quality.table_checks(t.lineitem, "lineitem", "l_orderkey"),
            issues,
            quality.table_checks(t.events, "events", loads=events),
            dq_relationships(t),
        ]
    )


@bind(
    "dq_mart_checks",
    f"""
    WITH {ISSUES_SQL}, {REPOSITORIES_SQL}, known AS (SELECT * FROM repositories WHERE is_known) """
    + " UNION ALL ".join(
        [
            check_sql("unique", "fct_issue_lifecycle", "issue_id", "count(*)", repeated("issue_id", "issues")),
            check_sql(
                "not_null",
                "fct_issue_lifecycle",
                "repository_id",
                "count(*)",
                "issues WHERE repository NOT IN (SELECT full_name FROM known)",
            ),
            check_sql(
                "accepted_values", "fct_issue_lifecycle", "state", "count(*)", "issues WHERE state NOT IN ('open', 'closed')"
            ),
            check_sql(
                "relationships",
                "lineitem",
                "l_orderkey",
                "count(*)",
                "lineitem WHERE l_orderkey NOT IN (SELECT issue_id FROM issues WHERE state <> 'pending')",
            ),
        ]
    ),
)
def dq_mart_checks(t: Tables):
    """Checks on the lifecycle fact and on comments against its accepted issues."""
    fact = lifecycle(t)
    return quality.combine(
        [
            quality.table_checks(
                fact, "fct_issue_lifecycle", "issue_id", ["repository_id"], {"state": quality.ISSUE_STATES}
            ),
            quality.relationships(t.lineitem, "lineitem", "l_orderkey", accepted_lifecycle(t), "issue_id"),
        ]
    )
