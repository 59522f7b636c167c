"""Staging from raw documents that Spark builds out of the tables.

Every line item is one load of its order's document, so each id has several loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.bindings.roles import Tables, binder
from pulsemill.plans import staging

BOUND: dict = {}
bind = binder(BOUND)

API = "https://api.example.com/repos/"


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by the id of their document, so that building and parsing documents of a
    table in one file takes as many tasks as the session shuffles with."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def plain_lineage(staged: DataFrame) -> DataFrame:
    """All columns of a staging model, with variants and lengths in types that SQL has too."""
    texts = {c: F.to_json(c) for c, kind in staged.dtypes if kind == "variant"}
    lengths = {c: F.col(c).cast("bigint") for c in ("body_length",) if c in staged.columns}
    return staged.withColumns(texts | lengths | {"loaded_at": F.col("loaded_at").cast("timestamp_ntz")})


def as_raw(rows: DataFrame, fields: list[Column], loaded_at: str, source: Column, tie: Column) -> DataFrame:
    """RAW rows; where a return flag is R, missing values are explicit nulls."""
    plain = F.to_json(F.struct(*fields))
    explicit = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    text = F.when(F.col("l_returnflag") == "R", explicit).otherwise(plain)
    return rows.select(
        F.parse_json(text).alias("raw_data"),
        F.col(loaded_at).cast("timestamp").alias("loaded_at"),
        source.alias("source_file"),
        tie.alias("tie_breaker"),
    )


def item_source() -> Column:
    return F.concat(F.lit("landing/"), F.col("l_suppkey").cast("string"))


def item_tie() -> Column:
    return F.col("l_partkey") * 10 + F.col("l_linenumber")


def order_loads(t: Tables) -> DataFrame:
    return spread(t.lineitem, "l_orderkey").join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))


def raw_issues(t: Tables) -> DataFrame:
    urgency = F.substring("o_orderpriority", 1, 1)
    names = F.transform(F.sequence(F.lit(1), F.col("l_linenumber")), lambda i: F.struct(i.cast("string").alias("name")))
    labels = F.when(F.col("l_linenumber") == 1, None).when(
        F.col("l_linenumber") == 2, F.array().cast("array<struct<name:string>>")
    ).otherwise(names)
    customer = F.col("o_custkey").cast("string")
    fields = [
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("number"),
        F.concat(F.lit("node-"), F.col("o_orderkey").cast("string")).alias("node_id"),
        F.concat_ws(" ", "o_orderpriority", "l_shipdate").alias("title"),
        F.when(F.col("l_linestatus") == "F", "closed").otherwise("open").alias("state"),
        (F.col("l_returnflag") == "A").alias("locked"),
        F.struct(
            F.concat(F.lit("user-"), customer).alias("login"), F.col("o_custkey").alias("id"), F.lit("User").alias("type")
        ).alias("user"),
        F.when(
            F.col("l_discount") > 0.05, F.struct(F.concat(F.lit("s-"), F.col("l_suppkey").cast("string")).alias("login"))
        ).alias("assignee"),
        F.when(F.col("l_discount") > 0.05, F.array(F.struct(F.col("l_suppkey").alias("id")))).alias("assignees"),
        F.concat(F.lit("https://example.com/issues/"), F.col("o_orderkey").cast("string")).alias("html_url"),
        F.concat(F.lit(API + "issues/"), F.col("o_orderkey").cast("string")).alias("url"),
        labels.alias("labels"),
        F.when(F.col("l_tax") > 0.04, F.struct(F.lit("v1").alias("title"), F.col("l_linenumber").alias("number"))).alias(
            "milestone"
        ),
        stamp("o_orderdate").alias("created_at"),
        stamp("l_shipdate").alias("updated_at"),
        F.when(F.col("l_linestatus") == "F", stamp("l_shipdate")).alias("closed_at"),
        F.col("l_quantity").cast("bigint").alias("comments"),
        F.when(urgency.isin("1", "2"), F.struct(F.lit("u").alias("url"))).alias("pull_request"),
        F.concat(F.lit(API + "org/"), customer).alias("repository_url"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("explicit/"), customer)).alias("source_repository"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("body"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("extraction_date"),
    ]
    return as_raw(order_loads(t), fields, "l_shipdate", item_source(), item_tie())


LATEST_LOAD = """
latest_load AS (
  SELECT * FROM (
    SELECT lineitem.*, orders.*, 'landing/' || CAST(l_suppkey AS VARCHAR) AS source_file,
           row_number() OVER (PARTITION BY o_orderkey
             ORDER BY l_shipdate DESC, 'landing/' || CAST(l_suppkey AS VARCHAR) DESC,
                      l_partkey * 10 + l_linenumber DESC) AS rn
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE rn = 1
)"""


@bind(
    "stage_issues",
    f"""
    WITH {LATEST_LOAD}
    SELECT o_orderkey AS issue_id, o_orderkey AS issue_number, 'node-' || CAST(o_orderkey AS VARCHAR) AS node_id,
      o_orderpriority || ' ' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS title,
      CASE WHEN l_linestatus = 'F' THEN 'closed' ELSE 'open' END AS state,
      l_returnflag = 'A' AS is_locked,
      'user-' || CAST(o_custkey AS VARCHAR) AS author_username, o_custkey AS author_id, 'User' AS author_type,
      CASE WHEN l_discount > 0.05 THEN 's-' || CAST(l_suppkey AS VARCHAR) END AS assignee_username,
      CASE WHEN l_discount > 0.05 THEN '[{{"id":' || CAST(l_suppkey AS VARCHAR) || '}}]' END AS assignees_json,
      CASE WHEN l_discount > 0.05 THEN CAST(1 AS BIGINT) END AS assignee_count,
      'https://example.com/issues/' || CAST(o_orderkey AS VARCHAR) AS html_url,
      '{API}issues/' || CAST(o_orderkey AS VARCHAR) AS api_url,
      CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 ELSE CAST(l_linenumber AS BIGINT) END
        AS label_count,
      CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '[]' ELSE
        '[' || array_to_string(list_transform(range(1, l_linenumber + 1),
                 lambda i: '{{"name":"' || CAST(i AS VARCHAR) || '"}}'), ',') || ']' END AS labels_json,
      CASE WHEN l_tax > 0.04 THEN 'v1' END AS milestone_title,
      CASE WHEN l_tax > 0.04 THEN CAST(l_linenumber AS BIGINT) END AS milestone_number,
      o_orderdate AS created_at, l_shipdate AS updated_at,
      CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS closed_at,
      CAST(l_quantity AS BIGINT) AS comment_count,
      o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_pull_request,
      l_returnflag || ' ' || l_linestatus AS body, CAST(3 AS BIGINT) AS body_length,
      CASE WHEN l_linestatus = 'F' THEN 'explicit/' ELSE 'org/' END || CAST(o_custkey AS VARCHAR) AS repository,
      CAST(l_shipdate AS DATE) AS extraction_date, source_file, l_shipdate AS loaded_at
    FROM latest_load
    """,
)
def stage_issues(t: Tables):
    return plain_lineage(staging.stage_issues(raw_issues(t)))


def raw_repositories(t: Tables) -> DataFrame:
    """Every order is one load of its customer's document."""
    name = F.lower("c_name")
    status, order = F.col("o_orderstatus"), F.col("o_orderkey")
    license_of = F.struct(F.lit("Apache-2.0").alias("name"), F.lit("apache-2.0").alias("key"))
    fields = [
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("node-"), F.col("c_custkey").cast("string")).alias("node_id"),
        name.alias("name"),
        F.concat(F.lit("org/"), name).alias("full_name"),
        F.struct(F.col("c_mktsegment").alias("login"), F.col("c_nationkey").alias("id"), F.lit("Organization").alias("type")).alias(
            "owner"
        ),
        F.when(status != "O", F.concat_ws(" ", "c_mktsegment", "o_orderpriority")).alias("description"),
        (F.col("c_acctbal") < 0).alias("private"),
        F.lit(False).alias("fork"),
        (status == "P").alias("archived"),
        (order % 2 == 0).alias("disabled"),
        F.lit("2001-02-03T04:05:06Z").alias("created_at"),
        stamp("o_orderdate").alias("updated_at"),
        stamp("o_orderdate").alias("pushed_at"),
        F.floor("o_totalprice").cast("bigint").alias("stargazers_count"),
        (order * 2).alias("watchers_count"),
        F.col("c_nationkey").alias("forks_count"),
        order.alias("open_issues_count"),
        (order + 1).alias("size"),
        F.col("o_orderpriority").alias("language"),
        F.split("o_orderpriority", "-").alias("topics"),
        F.when(status == "F", license_of).alias("license"),
        (status != "O").alias("has_issues"),
        (order % 3 == 0).alias("has_projects"),
        (order % 5 == 0).alias("has_wiki"),
        (order % 7 == 0).alias("has_pages"),
        (order % 11 == 0).alias("has_downloads"),
        F.concat(F.lit("https://example.com/"), name).alias("html_url"),
        F.when(status == "F", F.concat(F.lit("https://pages.example.com/"), name)).alias("homepage"),
        F.lit("main").alias("default_branch"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("extraction_date"),
    ]
    rows = (
        spread(t.orders, "o_custkey")
        .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .withColumn("l_returnflag", F.when(status == "O", "R").otherwise("N"))
    )
    return as_raw(rows, fields, "o_orderdate", F.col("o_orderpriority"), F.col("o_orderkey"))


@bind(
    "stage_repositories",
    """
    WITH latest_load AS (
      SELECT customer.*, orders.*, lower(c_name) AS low_name FROM orders JOIN customer ON c_custkey = o_custkey
      QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC) = 1)
    SELECT o_orderpriority AS source_file, o_orderdate AS loaded_at, CAST(o_orderdate AS DATE) AS extraction_date,
      c_custkey AS repository_id, 'node-' || CAST(c_custkey AS VARCHAR) AS node_id,
      low_name AS repository_name, 'org/' || low_name AS full_name,
      'https://example.com/' || low_name AS html_url,
      CASE WHEN o_orderstatus = 'F' THEN 'https://pages.example.com/' || low_name END AS homepage_url,
      CASE WHEN o_orderstatus <> 'O' THEN c_mktsegment || ' ' || o_orderpriority END AS description,
      c_mktsegment AS owner_username, CAST(c_nationkey AS BIGINT) AS owner_id, 'Organization' AS owner_type,
      o_orderpriority AS primary_language, 'main' AS default_branch,
      CAST(len(string_split(o_orderpriority, '-')) AS BIGINT) AS topics_count,
      '["' || array_to_string(string_split(o_orderpriority, '-'), '","') || '"]' AS topics_json,
      CASE WHEN o_orderstatus = 'F' THEN 'Apache-2.0' END AS license_name,
      CASE WHEN o_orderstatus = 'F' THEN 'apache-2.0' END AS license_key,
      c_acctbal < 0 AS is_private, FALSE AS is_fork, o_orderstatus = 'P' AS is_archived, o_orderkey % 2 = 0 AS is_disabled,
      o_orderstatus <> 'O' AS has_issues_enabled, o_orderkey % 3 = 0 AS has_projects_enabled, o_orderkey % 5 = 0 AS has_wiki_enabled,
      o_orderkey % 7 = 0 AS has_pages_enabled, o_orderkey % 11 = 0 AS has_downloads_enabled,
      CAST(floor(o_totalprice) AS BIGINT) AS stars_count, o_orderkey * 2 AS watchers_count,
      CAST(c_nationkey AS BIGINT) AS forks_count, o_orderkey AS open_issues_count, o_orderkey + 1 AS size_kb,
      TIMESTAMP '2001-02-03 04:05:06' AS created_at, o_orderdate AS updated_at, o_orderdate AS pushed_at
    FROM latest_load
    """,
)
def stage_repositories(t: Tables):
    return plain_lineage(staging.stage_repositories(raw_repositories(t)))


def raw_comments(t: Tables) -> DataFrame:
    """Comment documents; thumbs are spelled as a word or as a sign, some links are broken."""
    up = F.col("l_linenumber").cast("bigint")
    by_word = F.col("l_linestatus") == "F"
    fields = [
        F.col("o_orderkey").alias("id"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", "l_quantity").alias("body"),
        F.struct(F.concat(F.lit("s-"), F.col("l_suppkey").cast("string")).alias("login"), F.col("l_suppkey").alias("id"), F.lit("User").alias("type")).alias(
            "user"
        ),
        F.when(F.col("o_orderstatus") == "P", F.lit("https://example.com/none"))
        .otherwise(F.concat(F.lit(API + "org/c_"), F.col("o_custkey").cast("string"), F.lit("/issues/"), F.col("o_orderkey").cast("string")))
        .alias("issue_url"),
        stamp("l_shipdate").alias("created_at"),
        F.struct(
            F.col("l_quantity").cast("bigint").alias("total_count"),
            F.when(by_word, up).alias("plus1"),
            F.when(~by_word, up).alias("+1"),
            F.when(by_word, up + 1).alias("minus1"),
            F.when(~by_word, up + 1).alias("-1"),
            F.col("l_partkey").alias("heart"),
            F.when(by_word, up * 2).alias("laugh"),
            (up + 2).alias("hooray"),
            F.when(~by_word, up * 3).alias("confused"),
            (up + 4).alias("rocket"),
            (up + 5).alias("eyes"),
        ).alias("reactions"),
        F.concat(F.lit("node-"), F.col("o_orderkey").cast("string")).alias("node_id"),
        F.when(~by_word, F.concat(F.lit("https://example.com/c/"), F.col("o_orderkey").cast("string"))).alias("html_url"),
        F.concat(F.lit(API + "c/"), F.col("o_orderkey").cast("string")).alias("url"),
        stamp("o_orderdate").alias("updated_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("extraction_date"),
        F.lit("MEMBER").alias("author_association"),
        F.lit("org/x").alias("source_repository"),
    ]
    return as_raw(order_loads(t), fields, "l_shipdate", item_source(), item_tie())


@bind(
    "stage_comments",
    f"""
    WITH {LATEST_LOAD}
    SELECT o_orderkey AS comment_id,
      l_returnflag || ' ' || l_linestatus || ' ' || CAST(l_quantity AS VARCHAR) AS body,
      length(l_returnflag || ' ' || l_linestatus || ' ' || CAST(l_quantity AS VARCHAR)) AS body_length,
      's-' || CAST(l_suppkey AS VARCHAR) AS author_username, l_suppkey AS author_id,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS issue_number,
      CASE WHEN o_orderstatus <> 'P' THEN 'org/c_' || CAST(o_custkey AS VARCHAR) END AS repository_full_name,
      l_shipdate AS created_at, CAST(l_quantity AS BIGINT) AS reaction_count,
      CAST(l_linenumber AS BIGINT) AS thumbs_up_count, CAST(l_linenumber + 1 AS BIGINT) AS thumbs_down_count,
      l_partkey AS heart_count, CASE WHEN l_linestatus = 'F' THEN CAST(l_linenumber * 2 AS BIGINT) END AS laugh_count,
      CAST(l_linenumber + 2 AS BIGINT) AS hooray_count, CASE WHEN l_linestatus <> 'F' THEN CAST(l_linenumber * 3 AS BIGINT) END AS confused_count,
      CAST(l_linenumber + 4 AS BIGINT) AS rocket_count, CAST(l_linenumber + 5 AS BIGINT) AS eyes_count,
      'node-' || CAST(o_orderkey AS VARCHAR) AS node_id, 'User' AS author_type, o_orderdate AS updated_at,
      CASE WHEN o_orderstatus = 'P' THEN 'https://example.com/none'
           ELSE '{API}org/c_' || CAST(o_custkey AS VARCHAR) || '/issues/' || CAST(o_orderkey AS VARCHAR) END AS issue_url,
      CASE WHEN l_linestatus <> 'F' THEN 'https://example.com/c/' || CAST(o_orderkey AS VARCHAR) END AS html_url,
      '{API}c/' || CAST(o_orderkey AS VARCHAR) AS api_url, CAST(l_shipdate AS DATE) AS extraction_date,
      'MEMBER' AS author_association, 'org/x' AS repository,
      source_file, l_shipdate AS loaded_at
    FROM latest_load
    """,
)
def stage_comments(t: Tables):
    return plain_lineage(staging.stage_comments(raw_comments(t)))
