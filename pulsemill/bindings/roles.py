"""Which driver table plays which part, in Spark and in SQL.

Customers are repositories, orders are issues (priority 1 and 2 are pull requests),
line items are comments. The SQL texts are common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.session import configure

AS_OF = "2002-01-01 00:00:00"
EVENTS_AS_OF = "2024-02-01 00:00:00"


class Tables:
    """Parquet tables of one folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def binder(registry: dict):
    """Decorator that registers ``function(tables)`` with its SQL (None: rows only)."""

    def bind(name: str, sql: str | None):
        def register(function):
            def query(spark: SparkSession, folder: str) -> DataFrame:
                return function(Tables(spark, folder))

            query.__doc__ = function.__doc__
            registry[name] = (query, sql)
            return function

        return register

    return bind


def customer_name(key: str):
    return F.concat(F.lit("Customer#"), F.lpad(F.col(key).cast("string"), 9, "0"))


def seconds(amount):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), amount.cast("decimal(18,6)"))


def issues(t: Tables) -> DataFrame:
    """Orders in the shape of staged issues."""
    totals = t.lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n_items")
    )
    orders = t.orders.join(totals, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    urgency = F.substring("o_orderpriority", 1, 1)
    finished = F.col("last_ship") + seconds(F.floor("o_totalprice"))
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("issue_id"),
        F.col("o_orderkey").alias("issue_number"),
        F.concat("o_orderpriority", F.lit(" "), F.repeat(F.lit("word "), urgency.cast("int") * 5 - 5)).alias("title"),
        F.when(status == "F", "closed").when(status == "O", "open").otherwise("pending").alias("state"),
        customer_name("o_custkey").alias("repository"),
        F.concat(F.lit("author-"), urgency).alias("author_username"),
        urgency.cast("bigint").alias("author_id"),
        F.when(F.col("o_totalprice") > 250000, "assignee").alias("assignee_username"),
        F.when(F.col("o_totalprice") < 100000, "small").alias("milestone_title"),
        (urgency.cast("bigint") - 1).alias("label_count"),
        F.col("o_orderdate").alias("created_at"),
        F.greatest("o_orderdate", finished).alias("updated_at"),
        F.when(status == "F", finished).alias("closed_at"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("comment_count"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_pull_request"),
        F.lit(None).cast("string").alias("labels_json"),
        F.concat(F.lit("https://example.com/issues/"), F.col("o_orderkey").cast("string")).alias("html_url"),
    )


ISSUES_SQL = """
item_totals AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship, count(*) AS n_items FROM lineitem GROUP BY l_orderkey
),
finished AS (
  SELECT o.*, n_items, substr(o_orderpriority, 1, 1) AS urgency,
         last_ship + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS finished_at
  FROM orders o LEFT JOIN item_totals ON l_orderkey = o_orderkey
),
issues AS (
  SELECT o_orderkey AS issue_id, o_orderkey AS issue_number,
         o_orderpriority || ' ' || repeat('word ', CAST(urgency AS INT) * 5 - 5) AS title,
         CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'pending' END AS state,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS repository,
         'author-' || urgency AS author_username,
         CAST(urgency AS BIGINT) AS author_id,
         CASE WHEN o_totalprice > 250000 THEN 'assignee' END AS assignee_username,
         CASE WHEN o_totalprice < 100000 THEN 'small' END AS milestone_title,
         CAST(urgency AS BIGINT) - 1 AS label_count,
         o_orderdate AS created_at,
         greatest(o_orderdate, finished_at) AS updated_at,
         CASE WHEN o_orderstatus = 'F' THEN finished_at END AS closed_at,
         coalesce(n_items, 0) AS comment_count,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_pull_request,
         CAST(NULL AS VARCHAR) AS labels_json,
         'https://example.com/issues/' || CAST(o_orderkey AS VARCHAR) AS html_url
  FROM finished
)"""


def repositories(t: Tables) -> DataFrame:
    """Customers in the shape of staged repositories."""
    span = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    nation = F.col("c_nationkey").cast("bigint")
    return t.customer.join(span, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("c_custkey").alias("repository_id"),
        F.replace("c_name", F.lit("Customer#"), F.lit("project-")).alias("repository_name"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("owner-"), nation.cast("string")).alias("owner_username"),
        F.col("c_mktsegment").alias("primary_language"),
        F.floor(F.col("c_acctbal") * 2).cast("bigint").alias("stars_count"),
        (nation * 7).alias("watchers_count"),
        nation.alias("forks_count"),
        F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("open_issues_count"),
        F.col("first_order").alias("created_at"),
        F.col("last_order").alias("updated_at"),
        F.col("last_order").alias("pushed_at"),
        F.col("last_order").alias("loaded_at"),
        (F.col("c_acctbal") >= 0).alias("is_known"),
    )


REPOSITORIES_SQL = """
order_span AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, count(*) AS n_orders
  FROM orders GROUP BY o_custkey
),
repositories AS (
  SELECT c_custkey AS repository_id, replace(c_name, 'Customer#', 'project-') AS repository_name,
         c_name AS full_name, 'owner-' || CAST(c_nationkey AS VARCHAR) AS owner_username,
         c_mktsegment AS primary_language,
         CAST(floor(c_acctbal * 2) AS BIGINT) AS stars_count,
         CAST(c_nationkey AS BIGINT) * 7 AS watchers_count, CAST(c_nationkey AS BIGINT) AS forks_count,
         coalesce(n_orders, 0) AS open_issues_count,
         first_order AS created_at, last_order AS updated_at, last_order AS pushed_at, last_order AS loaded_at,
         c_acctbal >= 0 AS is_known
  FROM customer LEFT JOIN order_span ON o_custkey = c_custkey
)"""


def known_repositories(t: Tables) -> DataFrame:
    """Repositories with a non-negative balance; issues of the others have no parent."""
    return repositories(t).where("is_known")


def comments(t: Tables) -> DataFrame:
    """Line items in the shape of staged comments on their order."""
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        key.alias("comment_id"),
        F.col("o_orderkey").alias("issue_number"),
        customer_name("o_custkey").alias("repository_full_name"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("author_username"),
        F.col("l_suppkey").alias("author_id"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", "l_linenumber").alias("body"),
        F.lit(None).cast("string").alias("html_url"),
    )


COMMENTS_SQL = """
comments AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS comment_id,
         o_orderkey AS issue_number,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS repository_full_name,
         l_shipdate AS created_at, l_shipdate AS updated_at,
         'supplier-' || CAST(l_suppkey AS VARCHAR) AS author_username, l_suppkey AS author_id,
         concat_ws(' ', l_returnflag, l_linestatus, l_linenumber) AS body,
         CAST(NULL AS VARCHAR) AS html_url
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""
