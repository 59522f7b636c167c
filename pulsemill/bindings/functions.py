"""Scalar functions and single operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.bindings import labels
from pulsemill.bindings.roles import EVENTS_AS_OF, Tables, binder
from pulsemill.functions import (
    array_length,
    capture,
    days_between,
    field,
    guarded_ratio,
    hours_between,
    is_present,
    months_between_boundaries,
    subdocument,
    surrogate_key,
    years_between,
)
from pulsemill.operators import (
    conditional_distinct_counts,
    latest_by_key,
    sequence_within,
    top_n_within,
)
from pulsemill.plans import metrics, staging

BOUND: dict = {}
bind = binder(BOUND)


@bind(
    "date_diff_units",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           datediff('hour', a, b) AS hours, datediff('day', a, b) AS days,
           datediff('month', a, b) AS months, datediff('year', a, b) AS years
    FROM (SELECT lineitem.*, o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS a,
                 l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT)) AS b
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    """,
)
def date_diff_units(t: Tables):
    def shifted(day, amount):
        return F.col(day) + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.floor(amount).cast("decimal(18,6)")
        )

    a, b = F.col("a"), F.col("b")
    return (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .withColumns({"a": shifted("o_orderdate", "o_totalprice"), "b": shifted("l_shipdate", "l_extendedprice")})
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            hours_between(a, b).alias("hours"),
            days_between(a, b).alias("days"),
            months_between_boundaries(a, b).alias("months"),
            years_between(a, b).alias("years"),
        )
    )


@bind(
    "case_buckets",
    f"""
    WITH {labels.STEPS_SQL}
    SELECT doc_id, {labels.step_label('title', 'title length')} AS title_length_category,
      {labels.step_label('star', 'stars')} AS popularity_tier, {labels.step_label('talk', 'comments')} AS activity_level
    FROM (SELECT *, length(text) - length(replace(text, ' ', '')) AS n_spaces FROM documents)
    {labels.join_step('title', 'title length', 'length(text)')}
    {labels.join_step('star', 'stars', 'n_chars')}
    {labels.join_step('talk', 'comments', 'n_spaces')}
    """,
)
def case_buckets(t: Tables):
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    return t.documents.select(
        "doc_id",
        metrics.title_category(F.col("text")).alias("title_length_category"),
        metrics.popularity_tier(F.col("n_chars")).alias("popularity_tier"),
        metrics.activity_level(spaces).alias("activity_level"),
    )


@bind(
    "time_buckets",
    f"""
    WITH {labels.STEPS_SQL},
    spans AS (
      SELECT event_id, ts AS created_at,
             CASE WHEN event_type <> 'error' THEN ts + to_minutes(CAST(floor(value * value) AS BIGINT)) END
               AS closed_at
      FROM events)
    SELECT event_id, {labels.resolution_label('closed_at')} AS resolution_time_bucket,
      {labels.step_label('push', 'days since push')} AS activity_status
    FROM spans {labels.join_resolution('created_at', 'closed_at')}
    {labels.join_step('push', 'days since push', f"datediff('day', created_at, TIMESTAMP '{EVENTS_AS_OF}')")}
    """,
)
def time_buckets(t: Tables):
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.floor(F.col("value") * F.col("value")).cast("int"))
    closed = F.when(F.col("event_type") != "error", F.col("ts") + span)
    age = days_between(F.col("ts"), F.lit(EVENTS_AS_OF).cast("timestamp_ntz"))
    return t.events.withColumn("closed_at", closed).select(
        "event_id",
        metrics.resolution_bucket(F.col("ts"), F.col("closed_at")).alias("resolution_time_bucket"),
        metrics.activity_status(age).alias("activity_status"),
    )


@bind(
    "guarded_ratio",
    """
    SELECT p_partkey,
      CASE WHEN p_retailprice > 0 THEN round(CAST(p_size AS DOUBLE) / p_retailprice, 4) ELSE 0.0 END AS size_rate,
      CASE WHEN p_size - 25 > 0 THEN round(p_retailprice / CAST(p_size - 25 AS DOUBLE), 4) ELSE 0.0 END
        AS guarded_rate
    FROM part
    """,
)
def ratio(t: Tables):
    return t.part.select(
        "p_partkey",
        guarded_ratio(F.col("p_size"), F.col("p_retailprice")).alias("size_rate"),
        guarded_ratio(F.col("p_retailprice"), F.col("p_size") - 25).alias("guarded_rate"),
    )


# Fixed value in the SQL: the text that stands for NULL in a key.
@bind(
    "surrogate_key",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      md5(coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS single_key,
      md5(coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
          coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
          coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) AS composite_key
    FROM lineitem
    """,
)
def keys(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        surrogate_key(F.col("l_orderkey")).alias("single_key"),
        surrogate_key(
            F.col("l_orderkey"), F.col("l_linenumber"), F.nullif(F.col("l_returnflag"), F.lit("N"))
        ).alias("composite_key"),
    )


@bind(
    "regex_capture",
    r"""
    SELECT page_id,
      nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1), '') AS lang,
      CAST(nullif(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2), '') AS BIGINT) AS number,
      nullif(regexp_extract(api, 'repos/([^/]+/[^/]+)/', 1), '') AS repository_full_name,
      CAST(nullif(regexp_extract(api, '/issues/([0-9]+)', 1), '') AS BIGINT) AS issue_number
    FROM (SELECT page_id, url, replace(replace(url, '/en/', '/repos/org/en_x/issues/'), '/fr/', '/repos/none/') AS api
          FROM pages)
    """,
)
def regex_capture(t: Tables):
    api = F.replace(
        F.replace("url", F.lit("/en/"), F.lit("/repos/org/en_x/issues/")), F.lit("/fr/"), F.lit("/repos/none/")
    )
    pattern = "/([a-z]{2})/([0-9]+)"
    return t.pages.withColumn("api", api).select(
        "page_id",
        capture(F.col("url"), pattern, 1).alias("lang"),
        capture(F.col("url"), pattern, 2).cast("bigint").alias("number"),
        capture(F.col("api"), staging.REPOSITORY_IN_ISSUE_URL).alias("repository_full_name"),
        capture(F.col("api"), staging.ISSUE_NUMBER_IN_URL).cast("bigint").alias("issue_number"),
    )


@bind(
    "json_extract_typed",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS nested_type,
           user_id AS nested_user, ts AS nested_time, event_type = 'error' AS is_error,
           CAST(NULL AS BIGINT) AS missing_step, CAST(NULL AS BIGINT) AS wrong_type
    FROM events
    """,
)
def json_extract_typed(t: Tables):
    """Events wrapped into nested documents and read back by typed paths."""
    wrapped = F.to_json(
        F.struct(
            F.struct(
                F.col("event_type").alias("type"),
                F.struct(F.col("user_id").alias("id")).alias("user"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
                (F.col("event_type") == "error").alias("failed"),
            ).alias("event")
        )
    )
    props, doc = F.col("parsed_props"), F.col("doc")
    return t.events.select(
        "event_id", F.parse_json("props").alias("parsed_props"), F.parse_json(wrapped).alias("doc")
    ).select(
        "event_id",
        field(props, "$.k", "bigint").alias("k"),
        field(doc, "$.event.type", "string").alias("nested_type"),
        field(doc, "$.event.user.id", "bigint").alias("nested_user"),
        field(doc, "$.event.at", "timestamp_ntz").alias("nested_time"),
        field(doc, "$.event.failed", "boolean").alias("is_error"),
        field(doc, "$.event.owner.id", "bigint").alias("missing_step"),
        field(doc, "$.event.type", "bigint").alias("wrong_type"),
    )


@bind(
    "json_array_size",
    """
    SELECT vec_id,
      CASE WHEN label = 0 THEN NULL WHEN label = 1 THEN 0 ELSE CAST(len(embedding) AS BIGINT) END AS label_count,
      label > 1 AS has_labels, label <> 0 AS is_array_kept
    FROM embeddings
    """,
)
def json_array_size(t: Tables):
    """Arrays that are missing (label 0), empty (label 1) or filled."""
    empty = F.array().cast("array<float>")
    labels = F.when(F.col("label") == 0, None).when(F.col("label") == 1, empty).otherwise(F.col("embedding"))
    doc = F.col("doc")
    return t.embeddings.select(
        "vec_id", F.parse_json(F.to_json(F.struct(labels.alias("labels")))).alias("doc")
    ).select(
        "vec_id",
        array_length(doc, "$.labels").alias("label_count"),
        F.coalesce(array_length(doc, "$.labels") > 0, F.lit(False)).alias("has_labels"),
        subdocument(doc, "$.labels").isNotNull().alias("is_array_kept"),
    )


@bind(
    "json_presence_flag",
    """
    SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_pull_request FROM orders
    """,
)
def json_presence_flag(t: Tables):
    """A key that holds an object (priority 1, 2), an explicit null (3) or is missing."""
    urgency = F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(urgency.isin("1", "2"), '{"pull_request":{"url":"u"}}')
        .when(urgency == "3", '{"pull_request":null}')
        .otherwise("{}")
    )
    return t.orders.select("o_orderkey", F.parse_json(text).alias("doc")).select(
        "o_orderkey", is_present(F.col("doc"), "$.pull_request").alias("is_pull_request")
    )


@bind(
    "coalesce_fallback",
    """
    SELECT p.page_id,
      CASE WHEN url LIKE '%/en/%' THEN 'explicit/name'
           ELSE nullif(regexp_extract(url, 'example.([a-z]+/[^/]+)', 1), '') END AS repository
    FROM pages p
    """,
)
def coalesce_fallback(t: Tables):
    explicit = F.when(F.col("url").contains("/en/"), "explicit/name")
    doc = F.parse_json(F.to_json(F.struct(explicit.alias("source_repository"), F.col("url"))))
    return t.pages.select("page_id", doc.alias("doc")).select(
        "page_id",
        F.coalesce(
            field(F.col("doc"), "$.source_repository", "string"),
            capture(field(F.col("doc"), "$.url", "string"), "example.([a-z]+/[^/]+)"),
        ).alias("repository"),
    )


@bind(
    "latest_by_key",
    """
    SELECT event_id, ts, user_id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events) WHERE rn = 1
    """,
)
def latest_event(t: Tables):
    return latest_by_key(t.events, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc()])


@bind(
    "latest_by_composite_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn
          FROM lineitem) WHERE rn = 1
    """,
)
def latest_item(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    newest = [F.col("l_shipdate").desc_nulls_last(), F.col("l_partkey").desc(), F.col("l_suppkey").desc()]
    return latest_by_key(rows, ["l_orderkey", "l_linenumber"], newest)


@bind(
    "comment_sequence",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS comment_sequence
    FROM lineitem
    """,
)
def comment_sequence(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")]
    return sequence_within(rows, ["l_orderkey"], order, "comment_sequence").drop("l_shipdate")


@bind(
    "sequence_few_groups",
    """
    SELECT event_id, event_type,
           row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS comment_sequence
    FROM events
    """,
)
def sequence_few_groups(t: Tables):
    """Five groups share all rows, so at scale every one of them is hot."""
    rows = t.events.select("event_id", "event_type", "ts")
    return sequence_within(
        rows, ["event_type"], [F.col("ts"), F.col("event_id")], "comment_sequence"
    ).drop("ts")


@bind(
    "conversation_sequence",
    """
    SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS comment_sequence,
           length(text) AS comment_length
    FROM conversations
    """,
)
def conversation_sequence(t: Tables):
    rows = t.conversations.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("comment_length"))
    return sequence_within(rows, ["conv_id"], [F.col("turn")], "comment_sequence")


@bind(
    "top_n_per_group",
    """
    SELECT * FROM (
      SELECT o_orderkey, c_nationkey, o_orderdate,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey)
               AS recency_rank
      FROM orders JOIN customer ON c_custkey = o_custkey)
    WHERE recency_rank <= 500
    """,
)
def top_n_per_group(t: Tables):
    """The newest 500 orders of each nation."""
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", "c_nationkey", "o_orderdate"
    )
    order = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")]
    return top_n_within(rows, ["c_nationkey"], order, 500, "recency_rank")


@bind(
    "conditional_distinct_counts",
    """
    SELECT l_returnflag, l_linestatus,
      count(DISTINCT l_orderkey) AS all_orders,
      count(DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey END) AS large,
      count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS discounted,
      count(DISTINCT CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN l_orderkey END) AS recent
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def distinct_counts(t: Tables):
    return conditional_distinct_counts(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        "l_orderkey",
        {
            "all_orders": F.lit(True),
            "large": F.col("l_quantity") > 25,
            "discounted": F.col("l_discount") > 0.05,
            "recent": F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"),
        },
    )


@bind(
    "literal_union_filter",
    """
    WITH literals AS (SELECT 1 AS id UNION ALL SELECT NULL AS id)
    SELECT literals.id, count(*) AS items, sum(l_quantity) AS quantity
    FROM literals JOIN lineitem ON l_linenumber = literals.id
    WHERE literals.id = 1 GROUP BY literals.id
    """,
)
def literal_union_filter(t: Tables):
    """Literal rows, one of them NULL, filtered to ``id = 1`` and met with the line items."""
    one = t.spark.range(1).select(F.lit(1).alias("id"))
    none = t.spark.range(1).select(F.lit(None).cast("int").alias("id"))
    literals = one.union(none).where("id = 1")
    return (
        t.lineitem.join(literals, F.col("l_linenumber") == F.col("id"))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("l_quantity").alias("quantity"))
    )
