"""Files written and read back: landing, config, streams, upserts and audits.

The files are derived from the tables by Spark and go to the shared scratch folder.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.bindings.roles import EVENTS_AS_OF, Tables, binder
from pulsemill.functions import capture, field
from pulsemill.operators import latest_by_key, upsert
from pulsemill.plans import audit
from pulsemill.session import scratch_folder
from pulsemill.sources import (
    enabled_repositories,
    enrich,
    merge_partitions,
    publish_table,
    read_landing,
    read_raw_arrays,
    read_table,
    rejected_files,
    row_documents,
    write_landing,
)
from pulsemill.sources.landing import EXTRACT
from pulsemill.sources.tables import write_rows
from pulsemill.streaming import append_raw, latest_state, read_raw, read_rejects
from pulsemill.streaming.ingest import BUCKET, files_per_batch

BOUND: dict = {}
bind = binder(BOUND)

# Documents per array file: what a source delivers in ten pages of a hundred.
FILE_SIZE = 1000


def event_documents(events: DataFrame) -> DataFrame:
    """Events with a JSON text each."""
    document = F.struct(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"),
        "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("updated_at"),
    )
    return events.withColumn("document", F.to_json(document))


def block_of(file_size: int) -> Column:
    return F.floor(F.col("event_id") / file_size).cast("bigint")


def files_of_batch(t: Tables, file_size: int) -> int:
    """Files for a micro-batch: some for every core, and a bounded number of batches."""
    files = t.events.select(block_of(file_size)).distinct().count()
    return files_per_batch(files, 4 * t.spark.sparkContext.defaultParallelism)


def array_files(t: Tables, root: str) -> str:
    """Events as files that hold one JSON array of at most ``FILE_SIZE`` documents each."""
    block = block_of(FILE_SIZE)
    (
        event_documents(t.events)
        .groupBy(block.alias("block"))
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("document"), ",\n"), F.lit("\n]")).alias("value"))
        .write.partitionBy("block")
        .text(root)
    )
    return root


def typed_events(raw: DataFrame) -> DataFrame:
    doc = F.col("raw_data")
    return raw.select(
        field(doc, "$.id", "bigint").alias("event_id"),
        field(doc, "$.user", "bigint").alias("user_id"),
        field(doc, "$.kind", "string").alias("event_type"),
        field(doc, "$.value", "double").alias("value"),
        field(doc, "$.updated_at", "timestamp_ntz").alias("ts"),
        "source_file",
    )


@bind(
    "raw_array_scan",
    f"SELECT event_id, user_id, event_type, value, ts, event_id // {FILE_SIZE} AS block FROM events",
)
def raw_array_scan(t: Tables):
    raw = read_raw_arrays(t.spark, array_files(t, scratch_folder(t.spark, "arrays")))
    block = capture(F.col("source_file"), "block=([0-9]+)").cast("bigint")
    return typed_events(raw).withColumn("block", block).drop("source_file")


# What becomes of a block of events by its number, and the reason of its reject.
SPOILS = {1: "truncated", 2: "trailing", 3: "trailing", 4: "not_an_array", 5: "unparsable", 6: "unparsable", 7: None}
SPOIL_EVERY = 9
SPOILED_FILE_SIZE = 100


def spoiled_files(t: Tables, root: str) -> str:
    """Array files as above with fewer documents each, most of them damaged in some way."""
    block = block_of(SPOILED_FILE_SIZE)
    whole = F.concat(F.lit("[\n"), F.array_join(F.array_sort(F.collect_list("document")), ",\n"), F.lit("\n]"))
    kind, text = F.pmod("block", F.lit(SPOIL_EVERY)), F.col("value")
    damaged = (
        F.when(kind == 1, text.substr(F.lit(1), F.length(text) - 3))
        .when(kind == 2, F.concat(text, F.lit(" and more")))
        .when(kind == 3, F.concat(text, F.lit(",[]")))
        .when(kind == 4, F.concat(F.lit('{"rows": '), text, F.lit("}")))
        .when(kind == 5, F.concat(F.lit("no json "), text))
        .when(kind == 6, F.concat(F.lit("[{],"), text, F.lit("]")))
        .when(kind == 7, F.lit(" \n"))
        .otherwise(text)
    )
    # One file for each row, all in one folder: a folder for each would have to be listed on its own.
    (
        event_documents(t.events)
        .groupBy(block.alias("block"))
        .agg(whole.alias("value"))
        .select(damaged.alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(root)
    )
    return root


def block_of_event(event_id: Column) -> Column:
    return F.floor(event_id / SPOILED_FILE_SIZE).cast("bigint")


@bind(
    "raw_rejects",
    f"""
    WITH blocks AS (SELECT event_id // 100 AS block, count(*) AS documents FROM events GROUP BY 1),
    spoils(kind, reason) AS (VALUES {", ".join(f"({kind}, {'NULL' if reason is None else repr(reason)})" for kind, reason in SPOILS.items())})
    SELECT block, reason AS batch_reason, reason AS stream_reason, CASE WHEN kind IS NULL THEN documents ELSE 0 END AS batch_documents,
           CASE WHEN kind IS NULL THEN documents ELSE 0 END AS stream_documents
    FROM blocks LEFT JOIN spoils ON block % {SPOIL_EVERY} = kind
    WHERE kind IS NULL OR reason IS NOT NULL
    """,
)
def raw_rejects(t: Tables):
    """What is read from damaged files and why the others are not, at once and in micro-batches."""
    files, table = spoiled_files(t, scratch_folder(t.spark, "arrays")), scratch_folder(t.spark, "raw")
    batch_size = files_of_batch(t, SPOILED_FILE_SIZE)
    append_raw(t.spark, files, table, scratch_folder(t.spark, "progress"), files_per_batch=batch_size).awaitTermination()

    def accounted(documents: DataFrame, rejects: DataFrame, how: str) -> DataFrame:
        event, first_event = field(F.col("raw_data"), "$.id", "bigint"), capture(F.col("excerpt"), '"id":([0-9]+)').cast("bigint")
        read = documents.select(block_of_event(event).alias("block"), F.lit(1).alias("n"), F.lit(None).cast("string").alias("reason"))
        lost = rejects.select(block_of_event(first_event).alias("block"), F.lit(0).alias("n"), "reason")
        return read.unionByName(lost).groupBy("block").agg(F.sum("n").alias(f"{how}_documents"), F.max("reason").alias(f"{how}_reason"))

    at_once = accounted(read_raw_arrays(t.spark, files), rejected_files(t.spark, files), "batch")
    streamed = accounted(read_raw(t.spark, table), read_rejects(t.spark, table), "stream")
    return at_once.join(streamed, "block", "full")


def landed_events(events: DataFrame, root: str) -> None:
    name = F.concat(F.lit("org/kind_"), F.col("event_type"))
    rows = enrich(
        events.select("event_id", "event_type", "value", "ts"), "issues", name, F.to_date("ts"), EVENTS_AS_OF
    )
    write_landing(row_documents(rows), root, "issues")


def read_landed(t: Tables, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    doc = F.col("raw_data")
    return read_landing(t.spark, root, "issues", first, last).select(
        field(doc, "$.event_id", "bigint").alias("event_id"),
        field(doc, "$.value", "double").alias("value"),
        field(doc, "$.source_repository", "string").alias("source_repository"),
        "path_repository",
        "path_date",
    )


@bind(
    "path_date_scan",
    """
    SELECT event_id, value, 'org/kind_' || event_type AS source_repository,
           'org/kind_' || event_type AS path_repository, CAST(ts AS DATE) AS path_date
    FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-21'
    """,
)
def path_date_scan(t: Tables):
    """Eleven days of the landing area; the other folders are not read."""
    root = scratch_folder(t.spark, "landing")
    landed_events(t.events, root)
    return read_landed(t, root, date(2024, 1, 10), date(2024, 1, 20))


@bind(
    "idempotent_partition_write",
    """
    SELECT event_id, value, 'org/kind_' || event_type AS source_repository,
           'org/kind_' || event_type AS path_repository, CAST(ts AS DATE) AS path_date
    FROM events e
    WHERE ts < DATE '2024-01-15' OR value > 50
       OR NOT EXISTS (SELECT 1 FROM events w WHERE w.event_type = e.event_type
                      AND CAST(w.ts AS DATE) = CAST(e.ts AS DATE) AND w.value > 50)
    """,
)
def idempotent_partition_write(t: Tables):
    """Everything, then again the second half of the month with fewer rows, then nothing."""
    root = scratch_folder(t.spark, "landing")
    landed_events(t.events, root)
    landed_events(t.events.where("ts >= timestamp_ntz'2024-01-15' and value > 50"), root)
    landed_events(t.events.where("ts > timestamp_ntz'2100-01-01'"), root)
    return read_landed(t, root)


@bind(
    "landing_two_origins",
    """
    SELECT origin, event_id, event_type || rest AS source_repository, event_type || rest AS path_repository,
           CAST(ts AS DATE) AS path_date
    FROM events, (VALUES ('extract'), ('run-1')) origins(origin), (VALUES ('_b/c'), ('/b_c'), ('/b c%2F+ü')) names(rest)
    WHERE origin = 'run-1' OR ts >= DATE '2024-01-20'
    """,
)
def landing_two_origins(t: Tables):
    """A backfill and an extract that lands some of the same days again, for repositories
    whose names differ only in where the slash is; then the extract once more."""
    root = scratch_folder(t.spark, "landing")
    rests = F.explode(F.array(F.lit("_b/c"), F.lit("/b_c"), F.lit("/b c%2F+ü")))
    events = t.events.select("event_id", "ts", "event_type", rests.alias("rest"))
    name = F.concat("event_type", "rest")
    late = events.where("ts >= timestamp_ntz'2024-01-20'")
    for rows, origin in ((events, "run-1"), (late, EXTRACT), (late, EXTRACT)):
        enriched = enrich(rows.select("event_id", "event_type", "rest", "ts"), "events", name, F.to_date("ts"), EVENTS_AS_OF)
        write_landing(row_documents(enriched), root, "events", origin)
    doc = F.col("raw_data")
    return read_landing(t.spark, root, "events").select(
        F.col("path_origin").alias("origin"),
        field(doc, "$.event_id", "bigint").alias("event_id"),
        field(doc, "$.source_repository", "string").alias("source_repository"),
        "path_repository",
        "path_date",
    )


@bind(
    "enrich_metadata",
    """
    SELECT o_orderkey, '2002-01-01T00:00:00Z' AS extracted_at, strftime(o_orderdate, '%Y-%m-%d') AS extraction_date,
      'issues/' || strftime(o_orderdate, '%Y/%m/%d/') || 'org_proj_' || CAST(o_custkey AS VARCHAR) || '_issues_' ||
        strftime(o_orderdate, '%Y-%m-%d') || '.json' AS source_file,
      'org/proj_' || CAST(o_custkey AS VARCHAR) AS source_repository
    FROM orders
    """,
)
def enrich_metadata(t: Tables):
    name = F.concat(F.lit("org/proj_"), F.col("o_custkey").cast("string"))
    rows = enrich(t.orders, "issues", name, F.to_date("o_orderdate"), "2002-01-01 00:00:00")
    return rows.select("o_orderkey", "extracted_at", "extraction_date", "source_file", "source_repository")


@bind(
    "enabled_repos",
    """
    SELECT 'owner-' || CAST(c_nationkey AS VARCHAR) AS owner, c_name AS repo,
           'owner-' || CAST(c_nationkey AS VARCHAR) || '/' || c_name AS full_name, c_mktsegment AS description
    FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal >= 0
    """,
)
def enabled_repos(t: Tables):
    """Config files of at most ``FILE_SIZE`` repositories; without an entry one is enabled."""
    root = scratch_folder(t.spark, "config")
    enabled = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") >= 0)
    entry = F.struct(
        F.concat(F.lit("owner-"), F.col("c_nationkey").cast("string")).alias("owner"),
        F.col("c_name").alias("repo"),
        F.col("c_mktsegment").alias("description"),
        enabled.alias("enabled"),
    )
    (
        t.customer.groupBy(F.floor(F.col("c_custkey") / FILE_SIZE).alias("block"))
        .agg(F.collect_list(entry).alias("repositories"))
        .write.partitionBy("block")
        .json(root)
    )
    return enabled_repositories(t.spark, root)


@bind(
    "stream_raw_ingest",
    """
    SELECT event_id, user_id, event_type, value, ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def stream_raw_ingest(t: Tables):
    """Array files streamed in batches into the latest event per user."""
    files = array_files(t, scratch_folder(t.spark, "arrays"))
    table = scratch_folder(t.spark, "state")
    query = latest_state(
        t.spark,
        files,
        table,
        scratch_folder(t.spark, "progress"),
        typed_events,
        ["user_id"],
        lambda: [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()],
        files_per_batch=files_of_batch(t, FILE_SIZE),
    )
    query.awaitTermination()
    return read_table(t.spark, table).drop("source_file", BUCKET)


@bind(
    "stream_raw_append",
    """
    SELECT event_type, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts, CAST(sum(event_id) AS BIGINT) AS id_sum
    FROM events GROUP BY event_type
    """,
)
def stream_raw_append(t: Tables):
    """Array files streamed into an append-only RAW table, then typed and summed."""
    files = array_files(t, scratch_folder(t.spark, "arrays"))
    table = scratch_folder(t.spark, "raw")
    append_raw(t.spark, files, table, scratch_folder(t.spark, "progress")).awaitTermination()
    return (
        typed_events(read_raw(t.spark, table))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.sum("event_id").alias("id_sum"),
        )
    )


CUT = "timestamp_ntz'2000-01-01'"
OVERLAP = "timestamp_ntz'1999-07-01'"


@bind(
    "incremental_upsert",
    """
    SELECT o_orderkey, o_custkey, o_orderdate,
           CASE WHEN o_orderdate >= DATE '1999-07-01' THEN 'again' ELSE 'first' END AS load
    FROM orders
    """,
)
def incremental_upsert(t: Tables):
    """Orders before 2000, then those from mid-1999 on: the overlap is replaced."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    target = rows.where(f"o_orderdate < {CUT}").withColumn("load", F.lit("first"))
    delta = rows.where(f"o_orderdate >= {OVERLAP}").withColumn("load", F.lit("again"))
    return upsert(target, delta, ["o_orderkey"])


@bind(
    "upsert_new_columns",
    """
    SELECT o_orderkey, o_orderdate,
           CASE WHEN o_orderdate >= DATE '1999-07-01' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def upsert_new_columns(t: Tables):
    """The delta brings a column the target does not have."""
    target = t.orders.where(f"o_orderdate < {CUT}").select("o_orderkey", "o_orderdate")
    delta = t.orders.where(f"o_orderdate >= {OVERLAP}").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return upsert(target, delta, ["o_orderkey"], evolve=True)


@bind(
    "partition_merge",
    """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month,
           CASE WHEN o_orderdate >= DATE '1999-07-01' THEN 'again' ELSE 'first' END AS load
    FROM orders
    """,
)
def partition_merge(t: Tables):
    """The same upsert on a stored table: only the touched months are rewritten."""
    path = scratch_folder(t.spark, "orders")
    rows = t.orders.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    kept = ["o_orderkey", "o_totalprice", "order_month"]
    first = rows.where(f"o_orderdate < {CUT}").select(*kept).withColumn("load", F.lit("first"))
    publish_table(first, path, ["order_month"])
    delta = rows.where(f"o_orderdate >= {OVERLAP}").select(*kept).withColumn("load", F.lit("again"))
    merge_partitions(t.spark, path, delta, ["o_orderkey"], "order_month")
    return read_table(t.spark, path)


@bind(
    "partition_merge_new_columns",
    """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month,
           CASE WHEN o_orderdate >= DATE '1999-07-01' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderdate >= DATE '1999-07-01' THEN o_orderstatus = 'F' END AS is_finished
    FROM orders
    """,
)
def partition_merge_new_columns(t: Tables):
    """Months that are merged later bring two columns; the stored table takes them on, and the
    months that are not touched have NULL there. A build that is lost before it is committed changes nothing."""
    path = scratch_folder(t.spark, "orders")
    rows = t.orders.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    kept = ["o_orderkey", "o_totalprice", "order_month"]
    publish_table(rows.where(f"o_orderdate < {CUT}").select(*kept), path, ["order_month"])
    delta = rows.where(f"o_orderdate >= {OVERLAP}").select(*kept, "o_orderpriority", (F.col("o_orderstatus") == "F").alias("is_finished"))
    merge_partitions(t.spark, path, delta, ["o_orderkey"], "order_month")
    write_rows(rows.where("o_orderkey % 2 = 0").select(*kept), path, "order_month", 2)
    return read_table(t.spark, path)


@bind(
    "lookback_overlap",
    """
    SELECT event_id, user_id, ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def lookback_overlap(t: Tables):
    """Two overlapping extracts; keeping the latest load absorbs the rows read twice."""
    rows = t.events.select("event_id", "user_id", "ts")
    week_one = rows.where("ts < timestamp_ntz'2024-01-20'").withColumn("loaded_at", F.lit(1))
    again = rows.where("ts >= timestamp_ntz'2024-01-13'").withColumn("loaded_at", F.lit(2))
    loads = latest_by_key(week_one.unionByName(again), ["event_id"], [F.col("loaded_at").desc()])
    return latest_by_key(
        loads.drop("loaded_at"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    )


@bind(
    "load_audit",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS entity, count(*) AS total_records, count(DISTINCT CAST({column} AS DATE)) AS distinct_days,
               min({column}) AS earliest, max({column}) AS latest FROM {table}"""
        for name, table, column in [
            ("ISSUES", "orders", "o_orderdate"),
            ("COMMENTS", "lineitem", "l_shipdate"),
            ("EVENTS", "events", "ts"),
        ]
    ),
)
def load_audit(t: Tables):
    return audit.load_audit(
        {
            "ISSUES": t.orders.select(F.col("o_orderdate").alias("loaded_at")),
            "COMMENTS": t.lineitem.select(F.col("l_shipdate").alias("loaded_at")),
            "EVENTS": t.events.select(F.col("ts").alias("loaded_at")),
        }
    )


@bind(
    "load_gap_check",
    """
    SELECT d AS missing_date
    FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
          FROM lineitem)
    WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
    ORDER BY d
    """,
)
def load_gap_check(t: Tables):
    """Days of the shipping calendar without an order."""
    bounds = t.lineitem.agg(
        F.to_date(F.min("l_shipdate")).alias("start_date"),
        F.date_add(F.to_date(F.max("l_shipdate")), 1).alias("end_date"),
    )
    loads = t.orders.select(F.col("o_orderdate").alias("loaded_at"))
    return audit.load_gaps(loads, bounds)
