"""What must not grow faster than the input."""

import os
import time

import pytest
from pyspark.sql import functions as F

from pulsemill.bindings import backfill as backfill_bindings
from pulsemill.bindings import loads, models, refresh, roles
from pulsemill.plans import build, marts
from pulsemill.session import cut_lineage, passing_cuts, shared_folder
from pulsemill.sources import publish_table, tables
from pulsemill.streaming.ingest import MOST_BATCHES, files_per_batch


class Captured(Exception):
    pass


class Made:
    """Tables of a few rows."""

    def __init__(self, spark):
        self.spark = spark
        one = spark.range(8).withColumn("d", F.lit("1999-01-01").cast("timestamp_ntz"))
        self.events = spark.range(2000).selectExpr("id as event_id", "id % 7 as user_id", "'k' as event_type", "1.0D as value", "timestamp_ntz'2024-01-01' as ts")
        self.orders = one.selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "1.0D as o_totalprice", "d as o_orderdate", "'1-URGENT' as o_orderpriority")
        self.lineitem = one.selectExpr("id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "d as l_shipdate", "'N' as l_returnflag", "'O' as l_linestatus")
        self.customer = one.selectExpr("id as c_custkey", "concat('Customer#', lpad(id, 9, '0')) as c_name", "0 as c_nationkey", "1.0D as c_acctbal", "'m' as c_mktsegment")
        self.nation = spark.range(1).selectExpr("0 as n_nationkey", "0 as n_regionkey")
        self.region = spark.range(1).selectExpr("0 as r_regionkey", "'ASIA' as r_name")


def test_batches_do_not_grow_with_the_backlog():
    assert files_per_batch(100, 48) == 48
    for files in (6_000, 60_000, 360_000):
        assert files / files_per_batch(files, 48) <= MOST_BATCHES


def test_damaged_files_share_a_folder(spark, tmp_path):
    loads.spoiled_files(Made(spark), str(tmp_path / "files"))
    found = os.listdir(tmp_path / "files")
    assert len([f for f in found if f.endswith(".txt")]) == 20 and not any(f.startswith("block=") for f in found)


def test_derived_columns_are_added_behind_the_exchange(spark, tmp_path):
    rows = spark.range(10).select("id", F.md5(F.col("id").cast("string")).alias("key"), (F.col("id") % 2).alias("part"))
    stored = publish_table(rows, str(tmp_path / "t"), ["part"], derived={"key": F.md5(F.col("id").cast("string"))})
    assert sorted(stored.select("id", "key", "part").collect()) == sorted(rows.collect())


@pytest.mark.parametrize("query", ["incremental_comments", "incremental_comment_edit", "incremental_late_parent"])
def test_refreshes_read_staged_comments(spark, monkeypatch, query):
    def capture(consumed):
        for df in consumed.values():
            assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
        raise Captured

    monkeypatch.setattr(refresh, "files_of", capture)
    monkeypatch.setattr(refresh.build, "files_of", capture)
    with pytest.raises(Captured):
        getattr(refresh, query)(Made(spark))


def test_daily_refresh_reads_staged_issues(spark, monkeypatch):
    def capture(consumed):
        assert "l_shipdate" not in consumed["issues"]._jdf.queryExecution().optimizedPlan().toString()
        raise Captured

    monkeypatch.setattr(refresh.build, "files_of", capture)
    with pytest.raises(Captured):
        refresh.incremental_daily_late_changes(Made(spark))


def test_backfill_loads_read_staged_tables(spark, monkeypatch):
    def capture(issues, comments, *rest, **more):
        for df in (issues, comments):
            assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
        raise Captured

    monkeypatch.setattr(backfill_bindings.backfill, "run_backfill", capture)
    with pytest.raises(Captured):
        backfill_bindings.backfill_load(Made(spark))


class Mixed(Made):
    """Comments of twelve months; some orders are without their first comment."""

    def __init__(self, spark):
        super().__init__(spark)
        at = "timestampadd(MONTH, CAST((id * 5 + 7 * l_linenumber) % 12 AS INT), timestamp_ntz'1999-01-10')"
        lines = spark.range(8).selectExpr("id", "explode(sequence(CAST(id % 3 AS INT), 4)) AS l_linenumber")
        self.lineitem = lines.selectExpr("id as l_orderkey", "id as l_partkey", "id as l_suppkey", "l_linenumber", f"{at} as l_shipdate", "'N' as l_returnflag", "'O' as l_linestatus")


def shuffle_blocks(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")


def test_writes_leave_no_shuffle_files(spark):
    grouped = spark.range(10_000).repartition(4).groupBy((F.col("id") % 100).alias("k")).count()
    before = shuffle_blocks(spark)
    cut = cut_lineage(grouped)
    end = time.time() + 20
    while shuffle_blocks(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_blocks(spark) <= before
    # Frames can be run again, and the setting is what it was.
    assert cut.count() == grouped.count() == 100 and grouped.collect() == grouped.collect()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_passing_cuts_go(spark):
    def cuts():
        return set(os.listdir(shared_folder(spark).removeprefix("file:")))

    before = cuts()
    with passing_cuts(spark) as cut:
        assert cut(spark.range(7)).count() == 7 and len(cuts() - before) == 1
    assert cuts() == before
    with pytest.raises(KeyError), passing_cuts(spark) as cut:
        cut(spark.range(7))
        raise KeyError
    assert len(cuts() - before) == 1


@pytest.mark.parametrize("rows", [0, 1, 999_999, 5_000_000, 900_000_000])
def test_batches_hold_every_partition_once(rows):
    sizes = {None: rows // 2, "a": rows // 4, "b": 0, "c": rows // 8, "d": rows // 8}
    made = tables.batches_of(sizes)
    assert [v for b in made for v in b] == list(sizes) and all(made)
    assert len(made) <= tables.MOST_WRITES and (rows > tables.WRITE_ROWS or len(made) == 1)
    assert tables.batches_of({}) == []
    assert [len(b) for b in tables.batches_of(dict.fromkeys(range(80), 10**6))] == [20, 20, 20, 20]


def test_a_version_written_in_batches(spark, tmp_path):
    rows = spark.range(20).select("id", (-F.col("id")).alias("back"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("part"))
    batches = [[1], [None, 3], [2]]
    stored = publish_table(rows, str(tmp_path / "t"), ["part"], derived={"back": -F.col("id")}, order=["id"], batches=batches)
    assert sorted(map(tuple, stored.select("id", "back").collect())) == [(i, -i) for i in range(20)]
    assert {r[0] for r in stored.select("part").distinct().collect()} == {None, 1, 2, 3}


@pytest.mark.parametrize("least_rows, writes", [(4, 4), (tables.WRITE_ROWS, 1)])
def test_comment_edit_is_as_rebuilt(spark, monkeypatch, least_rows, writes):
    written, write = [], tables.write_rows

    def kept(rows, path, partition, version, derived=None, order=None, batches=None):
        written.append(len(batches))
        write(rows, path, partition, version, derived, order, batches)

    monkeypatch.setattr(tables, "write_rows", kept)
    monkeypatch.setattr(tables, "WRITE_ROWS", least_rows)
    t = Mixed(spark)
    got = refresh.incremental_comment_edit(t)
    want = refresh.countable(marts.comment_fact(roles.comments(t), refresh.parents_of(t, models.issue_metrics(t))))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.columns == want.columns and want.count() == 33 and written == [writes, writes]


def test_months_to_rewrite(spark):
    months = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]

    def frame(*rows):
        made = spark.createDataFrame([("o/a", number, month) for number, month in rows], "repository_full_name string, issue_number long, m string")
        return made.withColumn("comment_month", F.to_date("m")).drop("m")

    # Issue 1 leaves the first month for the fourth; the second has it and another one, the third other ones only.
    target = frame((1, months[0]), (1, months[1]), (2, months[1]), (2, months[2]), (3, months[2]))
    delta = frame((1, months[1]), (1, months[3]), (1, months[3]))
    touched = spark.createDataFrame([("o/a", 1)], "repository_full_name string, issue_number long")
    sizes, mixed = build.changed_months(delta, target, touched)
    assert {str(m): n for m, n in sizes.items()} == {months[0]: 0, months[1]: 2, months[3]: 2}
    assert [str(m) for m in mixed] == [months[1]]
