import random

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import conditional_distinct_counts, sequence_within, top_n_within
from pulsemill.operators.ranking import hot_groups


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, many of them at one instant; one group has no name."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 else (None if i % 9 == 0 else f"k{i % 50}")
        rows.append((key, rng.choice([5, 5, 5, rng.randrange(100)]), i))
    rng.shuffle(rows)
    return rows


def brute_force(rows):
    groups = {}
    for key, at, i in rows:
        groups.setdefault(key, []).append((at, i))
    return {(k, i): n for k, members in groups.items() for n, (_, i) in enumerate(sorted(members), 1)}


@pytest.mark.parametrize("hot_rows", [None, 400, 10_000])
def test_sequence_equals_brute_force(spark, skewed, hot_rows):
    df = spark.createDataFrame(skewed, "k string, at long, id long").repartition(7)
    numbered = sequence_within(df, ["k"], [F.col("at"), F.col("id")], "n", hot_rows)
    got = {(r["k"], r["id"]): r["n"] for r in numbered.collect()}
    assert got == brute_force(skewed)
    assert numbered.columns == ["k", "at", "id", "n"]


def test_hot_groups_are_few_and_exact(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, at long, id long")
    hot = {r["k"]: r["_rows"] for r in hot_groups(df, ["k"], 500).collect()}
    assert hot == {"hot": 4000, None: 667}


@pytest.mark.parametrize("n", [10, 1500])
def test_top_n(spark, skewed, n):
    df = spark.createDataFrame(skewed, "k string, at long, id long")
    top = top_n_within(df, ["k"], [F.col("at"), F.col("id")], n, "n", hot_rows=400)
    got = {(r["k"], r["id"]): r["n"] for r in top.collect()}
    assert got == {key: place for key, place in brute_force(skewed).items() if place <= n}


def test_conditional_distinct_counts(spark):
    rows = [("a", 1, 5), ("a", 1, 50), ("a", 2, 5), ("a", None, 50), ("b", 3, 5)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    got = conditional_distinct_counts(df, ["g"], "id", {"ids": F.lit(True), "big": F.col("v") > 10})
    assert {r["g"]: (r["ids"], r["big"]) for r in got.collect()} == {"a": (2, 1), "b": (1, 0)}
