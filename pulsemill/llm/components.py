"""Connected components of a table of links, by smallest labels in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(key, label): the smallest ``label`` of each node's component.

    ``nodes``: (key, label), one row for each key; ``links``: (a, b). Nodes without a link
    are not returned.
    Labels spread to neighbours and each node then jumps to the label of its label's
    node, so the number of rounds grows with the logarithm of the longest path. Each
    round is written; the driver sees one count for it.
    """
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    linked = nodes.join(both.select(F.col("a").alias("key")).distinct(), "key", "left_semi")
    state = cut_lineage(linked.select("key", F.struct(F.col("label").alias("label"), F.col("key").alias("at")).alias("best")))
    while True:
        near = both.join(state.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("best").alias("near"))
        spread = state.join(near, "key", "left").select("key", F.col("best").alias("was"), F.least("best", "near").alias("best"))
        spread = cut_lineage(spread)
        targets = spread.select(F.col("key").alias("at"), F.col("best").alias("further"))
        jumped = spread.select("key", "was", "best", F.col("best.at").alias("at")).join(targets, "at", "left")
        moved = cut_lineage(jumped.select("key", "was", F.least("best", "further").alias("best")))
        state = moved.select("key", "best")
        if moved.where("best <> was").limit(1).count() == 0:
            return state.select("key", F.col("best.label").alias("label"))
