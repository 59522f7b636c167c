"""Nearest neighbours with a hierarchical k-means tree and best-bin-first traversal.

The tree is grown on a bounded sample of the unit vectors; every vector is filed in the
leaf that its nearest centres lead to. A query walks the tree with a priority queue of
branches by distance to their centres and so orders the leaves. How many it visits is
calibrated: for a bounded set of queries the exact neighbours are searched in all
vectors, in blocks, and the visits are widened until the wanted share of them is met.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

#: Most vectors that the tree is grown on and most queries that it is calibrated with.
SAMPLE_ROWS = 20_000
CALIBRATION_QUERIES = 200
BRANCHES = 8
LEAF_ROWS = 64
ROUNDS = 8
RECALL = 0.97
#: Vectors and queries that meet at once in one task.
BLOCK_ROWS = 2048
BLOCK_QUERIES = 2048


def usable(vector: Column) -> Column:
    """Neither null nor zero, nor with null, infinite or undefined components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column]).reshape(len(column), -1)


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of all pairs in double precision, each worked out alike wherever it stands."""
    dot = np.einsum("qd,nd->qn", queries, vectors)
    a, b = np.einsum("qd,qd->q", queries, queries), np.einsum("nd,nd->n", vectors, vectors)
    return dot / (np.sqrt(a)[:, None] * np.sqrt(b)[None, :])


@dataclass
class Node:
    leaf: int = -1
    centres: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)


class Tree:
    """k-means split again and again until a node holds at most ``leaf_rows`` of the sample."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 5):
        self.leaves = 0
        self.branches, self.leaf_rows = branches, leaf_rows
        self.random = np.random.default_rng(seed)
        self.root = self.grow(np.unique(sample, axis=0))

    def grow(self, points: np.ndarray) -> Node:
        node = Node()
        if len(points) > max(self.leaf_rows, self.branches):
            centres = points[self.random.choice(len(points), self.branches, replace=False)]
            for _ in range(ROUNDS):
                near = (points @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
                counts = np.bincount(near, minlength=self.branches)
                sums = np.zeros_like(centres)
                np.add.at(sums, near, points)
                centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
            near = (points @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
            used = np.unique(near)
            if len(used) > 1:
                node.centres = centres[used]
                node.children = [self.grow(points[near == k]) for k in used]
                return node
        node.leaf, self.leaves = self.leaves, self.leaves + 1
        return node

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector."""
        out = np.zeros(len(vectors), np.int64)
        stack = [(self.root, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if node.leaf >= 0:
                out[rows] = node.leaf
                continue
            near = (vectors[rows] @ node.centres.T - 0.5 * (node.centres**2).sum(1)).argmax(1)
            stack += [(child, part) for k, child in enumerate(node.children) if len(part := rows[near == k])]
        return out

    def visit(self, vector: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        number = 0
        queue = [(0.0, number, self.root)]
        while queue:
            _, _, node = heapq.heappop(queue)
            while node.leaf < 0:
                away = ((node.centres - vector) ** 2).sum(1)
                best = int(away.argmin())
                for k, child in enumerate(node.children):
                    if k != best:
                        number += 1
                        heapq.heappush(queue, (float(away[k]), number, child))
                node = node.children[best]
            yield node.leaf


def nearest(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the ``k`` best of each of few queries, by brute force over all vectors.

    ``queries`` goes to every task, so it must have a bound.
    """
    asked = queries.select("vec_id", "v").collect()
    ids = np.array([r.vec_id for r in asked])
    q = matrix([r.v for r in asked]) if asked else None

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pd.DataFrame | None = None
        for batch in batches:
            for at in range(0, batch.num_rows if q is not None else 0, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                found = top(ids, q, part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1).to_numpy(zero_copy_only=False)), k)
                best = found if best is None else kept(pd.concat([best, found]), k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    found = vectors.select("vec_id", "v").mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    return ranked(found, k)


def kept(found: pd.DataFrame, k: int) -> pd.DataFrame:
    return found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id", sort=False).head(k)


def top(ids: np.ndarray, queries: np.ndarray, vec_ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best of a block for each query, not itself; ties to the smaller id."""
    order = np.argsort(vec_ids, kind="stable")
    vec_ids, vectors = vec_ids[order], vectors[order]
    scores = cosines(queries, vectors)
    scores[ids[:, None] == vec_ids[None, :]] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    found = pd.DataFrame({"query_id": np.repeat(ids, best.shape[1]), "vec_id": vec_ids[best].ravel(), "score": np.take_along_axis(scores, best, 1).ravel()})
    return found[found.score > -np.inf]


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
    sample_rows: int = SAMPLE_ROWS,
    calibration_queries: int = CALIBRATION_QUERIES,
    seed: int = 5,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by cosine for each query row.

    Rows with ``is_query`` are searched for among all others. Vectors that are null,
    empty, zero or hold null or non-finite components take no part, nor do rows without
    an id. Rows with a query's own id are not its neighbours. Of ties the smaller ids
    win. If there are at most ``k`` others, all are returned. Vectors of another length
    than most usable ones have (ties: the shorter) take no part. Extra columns are ignored.

    Every vector is filed; the tree is grown on ``sample_rows`` of them at most and the
    number of leaves to visit, until ``recall`` of the true neighbours is met, on
    ``calibration_queries``. A leaf with many vectors, as copies of one make it, is
    dealt to several tasks in blocks.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"), F.rand(seed).alias("u")
    )
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").first()
    if lengths is not None:
        rows = rows.where(F.size("v") == lengths.length)
    sample = rows.select("vec_id", "v", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(sample_rows).collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    tree = Tree(unit(matrix([r.v for r in sample])), seed=seed)
    del sample

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.file(unit(matrix(batch.column(1).to_numpy(zero_copy_only=False))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "v", "asks", "u", "leaf"])

    filed = cut_lineage(rows.mapInArrow(file, "vec_id bigint, v array<double>, asks boolean, u double, leaf bigint"))
    sizes = {r.leaf: r.n for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row for each leaf of the tree
    size = np.array([sizes.get(i, 0) for i in range(tree.leaves)])
    blocks = np.maximum(1, -(-size // BLOCK_ROWS))

    asking = filed.where("asks")
    trial = asking.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(calibration_queries)
    visits = calibrated(trial, filed, tree, size, k, recall)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, leaves = [], []
            for i, v in enumerate(unit(matrix(batch.column(1).to_numpy(zero_copy_only=False)))):
                seen = 0
                for number, leaf in enumerate(tree.visit(v)):
                    if number >= visits and seen > k:
                        break
                    seen += size[leaf]
                    if size[leaf]:
                        places.append(i)
                        leaves.append(leaf)
            times = blocks[leaves]
            places = np.repeat(places, times)
            block = np.arange(len(places)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), batch.column(1).take(pa.array(places)), pa.array(np.repeat(leaves, times)), pa.array(block)],
                names=["query_id", "q", "leaf", "block"],
            )

    walked = asking.select("vec_id", "v").mapInArrow(walk, "query_id bigint, q array<double>, leaf bigint, block bigint")
    in_blocks = filed.select("vec_id", "v", "leaf", F.floor(F.col("u") * F.element_at(F.lit(blocks.tolist()), (F.col("leaf") + 1).cast("int"))).cast("long").alias("block"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, own = right["vec_id"].to_numpy(), matrix(right["v"])
        found = [
            top(left["query_id"].to_numpy()[i : i + BLOCK_QUERIES], matrix(left["q"][i : i + BLOCK_QUERIES]), ids, own, k)
            for i in range(0, len(left), BLOCK_QUERIES)
        ]
        return pd.concat(found)

    met = (
        walked.groupBy("leaf", "block")
        .cogroup(in_blocks.groupBy("leaf", "block"))
        .applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    )
    return ranked(met, k).select("query_id", "rank", "vec_id", "score")


def calibrated(trial: DataFrame, filed: DataFrame, tree: Tree, size: np.ndarray, k: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the exact neighbours of the trial queries are met."""
    true = nearest(trial, filed, k).join(filed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    asked = {r.vec_id: r.v for r in trial.select("vec_id", "v").collect()}
    order = {}
    for i, v in asked.items():
        order[i] = {leaf: number for number, leaf in enumerate(tree.visit(unit(matrix([v]))[0]))}
    ranks = sorted(order[r.query_id][r.leaf] for r in true)
    if not ranks:
        return tree.leaves
    return ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] + 1
