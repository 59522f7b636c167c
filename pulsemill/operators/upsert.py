"""Keyed upsert: matched rows are replaced, new ones added."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without_matches(target: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    # A join by name puts the keys first; the target keeps its own column order.
    return target.join(other.select(*keys), keys, "left_anti").select(*target.columns)


def upsert(target: DataFrame, delta: DataFrame, keys: list[str], evolve: bool = False) -> DataFrame:
    """The table after merging ``delta``, whose keys must be unique.

    With ``evolve`` columns that only the delta has are appended (NULL in old rows);
    without it they are left out, as the target decides the schema.
    """
    kept = without_matches(target, delta, keys)
    if evolve:
        return kept.unionByName(delta, allowMissingColumns=True)
    return kept.unionByName(delta.select(*target.columns))


def replace_where_matched(
    target: DataFrame, delta: DataFrame, scope: DataFrame, keys: list[str]
) -> DataFrame:
    """The table after replacing every row whose ``keys`` are in ``scope`` by ``delta``.

    Unlike ``upsert`` this also removes rows that the recomputation no longer gives.
    """
    kept = without_matches(target, scope, keys)
    return kept.unionByName(delta.select(*target.columns))
