"""Ordered labels, flags and guarded ratios."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(rules: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """First matching rule wins; a NULL condition does not match."""
    first, *rest = rules
    chain = reduce(lambda acc, rule: acc.when(*rule), rest, F.when(*first))
    return chain.otherwise(otherwise)


def ladder(value: Column, steps: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose limit lies above ``value``."""
    return labelled([(value < F.lit(limit), label) for limit, label in steps], otherwise)


def flag(condition: Column) -> Column:
    """Two-valued: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def guarded_ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded, 0 where ``whole`` is not positive or not known."""
    ratio = part.cast("double") / whole.cast("double")
    return F.when(whole > 0, F.round(ratio, digits)).otherwise(F.lit(0.0))
