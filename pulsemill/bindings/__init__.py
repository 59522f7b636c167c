"""The models bound to the driver's tables, each with its SQL counterpart."""

from pulsemill.bindings import backfill, documents, functions, loads, models, quality, refresh

MODULES = [functions, documents, loads, models, refresh, quality, backfill]


def bound_queries() -> dict:
    return {name: query for module in MODULES for name, (query, _) in module.BOUND.items()}


def bound_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.BOUND.items() if sql}
