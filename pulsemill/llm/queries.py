"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pulsemill.llm import native_queries, python_queries

QUERIES = {**native_queries.QUERIES, **python_queries.QUERIES}
SQL = {**native_queries.SQL, **python_queries.SQL}
