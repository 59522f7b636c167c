"""String helpers: captures, fallbacks and hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a hashed key holds in place of NULL, and between its parts.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def capture(value: Column, pattern: str, group: int = 1) -> Column:
    """Text of a capture group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def coalesce_null(value: Column, fallback: str) -> Column:
    return F.coalesce(value.cast("string"), F.lit(fallback))


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts as text, NULL-safe."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[coalesce_null(p, KEY_NULL) for p in parts]))


def full_name_from_file_safe(name: Column) -> Column:
    """``owner_repo`` back to ``owner/repo``.

    Owners cannot hold an underscore, repositories can: only the first one is
    the separator.
    """
    return F.regexp_replace(name, "^([^_]*)_", "$1/")
