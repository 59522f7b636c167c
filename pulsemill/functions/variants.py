"""Typed access to semi-structured documents held as VARIANT.

A missing step, a JSON null or a value of the wrong type gives NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed_document(document: Column, fields: list[tuple[str, str]]) -> Column:
    """All of ``fields``, given as (path of one or two steps, type), in one walk over the document.

    The result is a struct shaped like the document. Asking for each path on its own
    searches the document once per path.
    """
    top: dict[str, str] = {}
    nested: dict[str, list[str]] = {}
    for path, kind in fields:
        step, _, rest = path.partition(".")
        if rest:
            nested.setdefault(step, []).append(f"`{rest}`: {kind}")
        else:
            top[step] = kind
    members = [f"`{name}`: {kind}" for name, kind in top.items()]
    members += [f"`{name}`: struct<{', '.join(inner)}>" for name, inner in nested.items()]
    return F.try_variant_get(document, "$", f"struct<{', '.join(members)}>")


def member(struct: str, path: str) -> Column:
    """A field of a ``typed_document`` by its path."""
    return F.col(".".join([struct, *[f"`{step}`" for step in path.split(".")]]))


def field(document: Column, path: str, type_name: str) -> Column:
    return F.try_variant_get(document, path, type_name)


def subdocument(document: Column, path: str) -> Column:
    """Part of the document, still semi-structured; an explicit null becomes NULL."""
    part = F.try_variant_get(document, path, "variant")
    return F.when(~F.is_variant_null(part), part)


def array_length(document: Column, path: str) -> Column:
    """Number of elements; NULL unless the path holds an array."""
    return F.array_size(F.try_variant_get(document, path, "array<variant>")).cast("bigint")


def is_present(document: Column, path: str) -> Column:
    """True only for a key that is there and not an explicit null."""
    part = F.try_variant_get(document, path, "variant")
    return part.isNotNull() & ~F.coalesce(F.is_variant_null(part), F.lit(False))
