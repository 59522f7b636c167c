"""Landed JSON files as RAW rows: one semi-structured document per row.

RAW columns: ``raw_data`` variant, ``loaded_at`` timestamp, ``source_file`` string and
``tie_breaker`` bigint, which orders documents of one file and load time.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.text import capture

RAW_COLUMNS = ["raw_data", "loaded_at", "source_file", "tie_breaker"]

# Types are given, or a repository named by digits alone would be read as a number.
LANDED = "value string, entity string, origin string, load_date date, repo_key string"

# Fixed value: {entity}/YYYY/MM/DD/{owner}_{repo}_{suffix}_{YYYY-MM-DD}.json
DATED_PATH = r"([^/]+)/\d{4}/\d{2}/\d{2}/(.+)_[a-z]+_(\d{4}-\d{2}-\d{2})\.json$"


def with_file_lineage(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_modification_time").alias("loaded_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )


# Why a file or a line gives no documents.
TRAILING, TRUNCATED, NOT_AN_ARRAY, UNPARSABLE = "trailing", "truncated", "not_an_array", "unparsable"

BLANKS = " \t\r\n"


def whole_array(value: Column) -> Column:
    """The elements of a text that is one JSON array and nothing else, else NULL.

    The parser stops at the end of the first array and ignores what follows. Here the text
    is followed by an empty array, both inside another one: only if nothing stands behind the
    text's own array are there two elements.
    """
    framed = F.from_json(F.concat(F.lit("["), value, F.lit(",[]]")), "array<array<variant>>")
    return F.when(F.size(framed) == 2, F.get(framed, F.lit(0)))


def is_blank(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS)) == ""


def documents_from_text(files: DataFrame) -> DataFrame:
    """RAW rows from whole files that each hold one JSON array.

    Every element becomes a variant of its own, so only a document, never a whole
    file, has to stay below the size limit of a variant. A file that is not one array gives
    no rows but a reject; see ``array_rejects``.
    """
    parsed = files.select("loaded_at", "source_file", whole_array(F.col("value")).alias("docs"))
    return parsed.select(
        "loaded_at", "source_file", F.posexplode("docs").alias("tie_breaker", "raw_data")
    ).select(
        "raw_data", "loaded_at", "source_file", F.col("tie_breaker").cast("bigint").alias("tie_breaker")
    )


REJECT_COLUMNS = ["source_file", "loaded_at", "reason", "n_chars", "excerpt"]
EXCERPT_CHARS = 200


def as_rejects(texts: DataFrame, reason: Column) -> DataFrame:
    """Rejects with the beginning of their text. ``texts``: (value, loaded_at, source_file)."""
    return texts.select(
        "source_file",
        "loaded_at",
        reason.alias("reason"),
        F.length("value").cast("bigint").alias("n_chars"),
        F.substring("value", 1, EXCERPT_CHARS).alias("excerpt"),
    )


def array_rejects(files: DataFrame) -> DataFrame:
    """One row for each file that holds text but not one JSON array, and why.

    trailing: something follows the array; truncated: an array that does not end; not_an_array:
    another JSON value; unparsable: anything else. Together with ``documents_from_text``
    every file with text is accounted for once.
    """
    value = F.col("value")
    first, last = F.btrim(value, F.lit(BLANKS)).substr(1, 1), F.substring(F.btrim(value, F.lit(BLANKS)), -1, 1)
    opens = first == "["
    reason = (
        F.when(opens & F.from_json(value, "array<variant>").isNotNull(), TRAILING)
        .when(opens & (last != "]"), TRUNCATED)
        .when(~opens & F.try_parse_json(value).isNotNull(), NOT_AN_ARRAY)
        .otherwise(UNPARSABLE)
    )
    return as_rejects(files.where(whole_array(value).isNull() & ~is_blank(value)), reason)


def line_rejects(lines: DataFrame) -> DataFrame:
    """One row for each line that holds text but no JSON value, as ``read_raw_lines`` reads them."""
    value = F.col("value")
    return as_rejects(lines.where(F.try_parse_json(value).isNull() & ~is_blank(value)), F.lit(UNPARSABLE))


def whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return with_file_lineage(spark.read.text(path, wholetext=True, recursiveFileLookup=True))


def read_raw_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All JSON-array files below ``path``."""
    return documents_from_text(whole_files(spark, path))


def rejected_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files below ``path`` that ``read_raw_arrays`` takes nothing from, and why."""
    return array_rejects(whole_files(spark, path))


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Line-delimited documents, the layout ``write_landing`` gives.

    Files of any size are split over tasks. Malformed lines keep a NULL ``raw_data``.
    """
    return with_file_lineage(spark.read.text(path, recursiveFileLookup=True)).select(
        F.try_parse_json("value").alias("raw_data"),
        "loaded_at",
        "source_file",
        F.xxhash64("value").alias("tie_breaker"),
    )


def read_landing(
    spark: SparkSession,
    root: str,
    entity: str,
    first: date | None = None,
    last: date | None = None,
    origin: str | None = None,
) -> DataFrame:
    """RAW rows of one entity from what ``write_landing`` wrote, with the path's origin, date and repository.

    Entity, origin and dates are partition filters: other folders are not read.
    """
    landed = spark.read.schema(LANDED).text(root).where(F.col("entity") == entity)
    if origin is not None:
        landed = landed.where(F.col("origin") == origin)
    if first is not None:
        landed = landed.where(F.col("load_date") >= F.lit(first))
    if last is not None:
        landed = landed.where(F.col("load_date") <= F.lit(last))
    return landed.select(
        F.try_parse_json("value").alias("raw_data"),
        F.col("_metadata.file_modification_time").alias("loaded_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.xxhash64("value").alias("tie_breaker"),
        F.col("origin").alias("path_origin"),
        F.url_decode("repo_key").alias("path_repository"),
        F.col("load_date").alias("path_date"),
    )


def dated_glob(root: str, entity: str, first: date, last: date) -> str:
    """One glob for ``entity/YYYY/MM/DD`` from ``first`` to ``last``, both included.

    Whole months become one pattern, so the list grows with months, not days.
    """
    patterns, day = [], first
    while day <= last:
        next_month = (day.replace(day=1) + timedelta(days=32)).replace(day=1)
        if day.day == 1 and next_month - timedelta(days=1) <= last:
            patterns.append(f"{day:%Y/%m}/*")
            day = next_month
        else:
            patterns.append(f"{day:%Y/%m/%d}")
            day += timedelta(days=1)
    return f"{root}/{entity}/{{{','.join(patterns)}}}"


def read_raw_dates(spark: SparkSession, root: str, entity: str, first: date, last: date) -> DataFrame:
    """Only the folders of the given dates are listed and read."""
    return with_path_parts(read_raw_arrays(spark, dated_glob(root, entity, first, last)))


def with_path_parts(raw: DataFrame) -> DataFrame:
    """Add ``path_repository`` (file-safe name) and ``path_date``, parsed from the file name."""
    return raw.withColumns(
        {
            "path_repository": capture(F.col("source_file"), DATED_PATH, 2),
            "path_date": capture(F.col("source_file"), DATED_PATH, 3).cast("date"),
        }
    )
