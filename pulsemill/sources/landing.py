"""Writing documents to the landing area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions.temporal import AsOf, as_of_timestamp

LANDING_PARTITIONS = ["entity", "origin", "load_date", "repo_key"]

# Origin of what the daily extract writes.
EXTRACT = "extract"


def extraction_metadata(
    entity: str, full_name: Column, extraction_date: Column, as_of: AsOf
) -> dict[str, Column]:
    """Extraction time and date, logical file path and repository of a document.

    ``full_name`` is carried as it is. Only the file-safe form in the path replaces
    the slash, so names that hold an underscore survive.
    """
    day = extraction_date.cast("date")
    path = F.concat(
        F.lit(f"{entity}/"),
        F.date_format(day, "yyyy/MM/dd/"),
        file_safe(full_name),
        F.lit(f"_{entity}_"),
        F.date_format(day, "yyyy-MM-dd"),
        F.lit(".json"),
    )
    return {
        "extracted_at": F.date_format(as_of_timestamp(as_of), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "extraction_date": F.date_format(day, "yyyy-MM-dd"),
        "source_file": path,
        "source_repository": full_name,
    }


def file_safe(full_name: Column) -> Column:
    return F.replace(full_name, F.lit("/"), F.lit("_"))


def enrich(
    rows: DataFrame, entity: str, full_name: Column, extraction_date: Column, as_of: AsOf
) -> DataFrame:
    """Add the extraction metadata to documents whose fields are columns."""
    return rows.withColumns(extraction_metadata(entity, full_name, extraction_date, as_of))


def row_documents(rows: DataFrame) -> DataFrame:
    """Enriched rows as one JSON text each, ready for ``write_landing``."""
    return rows.select(
        F.to_json(F.struct("*")).alias("document"), "extraction_date", "source_repository"
    )


def raw_documents(
    raw: DataFrame, entity: str, full_name: Column, extraction_date: Column, as_of: AsOf
) -> DataFrame:
    """RAW documents with the extraction metadata added, ready for ``write_landing``.

    Metadata a document already has is left alone: a key must not occur twice.
    """
    doc = F.col("raw_data")
    metadata = extraction_metadata(entity, full_name, extraction_date, as_of)
    added = [
        F.when(F.try_variant_get(doc, f"$.{name}", "variant").isNull(), value).alias(name)
        for name, value in metadata.items()
    ]
    own, extra = F.to_json(doc), F.to_json(F.struct(*added))
    is_empty = own.isin("{}", "null")
    merged = (
        F.when(is_empty, extra)
        .when(extra == "{}", own)
        .otherwise(F.concat(own.substr(F.lit(1), F.length(own) - 1), F.lit(","), F.substring(extra, 2, 2**31 - 1)))
    )
    return raw.select(
        merged.alias("document"),
        metadata["extraction_date"].alias("extraction_date"),
        full_name.alias("source_repository"),
    )


def write_landing(documents: DataFrame, root: str, entity: str, origin: str = EXTRACT) -> None:
    """Write line-delimited JSON by entity, origin, date and repository.

    ``origin`` says which run wrote: an extract and a backfill that write the same day stay
    apart. The repository is encoded so that the name can be read back, whatever
    characters it holds. Writing an origin, date and repository again replaces it; an
    empty frame leaves everything as it was. The rebalance hint splits a partition
    that holds a large share of the rows over several files and merges the small ones.
    """
    laid_out = documents.select(
        F.col("document").alias("value"),
        F.lit(entity).alias("entity"),
        F.lit(origin).alias("origin"),
        F.col("extraction_date").alias("load_date"),
        F.url_encode(F.col("source_repository")).alias("repo_key"),
    )
    (
        laid_out.hint("rebalance", *[F.col(c) for c in LANDING_PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LANDING_PARTITIONS)
        .text(root)
    )
