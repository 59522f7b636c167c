"""Repository list and extraction settings from a JSON config file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names of the config file.
CONFIG_SCHEMA = """
repositories array<struct<owner string, repo string, description string, enabled boolean>>,
extraction_config struct<lookback_days int, include_closed_issues boolean,
    include_pull_requests boolean, include_comments boolean, max_issues_per_repo int>
"""


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True)


def enabled_repositories(spark: SparkSession, path: str) -> DataFrame:
    """Configured repositories; one without an ``enabled`` entry counts as enabled."""
    listed = read_config(spark, path).select(F.inline("repositories"))
    return listed.where(F.coalesce("enabled", F.lit(True))).select(
        "owner",
        "repo",
        F.concat_ws("/", "owner", "repo").alias("full_name"),
        "description",
    )


def extraction_settings(spark: SparkSession, path: str) -> DataFrame:
    return read_config(spark, path).select("extraction_config.*")
