"""From raw documents to packed training sequences, in stages that each read the last one's table.

Every stage but the last returns the columns of ``documents``. Null and empty texts,
repeated rows and extra columns are treated as the operators' docstrings say; empty
tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import decontaminate, factorisation, jaccard_join, packing, secret_scan
from pulsemill.llm.python_queries import vocabulary
from pulsemill.session import cut_lineage

#: Documents that score less are rejected.
LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects; it learns from ``labels``
    outside the held-out fold. Without any label nothing is rejected."""
    machine = factorisation.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # A name that no column of the documents can have taken.
    scored = factorisation.score(docs, machine, into="quality score of this stage")
    return scored.where(F.col("`quality score of this stage`") >= LEAST_QUALITY).select([f"`{c}`" for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a Jaccard similarity of 0.8: the smallest id."""
    return jaccard_join.keep_one(docs, jaccard_join.Likeness(5, 80, 100))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain 0.8 or more of the shingles of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and ``n_chars`` counted anew."""
    masked = secret_scan.redact_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: SQL cannot express the classifier or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the result of each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
    return docs
