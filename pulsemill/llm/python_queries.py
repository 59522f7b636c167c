"""Queries of the operators that use numpy or Arrow inside tasks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import (
    factorisation,
    fill_middle,
    jaccard_join,
    kmeans_tree,
    packing,
    secret_scan,
    spelling,
    suffix_dedup,
)
from pulsemill.llm.native_queries import read


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, spans of all kinds."""
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte strings of earlier ones."""
    found = suffix_dedup.dedup_spans(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    packed = packing.pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document by links of 3-word shingles with a Jaccard similarity of 0.9."""
    found = jaccard_join.similar_texts(read(spark, sf_dir, "documents"), jaccard_join.Likeness(3, 90, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document; labels of the held-out fold are never used."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = factorisation.train(docs, read(spark, sf_dir, "labels"))
    scored = factorisation.score(docs, machine)
    return scored.select(
        "doc_id", factorisation.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found for every 50th vector."""
    return kmeans_tree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words, its form and its root."""
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents")))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form and cuts, with digests of its output and of the text restored from it."""
    made = fill_middle.fill_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_middle.restore_text(made.drop("text"))
    return restored.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS whole, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
drawn AS (
  SELECT doc_id, whole, regexp_extract_all(whole, '[ 	-]*[^ 	-]+|[ 	-]+') AS units,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(digest, i, 8) AS BIGINT)) AS h FROM texts),
cuts AS (
  SELECT *, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
         whole <> '' AND NOT contains(whole, '<P>') AND NOT contains(whole, '<S>') AND NOT contains(whole, '<M>') AND h[3] % 100 < 50 AS changed FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix,
         CASE WHEN NOT changed THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cuts)
SELECT doc_id, n, form, CASE WHEN changed THEN length(prefix) END AS prefix_chars, CASE WHEN changed THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN whole WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(whole) AS restored_sha256
FROM parts"""


QUERIES = {
    "op12_spelling": op12_spelling,
    "op13_fill_middle": op13_fill_middle,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op7_similar": op7_similar,
    "op8_quality": op8_quality,
    "op9_neighbours": op9_neighbours,
    "op5_secrets": op5_secrets,
}
SQL = {"op13_fill_middle": OP13_SQL}
