"""Queries of the operators that are DataFrame functions throughout, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm import decontaminate, outliers, preferences, sharding, url_filter
from pulsemill.llm.url_filter import UrlRule

# The given rules.
URL_RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)
SHARDS = 40
ROW_BYTES = 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page: the longest rule, else trust and distrust of its host."""
    judged = url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


#: Rounds of the SQL, which cannot stop by itself: more than the operator needs to settle for any
#: weight of seeds up to a hundred million pages.
SQL_ROUNDS = 180


def op1_sql() -> str:
    """The same; the propagation is a recursion over rounds."""
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.host + r.path}', '{r.verdict}')" for r in URL_RULES)
    host = r"translate(regexp_extract({0}, '^.*?://([^/?#]*)', 1, 's'), '" + url_filter.UPPER + "', '" + url_filter.LOWER + "')"
    return f"""
WITH RECURSIVE rules(rule_host, rule_path, rule, verdict) AS (VALUES {rules}),
seen AS (
  SELECT row_number() OVER () AS n, page_id, html, coalesce({host.format('url')}, '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
won AS (
  SELECT n, max(struct_pack(l := length(rule), r := rule, v := verdict)) AS w
  FROM seen JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n),
judged AS (SELECT seen.*, w.r AS rule, w.v AS verdict FROM seen LEFT JOIN won USING (n)),
targets AS (
  SELECT host AS src, unnest(regexp_extract_all(html, 'href\\s*=\\s*["'']?(//[^"''\\s>]+|[^"''\\s>]*://[^"''\\s>]+)', 1, 'i')) AS target FROM seen),
edges AS (
  SELECT src, dst, count(*) AS links FROM (SELECT src, {host.format('whole')} AS dst FROM (SELECT src, CASE WHEN starts_with(target, '//') THEN 'http:' || target ELSE target END AS whole FROM targets))
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src AS start, dst AS stop, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
steps AS (SELECT kind, start, stop, links / sum(links) OVER (PARTITION BY kind, start) AS share FROM both_ways),
seeds AS (
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS pages
  FROM judged WHERE rule IS NOT NULL AND host <> '' GROUP BY ALL),
start AS (SELECT kind, host, pages / sum(pages) OVER (PARTITION BY kind) AS part FROM seeds),
-- No round of one kind passes on more than the damping of what it holds; the rest returns to the seeds.
scores AS (
  SELECT 0 AS round, kind, host, part AS score FROM start
  UNION ALL
  SELECT round + 1, kind, host, sum(score) FROM (
    SELECT s.round, s.kind, t.stop AS host, {url_filter.DAMPING} * s.score * t.share AS score
    FROM scores s JOIN steps t ON s.kind = t.kind AND s.host = t.start WHERE s.round < {SQL_ROUNDS}
    UNION ALL
    SELECT m.round, b.kind, b.host, b.part * (1 - m.passed)
    FROM start b JOIN (
      SELECT s.round, s.kind, sum(CASE WHEN w.start IS NOT NULL THEN {url_filter.DAMPING} * s.score ELSE 0 END) AS passed
      FROM scores s LEFT JOIN (SELECT DISTINCT kind, start FROM steps) w ON w.kind = s.kind AND w.start = s.host
      WHERE s.round < {SQL_ROUNDS} GROUP BY s.round, s.kind) m ON m.kind = b.kind)
  GROUP BY round, kind, host),
weight AS (SELECT greatest(coalesce(sum(pages), 0), 1) AS pages FROM seeds WHERE kind = 'distrust'),
hosts AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust
  FROM scores WHERE round = {SQL_ROUNDS} GROUP BY host)
SELECT page_id, host, path, rule,
       CASE WHEN verdict IS NOT NULL THEN verdict WHEN distrust >= {url_filter.THRESHOLD} / weight.pages AND distrust > trust THEN 'block' ELSE 'allow' END AS verdict
FROM judged CROSS JOIN weight LEFT JOIN hosts USING (host)"""


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference rows of conversations that share their first turn, and of every conversation
    with a reply against itself with another last reply: the one before it, or, where there
    is one only, that of another conversation."""
    turns = read(spark, sf_dir, "conversations")
    met = preferences.turns_of_pairs(turns, preferences.pairs_by_opening(turns))
    stale, borrowed = preferences.stale_replies(turns), preferences.borrowed_replies(turns)
    chosen, rejected = (met[i].unionByName(stale[i]).unionByName(borrowed[i]) for i in (0, 1))
    return preferences.preference_turns(chosen, rejected)


def op4_preferences_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``op4_preferences``, which used to leave out conversations with one reply."""
    return op4_preferences(spark, sf_dir)


OP4_SQL = """
WITH clean AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
first_turn AS (
  SELECT conv_id, role, text FROM clean QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1),
led AS (SELECT conv_id AS rejected, min(conv_id) OVER (PARTITION BY role, text) AS chosen FROM first_turn),
pairs AS (SELECT chosen, rejected FROM led WHERE chosen <> rejected),
replies AS (
  SELECT *, lead(turn) OVER w AS later, lag(text) OVER w AS stale
  FROM (SELECT conv_id, turn, max(text) AS text FROM clean WHERE role = 'assistant' GROUP BY ALL) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
lasts AS (SELECT conv_id, turn AS last_turn, text, stale FROM replies WHERE later IS NULL),
hashed AS (SELECT DISTINCT text, md5(text) AS h FROM lasts),
digits AS (SELECT CAST(floor(log2(greatest(count(*) // 256, 1)) / 4) AS INT) AS d FROM hashed),
nearest AS (
  SELECT text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS other
  FROM (SELECT text, h, substr(h, 1, d) AS bucket FROM hashed, digits) WINDOW w AS (PARTITION BY bucket ORDER BY h, text)),
ending AS (
  SELECT conv_id, last_turn, l.text, coalesce(stale, other) AS stale FROM lasts l JOIN nearest n ON n.text = l.text
  WHERE stale IS NOT NULL OR other <> l.text),
history AS (SELECT c.conv_id AS chosen, c.conv_id AS rejected, c.turn, c.role, c.text FROM clean c JOIN ending USING (conv_id) WHERE c.turn < last_turn),
left_turns AS (
  SELECT p.*, c.turn, c.role, c.text FROM pairs p JOIN clean c ON c.conv_id = p.chosen
  UNION ALL FROM history UNION ALL SELECT conv_id, conv_id, last_turn, 'assistant', text FROM ending),
right_turns AS (
  SELECT p.*, c.turn, c.role, c.text FROM pairs p JOIN clean c ON c.conv_id = p.rejected
  UNION ALL FROM history UNION ALL SELECT conv_id, conv_id, last_turn, 'assistant', stale FROM ending),
uneven AS (
  (SELECT * FROM left_turns EXCEPT SELECT * FROM right_turns) UNION ALL (SELECT * FROM right_turns EXCEPT SELECT * FROM left_turns)),
ends AS (SELECT chosen, rejected, min(turn) AS parts_at FROM uneven GROUP BY ALL),
parts AS (
  SELECT CASE WHEN e.parts_at IS NULL OR turn < e.parts_at THEN 'prompt' ELSE 'chosen' END AS part, l.* FROM left_turns l LEFT JOIN ends e USING (chosen, rejected)
  UNION ALL
  SELECT 'rejected' AS part, r.* FROM right_turns r JOIN ends e USING (chosen, rejected) WHERE turn >= e.parts_at),
written AS (SELECT *, '<|im_start|>' || role || chr(10) AS opened, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM parts)
SELECT chosen, rejected, part, turn, role, rendered,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(opened) ELSE 0 END::BIGINT AS mask_start,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(rendered) - 1 ELSE 0 END::BIGINT AS mask_end
FROM written"""


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that it contains."""
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
whole AS (SELECT doc_id, array_to_string(w[i:least(i + 4, len(w))], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(1, len(w))) + 1)) AS i FROM d)),
sizes_below AS (SELECT DISTINCT len(w) AS k FROM b WHERE len(w) BETWEEN 1 AND 4),
short AS (SELECT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes_below WHERE len(w) >= k)),
ds AS (SELECT doc_id, s FROM whole UNION SELECT doc_id, s FROM short),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:least(i + 4, len(w))], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, least(1, len(w))) + 1)) AS i FROM b)),
sizes AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n::INTEGER AS n_item, count(*)::INTEGER AS n_shared
FROM bs JOIN ds USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) * 10 >= n * 8"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    sized = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    return sharding.shard_by_size(sized, F.col("doc_id"), F.col("size"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document: base rules, then robust outliers of its language and source."""
    judged = outliers.judge_texts(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {
    "op11_quality_rules": op11_quality_rules,
    "op1_url_filter": op1_url_filter,
    "op4_preferences": op4_preferences,
    "op6_contamination": op6_contamination,
    "op10_sharding": op10_sharding,
    "op4_preferences_whole": op4_preferences_whole,
}
SQL = {"op1_url_filter": op1_sql(), "op4_preferences": OP4_SQL, "op4_preferences_whole": OP4_SQL, "op6_contamination": OP6_SQL}
