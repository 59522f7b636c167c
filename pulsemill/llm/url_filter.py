"""Verdicts on urls: explicit rules first, else trust and distrust over the link graph.

Hosts with allowed pages are trusted seeds, hosts with blocked pages distrusted ones.
Personalised PageRank carries trust along links; the same on reversed links carries
distrust back to the hosts that link to blocked ones. A host is blocked when its
distrust, counted in blocked pages, reaches the threshold, and its share of all distrust
is larger than its share of all trust. DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT_EVERY = 5
DAMPING = 0.85
#: Blocked pages that a host's distrust must amount to.
THRESHOLD = 0.001
#: Part of the threshold that all scores of a kind together may change by in the last round.
TOLERANCE = 0.1
MOST_RULES = 1000


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased, else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def winning_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest fitting rule as (length, rule, verdict), null if none fits.

    Equally long ones: the last by name. The rules are a literal of the plan, so
    there may be at most ``MOST_RULES``.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    kind = "array<struct<length: int, rule: string, verdict: string, host: string, path: string>>"
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    given = F.array(
        *[
            F.struct(*map(F.lit, (len(r.host + r.path), r.host + r.path, r.verdict, r.host, r.path)))
            for r in sorted(rules, key=lambda r: (r.host, r.path))
        ]
    ).cast(kind)
    fits = F.filter(
        given,
        lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]),
    )
    return F.array_max(fits)


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct links between different hosts as (src, dst, links), from ``href`` targets that
    name a host: absolute ones and protocol-relative ones (``//host/path``)."""
    targets = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)href\s*=\s*["']?(//[^"'\s>]+|[^"'\s>]*://[^"'\s>]+)"""), F.lit(1))
    target = F.when(F.col("target").startswith("//"), F.concat(F.lit("http:"), "target")).otherwise(F.col("target"))
    return (
        pages.select(url_host(F.col(url)).alias("src"), F.explode(targets).alias("target"))
        .select("src", url_host(target).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING, tolerance: float = 1e-9) -> DataFrame:
    """Personalised PageRank of both kinds at once: (kind, host, score).

    ``edges``: (src, dst, links). ``seeds``: (kind, host, weight), kind ``trust``
    following links or ``distrust`` following them backwards; weights are scaled to
    sum to 1 for each kind, and so do the scores: what reaches a host without onward
    links goes back to the seeds, in proportion to their weights. With ``rounds`` so many are run; else they go on until the
    change of a round, summed over the hosts of a kind, is below ``tolerance``: no score
    is then further than ``tolerance * damping / (1 - damping)`` from its limit. Scores
    are plain sums over edges grouped by their end, so a hot end is combined before the
    shuffle and a hot start is split by adaptive execution. Lineage is cut with
    ``checkpoint()`` every few rounds.
    """
    shared_folder(edges.sparkSession)  # where checkpoint() writes to
    forward = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), "links")
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"), "links")
    steps = forward.unionByName(backward)
    out = steps.groupBy("kind", "at").agg(F.sum("links").alias("all_links"))
    steps = steps.join(out, ["kind", "at"]).select("kind", "at", "to", (F.col("links") / F.col("all_links")).alias("share"))
    sums = seeds.groupBy("kind").agg(F.sum("weight").alias("sum"))
    start = seeds.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("weight") / F.col("sum")).alias("part"))
    steps, start = steps.checkpoint(), start.checkpoint()
    scores = start.select("kind", "host", F.col("part").alias("score"))
    # Round r changes at most 2 * damping ** (r - 1), whatever the links are.
    most = rounds if rounds is not None else 2 + math.ceil(math.log(tolerance / 2) / math.log(damping))
    for number in range(1, most + 1):
        moved = (
            scores.withColumnRenamed("host", "at")
            .join(steps, ["kind", "at"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg((F.sum(F.col("score") * F.col("share")) * damping).alias("score"))
        )
        # What is not passed on, by chance or for want of links, goes to the seeds: two sums.
        passed = moved.groupBy("kind").agg(F.sum("score").alias("passed"))
        returned = F.col("part") * (1 - F.coalesce("passed", F.lit(0.0)))
        kept = start.join(F.broadcast(passed), "kind", "left").select("kind", "host", returned.alias("score"))
        before, scores = scores, moved.unionByName(kept).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        # The first round after each cut is measured: the scores before it are at hand.
        measured = rounds is None and number % CUT_EVERY == 1
        if number % CUT_EVERY == 0 or number == most or measured:
            scores = scores.checkpoint()
        if measured and largest_change(before, scores) < tolerance:
            break
    return scores


def largest_change(before: DataFrame, after: DataFrame) -> float:
    """Of both kinds, the larger sum over hosts of what their scores changed by."""
    apart = (
        after.unionByName(before.withColumn("score", -F.col("score")))
        .groupBy("kind", "host")
        .agg(F.abs(F.sum("score")).alias("change"))
        .groupBy("kind")
        .agg(F.sum("change").alias("change"))
    )
    return apart.agg(F.max("change")).first()[0] or 0.0


def host_verdicts(edges: DataFrame, seeds: DataFrame, threshold: float = THRESHOLD, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust, verdict) for each host that any score reaches.

    ``trust`` and ``distrust`` are shares of their kinds. For the threshold the distrust
    is counted in the weights of the seeds (pages), so it does not depend on how many
    other hosts are seeds.
    """
    weight = seeds.where("kind = 'distrust'").agg(F.sum("weight")).first()[0] or 0
    least = threshold / max(weight, 1)
    scores = propagate(edges, seeds, rounds, damping, tolerance=min(TOLERANCE * least, TOLERANCE))

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)

    blocked = (F.col("distrust") >= least) & (F.col("distrust") > F.col("trust"))
    return (
        scores.groupBy("host")
        .agg(of("trust"), of("distrust"))
        .withColumn("verdict", F.when(blocked, "block").otherwise("allow"))
    )


def judge_urls(
    pages: DataFrame,
    rules: tuple[UrlRule, ...],
    *,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
    rounds: int | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, by) for each row of ``pages``; ``by``: rule, links or default.

    A host is a seed by the number of its pages that rules allow or block, so one
    page judged by a rule does not stand for its whole host: the scores of both kinds
    are compared, each as a share of its kind. The threshold is in blocked pages and does
    not move with the number of other hosts; the shares of a host that has both kinds do. Hosts out of reach of both are allowed. Null urls and urls without
    ``://`` have an empty host and path and are allowed; repeated rows are judged
    each; null html has no links; other columns are not carried along; no pages give
    no rows.
    """
    judged = pages.select(
        F.col(id_column), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    ).withColumn("won", winning_rule(F.col("host"), F.col("path"), rules))
    kind = F.when(F.col("won.verdict") == "allow", "trust").otherwise("distrust")
    seeds = (
        judged.where("won IS NOT NULL AND host <> ''").groupBy(kind.alias("kind"), "host").agg(F.count("*").alias("weight"))
    )
    hosts = host_verdicts(host_links(pages, url, html), seeds, threshold, rounds=rounds).select(
        "host", F.col("verdict").alias("host_verdict")
    )
    # The hosts are the small side; adaptive execution broadcasts them if their measured
    # size allows and else splits a hot host.
    return judged.join(hosts, "host", "left").select(
        id_column,
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("won").isNotNull(), "rule").when(F.col("host_verdict").isNotNull(), "links").otherwise("default").alias("by"),
    )
