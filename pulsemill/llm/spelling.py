"""Spelling variants: words one edit apart, found by asymmetric chunks and grams.

Two words are near if one inserted, deleted or replaced code point makes one of the other.
Each word takes both parts in a self-join. As the one side it gives its two halves, two
chunks that do not overlap; as the other side it gives grams of the sizes of such chunks.
An edit lies in one half, so the other half is a gram of the near word, moved by at most
one place: the first half opens both words, the second one closes both, and a length that
differs by one is the shift. Grams elsewhere cannot take part and are not sent.

One half alone would be shared by very many words (thousands of short words begin with the
same two letters). The half that holds the edit is therefore cut by the same rule once
more, and the join key is the kept half together with the kept part of the other one: about
three quarters of a word. Candidates are verified by edit distance; a pair that several
keys found counts once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

#: Runs of letters, after A to Z were lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
#: A run whose checksum this divides loses one code point.
DAMAGE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form has at least this many times a word's occurrences.
LEAD = 2
#: Distinct words that a task holds before it hands on their counts.
HELD_WORDS = 200_000


def damaged(run: str, seed: int, damage: int) -> str:
    """The run without one code point if ``damage`` divides its checksum, which goes on from ``seed``."""
    h = zlib.crc32(run.encode(), seed)
    if h % damage:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    damage: int = DAMAGE,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    held: int = HELD_WORDS,
) -> DataFrame:
    """(word, n): words of ``least_length`` code points or more that occur ``least_count`` times or more.

    Every run of every whole text counts, those of repeated rows each time. Tasks count what
    they read before anything is sent, so a word that fills a third of all texts is one row
    for each task. Null and empty texts have no words; a null id counts as empty text in the
    checksum. An empty table gives no words.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for number, raw in zip(ids, batch.column(1).cast(pa.binary())):
                raw = raw.as_py()
                if not raw:
                    continue
                seed = zlib.crc32(f"{'' if number is None else number}:".encode())
                # The lower case of bytes changes A to Z only.
                for run, n in Counter(RUN.findall(raw.lower().decode("utf-8", "replace"))).items():
                    if len(run) >= least_length:
                        word = damaged(run, seed, damage)
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= held:
                    yield handed_on()
                    counts.clear()
        if counts:
            yield handed_on()

    found = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(tally, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def head(word: Column, n: Column) -> Column:
    return F.substring(word, F.lit(1), n)


def tail(word: Column, length: Column, n: Column) -> Column:
    return F.substring(word, length - n + 1, n)


def kept_parts(word: Column, length: Column, of: Column) -> Column:
    """What a word shares with a near word of ``of`` code points, by where the edit lies.

    ``length`` is the word's own. With both the same these are the chunks, else the
    grams. The first half of a word of n code points has n div 2 of them; the half that
    holds the edit is cut likewise and keeps one of its parts.
    """
    first = F.floor(of / 2).cast("int")
    second = of - first
    quarter = F.floor(first / 2).cast("int")
    third = F.floor(second / 2).cast("int")

    def key(route: int, opening: Column, closing: Column) -> Column:
        return F.struct(F.lit(route).alias("route"), of.alias("size"), head(word, opening).alias("opening"), tail(word, length, closing).alias("closing"))

    nothing = F.lit(0)
    return F.array(
        key(0, first + third, nothing),
        key(1, first, second - third),
        key(2, quarter, second),
        key(3, nothing, second + first - quarter),
    )


def dealt(words: DataFrame) -> DataFrame:
    """For a join in which no side is broadcast.

    Spark takes a written table for as large as its files, where words and counts are packed
    twenty times smaller than in memory, and does not count the rows that an explode adds.
    """
    return words.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): pairs one edit apart, each in both directions, once for each key that found it.

    ``words``: (word), distinct, of four code points or more (shorter ones have no two
    halves of two and are left out).
    """
    sized = words.select("word", F.length("word").alias("length")).where("length >= 4")
    chunks = sized.select("word", F.explode(kept_parts(F.col("word"), F.col("length"), F.col("length"))).alias("key"))
    of = sized.select("word", "length", F.explode(F.sequence(F.col("length") - 1, F.col("length") + 1)).alias("of"))
    grams = of.where("of >= 4").select(
        F.col("word").alias("near"), F.explode(kept_parts(F.col("word"), F.col("length"), F.col("of"))).alias("key")
    )
    met = chunks.join(dealt(grams), "key").where("word <> near")
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. ``forms``: (word, form), form never null.

    Counts at least double from form to form, so paths are short; each round follows twice
    as many steps as the one before, is written, and the driver sees whether any moved.
    """
    state = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = cut_lineage(state.join(dealt(ahead), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        state = jumped.select("word", "root")


def group_variants(counted: DataFrame, *, lead: int = LEAD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``counted`` (word, n; words are distinct).

    ``n_near`` is the number of near words, ``form`` the one of them with the largest n
    (ties: the smallest in code-point order) if that is at least ``lead`` times the
    word's own, else null; ``root`` is where forms lead to, the word itself without one.
    ``lead`` is above 1, so that forms cannot lead back. Words of fewer than four code
    points have no near words here. No words give no rows.
    """
    if lead <= 1:
        raise ValueError("lead must be above 1")
    counted = cut_lineage(counted.select("word", F.col("n").cast("long").alias("n")))
    pairs = near_pairs(counted.select("word"))
    # Counts are joined to the verified pairs only.
    weighed = pairs.join(dealt(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("word")))
    around = weighed.groupBy("word").agg(F.count_distinct("near").alias("n_near"), best.alias("best"))
    leads = -F.col("best.minus_n") >= lead * F.col("n")
    judged = cut_lineage(
        counted.join(dealt(around), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, F.col("best.word")).alias("form"),
            F.when(leads, -F.col("best.minus_n")).alias("form_n"),
        )
    )
    roots = follow(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(dealt(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
