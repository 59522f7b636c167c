"""Training rows for preference learning from pairs of conversations.

The longest common turn prefix of the chosen and the rejected conversation is found
with one grouped count and one minimum per pair; it is rendered once as the prompt,
and the turns after it as two completions whose masks cover the assistant's words.
Every turn stays a row of its own, so neither a very long conversation nor a hot
opening is gathered in one task. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
#: Texts of replies that are put in order together: so many on average, or up to 16 times as many.
NEIGHBOURS = 256


def clean_turns(turns: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, text) with an id and a turn number; null roles and texts are empty."""
    return (
        turns.where("conv_id IS NOT NULL AND turn IS NOT NULL")
        .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct()
    )


def pairs_by_opening(turns: DataFrame) -> DataFrame:
    """(chosen, rejected): within conversations with the same first turn, the one with
    the smallest id against each other one. Linear in the number of conversations.

    The first turn is the row with the smallest turn number (ties: role, then text).
    """
    first = (
        clean_turns(turns)
        .groupBy("conv_id")
        .agg(F.min(F.struct("turn", "role", "text")).alias("f"))
        .select("conv_id", F.sha2(F.concat_ws("\x1f", "f.role", "f.text"), 256).alias("opening"))
    )
    leaders = first.groupBy("opening").agg(F.min("conv_id").alias("chosen"))
    return first.join(leaders, "opening").where("conv_id <> chosen").select("chosen", F.col("conv_id").alias("rejected"))


def turns_of_pairs(turns: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of both sides of pairs of conversations, for ``preference_turns``."""
    clean = clean_turns(turns)

    def side(name: str) -> DataFrame:
        return clean.join(pairs.withColumn("conv_id", F.col(name)), "conv_id").select("chosen", "rejected", "turn", "role", "text")

    return side("chosen"), side("rejected")


def stale_replies(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> tuple[DataFrame, DataFrame]:
    """Both sides of one pair for each conversation with two replies or more.

    Those with one reply have a pair by ``borrowed_replies``, those with none have no pair.

    Chosen is the conversation up to its last reply; in the rejected one that reply is
    the one before it once more. ``rejected`` is the same id as ``chosen``. Of several
    replies with one turn number the last in order of their texts counts.
    """
    clean = clean_turns(turns)
    replies = clean.where(F.col("role") == trained_role).groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    last = replies.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    before = (
        replies.join(last, "conv_id")
        .where(F.col("turn") < F.col("last.turn"))
        .groupBy("conv_id", "last")
        .agg(F.max(F.struct("turn", "text")).alias("before"))
    )
    kept = clean.join(before, "conv_id").where((F.col("turn") < F.col("last.turn")))
    history = kept.select(F.col("conv_id").alias("chosen"), F.col("conv_id").alias("rejected"), "turn", "role", "text")

    def ending(text: str) -> DataFrame:
        return before.select(F.col("conv_id").alias("chosen"), F.col("conv_id").alias("rejected"), F.col("last.turn").alias("turn"), F.lit(trained_role).alias("role"), F.col(text).alias("text"))

    return history.unionByName(ending("last.text")), history.unionByName(ending("before.text"))


def borrowed_replies(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> tuple[DataFrame, DataFrame]:
    """Both sides of one pair for each conversation with exactly one reply.

    Chosen is the conversation up to its reply; in the rejected one that reply is the
    last reply of another conversation: of the distinct last replies in a bucket the next
    one by hash, the first one after the last. Buckets grow in number with the distinct
    replies, so none has to hold many. ``rejected`` is the same id as ``chosen``. There is
    no pair where a bucket has one text only, as if all replies are the same.
    Conversations without a reply have no pair either: nothing in them can be chosen.
    """
    clean = clean_turns(turns)
    replies = clean.where(F.col("role") == trained_role).groupBy("conv_id", "turn").agg(F.max("text").alias("text"))
    last = replies.groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"), F.count("*").alias("replies"))
    texts = last.select(F.col("last.text").alias("text")).distinct().withColumn("h", F.md5(F.col("text").cast("binary")))
    # A bucket has the texts whose hashes begin alike.
    digits, filled = 0, texts.count() // NEIGHBOURS
    while 16 ** (digits + 1) <= filled:
        digits += 1
    bucket = Window.partitionBy(F.substring("h", 1, digits))
    after = F.lead("text").over(bucket.orderBy("h", "text"))
    nearest = texts.select("text", F.coalesce(after, F.min_by("text", F.struct("h", "text")).over(bucket)).alias("other")).where("other <> text")
    single = last.where("replies = 1").select("conv_id", F.col("last.turn").alias("at"), F.col("last.text").alias("text")).join(nearest, "text")
    ids = (F.col("conv_id").alias("chosen"), F.col("conv_id").alias("rejected"))
    kept = clean.join(single.select("conv_id", "at"), "conv_id").where("turn < at")
    history = kept.select(*ids, "turn", "role", "text")

    def ending(text: str) -> DataFrame:
        return single.select(*ids, F.col("at").alias("turn"), F.lit(trained_role).alias("role"), F.col(text).alias("text"))

    return history.unionByName(ending("text")), history.unionByName(ending("other"))


def preference_turns(chosen: DataFrame, rejected: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Rows (chosen, rejected, part, turn, role, rendered, mask_start, mask_end) of all pairs.

    Both inputs: (chosen, rejected, turn, role, text), the first two naming the pair.
    ``part`` is ``prompt`` for the turns of the longest common prefix (once), ``chosen``
    or ``rejected`` for the turns after it. ``rendered`` is the turn in chat markup. The
    mask is the span of characters of ``rendered`` to train on (start from 0, end
    exclusive): the text and the end mark of turns of ``trained_role`` in a completion,
    empty (0, 0) elsewhere.

    Turn numbers are compared, with the same (role, text) on both sides; a turn that
    only one side has ends the prefix. Equal conversations have a prompt only. Null
    roles and texts count as empty; rows without a turn number and exact repetitions of
    a row are left out; several rows with one turn number are one turn and are all
    rendered. Extra columns are ignored. Empty inputs give no rows. Order of a part:
    turn, role, rendered.
    """

    def side(df: DataFrame, bit: int) -> DataFrame:
        return df.where("turn IS NOT NULL").select(
            "chosen", "rejected", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(bit).alias("bit")
        )

    # One row for each turn of a pair; sides: 1 chosen, 2 rejected, 3 both.
    met = (
        side(chosen, 1)
        .unionByName(side(rejected, 2))
        .groupBy("chosen", "rejected", "turn", "role", "text")
        .agg(F.bit_or("bit").alias("sides"))
    )
    parted = met.where("sides <> 3").groupBy("chosen", "rejected").agg(F.min("turn").alias("parts_at"))
    opened = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"))
    rendered = F.concat(opened, F.col("text"), F.lit(CLOSE))
    part = F.explode(
        F.when(F.col("parts_at").isNull() | (F.col("turn") < F.col("parts_at")), F.array(F.lit("prompt")))
        .when(F.col("sides") == 1, F.array(F.lit("chosen")))
        .when(F.col("sides") == 2, F.array(F.lit("rejected")))
        .otherwise(F.array(F.lit("chosen"), F.lit("rejected")))
    )
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return (
        met.join(parted, ["chosen", "rejected"], "left")
        .select("chosen", "rejected", part.alias("part"), "turn", "role", "text")
        .select(
            "chosen",
            "rejected",
            "part",
            "turn",
            "role",
            rendered.alias("rendered"),
            F.when(trained, F.length(opened)).otherwise(0).cast("long").alias("mask_start"),
            F.when(trained, F.length(rendered) - 1).otherwise(0).cast("long").alias("mask_end"),
        )
    )


def preference_records(rows: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen, rejected and the masks' spans, for pairs that fit a row.

    Spans are (start, end) in characters of the joined part. A convenience for export:
    it gathers the turns of a pair, so use it where conversations have a bounded length.
    """
    made = rows.groupBy("chosen", "rejected").agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("part") == p, F.struct("turn", "role", "rendered", "mask_start", "mask_end")))).alias(p + "_turns")
            for p in ("prompt", "chosen", "rejected")
        ]
    )

    def text(p: str):
        return F.concat_ws("", F.transform(p + "_turns", lambda t: t["rendered"])).alias(p + "_text")

    def masks(p: str):
        before = lambda i: F.coalesce(F.aggregate(F.slice(p + "_turns", F.lit(1), i), F.lit(0), lambda s, t: s + F.length(t["rendered"])), F.lit(0))
        spans = F.transform(p + "_turns", lambda t, i: F.struct((before(i) + t["mask_start"]).alias("start"), (before(i) + t["mask_end"]).alias("end")))
        return F.filter(spans, lambda s: s["end"] > s["start"]).alias(p + "_masks")

    return made.select("chosen", "rejected", text("prompt"), text("chosen"), masks("chosen"), text("rejected"), masks("rejected"))
