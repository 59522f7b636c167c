"""Short benchmark items inside long documents.

Containment of an item's shingles is searched with MinHash sketches sized by
partitions of the items: an item with n shingles of which a share t must be found can
miss at most n - ceil(t n) of them, so of its n - ceil(t n) + 1 smallest hash values at
least one is in every document that contains it. Documents look up their shingles'
hashes in the sketches; candidates are verified by exact shingle containment. An item of
fewer words than a shingle has is one shingle of its own size, which is looked for among
the documents' windows of that many words. No pair is lost. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 200_000


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, digits and marks."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}]+")
    return F.filter(split, lambda w: w != "")


def shingle_texts(words: Column, n: int | Column = SHINGLE) -> Column:
    """Distinct shingles; fewer than ``n`` words are one shingle, no words none."""
    return bound(words, lambda w: shingle_texts_of(w, n))


def shingle_texts_of(words: Column, n: int | Column) -> Column:
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    many = F.array_distinct(F.transform(places, lambda i: F.concat_ws(" ", F.slice(words, i + 1, n))))
    return F.when(F.size(words) >= n, many).when(F.size(words) > 0, F.array(F.concat_ws(" ", words))).otherwise(F.array().cast("array<string>"))


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """Hashes of all shingles, in order, with repetitions; as ``shingle_texts`` counts them."""
    return bound(words, lambda w: shingle_hashes_of(w, n))


def shingle_hashes_of(words: Column, n: int) -> Column:
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    many = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    few = F.array(F.xxhash64(*[F.get(words, F.lit(k)) for k in range(n)]))
    return F.when(F.size(words) >= n, many).when(F.size(words) > 0, few).otherwise(F.array().cast("array<bigint>"))


def windows_of(words: Column, sizes: list[int]) -> Column:
    """Hashes of all windows of the given numbers of words, for documents that are longer than these."""
    return bound(words, lambda w: F.concat(*[F.when(F.size(w) > k, shingle_hashes_of(w, k)).otherwise(F.array().cast("array<bigint>")) for k in sizes]))


def sketched(items: DataFrame, containment: float, n: int) -> DataFrame:
    """(item, part, h): the sketches of the items in partitions of doubling size.

    Each partition has sketches as long as its largest size asks for.
    """
    size = F.size("hashes")
    part = F.floor(F.log2(size)).cast("int")
    upper = F.pow(F.lit(2), part + 1).cast("long") - 1
    length = (upper - F.ceil(upper * F.lit(containment) - 1e-9) + 1).cast("int")
    return (
        items.select("item", F.array_distinct(shingle_hashes(F.col("words"), n)).alias("hashes"))
        .where(size > 0)
        .select("item", part.alias("part"), F.explode(F.slice(F.sort_array("hashes"), F.lit(1), length)).alias("h"))
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    n: int = SHINGLE,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of all pairs with n_shared >= containment * n_item.

    ``n_item`` counts the distinct word shingles of the item, ``n_shared`` those of
    them that the document has too. An item of fewer than ``n`` words is one shingle
    and is found wherever these words follow one another. Null and empty texts
    are in nothing and contain nothing. Repeated ids are treated as one text each: a
    pair is returned once with the largest ``n_shared``. Rows without an id are left
    out. Extra columns are ignored.
    """
    named = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), words_of(F.col(item_text)).alias("words")).distinct()
    sketches = sketched(named, containment, n).select("h", "item").distinct()
    # Broadcast only a table that was counted and found small; else the join is shuffled.
    if sketches.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sketches = F.broadcast(sketches)
    texts = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    # Fewer than n sizes; mostly there are no such items, and then no such windows.
    short = sorted(r[0] for r in named.where((F.size("words") > 0) & (F.size("words") < n)).select(F.size("words")).distinct().collect())
    hashes = shingle_hashes(words_of(F.col("text")), n)
    if short:
        hashes = bound(words_of(F.col("text")), lambda w: F.concat(shingle_hashes_of(w, n), windows_of(w, short)))
    hashed = texts.select("doc", F.explode(F.array_distinct(hashes)).alias("h"))
    # Written, so that the next join knows how few they are and need not shuffle the texts.
    candidates = cut_lineage(hashed.join(sketches, "h").select("doc", "item").distinct())
    of_items = named.select("item", F.least(F.size("words"), F.lit(n)).alias("of_words"), shingle_texts(F.col("words"), n).alias("of_item")).distinct()
    verified = (
        texts.join(candidates, "doc")
        .join(of_items, "item")
        .select("doc", "item", F.size("of_item").alias("n_item"), F.size(F.array_intersect("of_item", shingle_texts(words_of(F.col("text")), F.col("of_words")))).alias("n_shared"))
        .where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(containment) - 1e-9))
    )
    return (
        verified.groupBy("doc", "item")
        .agg(F.max_by(F.struct("n_item", "n_shared"), "n_shared").alias("best"))
        .select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "best.n_item", "best.n_shared")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay, rows without an id too."""
    found = contained_items(docs, items, doc_id=doc_id, **options).select(doc_id).distinct()
    return docs.join(found, doc_id, "left_anti").select([f"`{c}`" for c in docs.columns])
