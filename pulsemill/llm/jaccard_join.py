"""Texts whose sets of word n-grams are alike, by rare-first prefix filtering.

Texts with equal sets are one class. The n-grams of a class are put into a global order,
rare ones first; two sets that reach the threshold share an n-gram of their prefixes.
Classes that meet there pass the length filter, the positional filter and a suffix
filter, and each pair is verified once on the whole sets.

Rarity comes from counts of all n-grams in a table of fixed size, indexed by their hash.
Any global order gives right results, so n-grams that share a cell only make prefixes a
little less selective. N-grams and classes are known by 64-bit hashes.

N-grams of prefixes are sent once, to partitions by n-gram, and sorted there: those of one
class alone end there, and those that a few classes share give their pairs on the spot.
Only groups of many classes are kept. There classes are compared with one of them first, a few
times with another one, and joined to components; then all pairs that are not in one
component yet are compared. So a large group of near copies costs about one comparison
for each, not one for each pair, and no link between components is lost. For the
verification texts travel compressed, as they are much smaller than their sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.bytewords import Powers, Words, blocks, mixed
from pulsemill.llm.components import components
from pulsemill.session import cut_lineage

CELL_BITS = 20
CHUNKS = 64
SIGNATURES = ("s0", "s1", "s2", "s3")
#: Times that groups are compared with one member before all the rest is compared.
STAR_ROUNDS = 3
#: Classes that share an n-gram and are paired where the n-gram is read; groups of more go through the rounds.
FEW = 8
KEY_SALT = np.uint64(0xD1B54A32D192ED03)


@dataclass(frozen=True)
class Likeness:
    """Sets of distinct shingles of ``n`` words link when share_of * common >= share * union."""

    n: int = 5
    share: int = 80
    share_of: int = 100

    def prefix(self, size: int) -> int:
        return size - -(-size * self.share // self.share_of) + 1


def ngram_sets(texts: list[str | None], n: int, powers: Powers) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    for _, raw in blocks(texts):
        found, bounds = Words(raw, powers).shingles(n)
        for i in range(len(raw)):
            yield np.unique(found[bounds[i] : bounds[i + 1]])


def class_key(grams: np.ndarray) -> int:
    """The same for equal sets."""
    if not len(grams):
        return 0
    return int(mixed((mixed(grams ^ KEY_SALT).sum() + np.uint64(len(grams)))[None])[0].view(np.int64))


def signature(grams: np.ndarray) -> np.ndarray:
    """Parities of the number of n-grams in 256 parts: four longs."""
    part = (mixed(grams) >> np.uint64(56)).astype(np.int64)
    return np.packbits((np.bincount(part, minlength=256) & 1).astype(np.uint8)).view("<i8")


def cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def described(docs: DataFrame, n: int) -> DataFrame:
    """Two kinds of rows: of each text (row, n_grams, key, signature), and at the end of
    each task (chunk, counts) with its share of the counts of all n-grams."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, counts = Powers(), np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            sizes, keys, marks = [], [], []
            for grams in ngram_sets(batch.column(1).to_pylist(), n, powers):
                np.add.at(counts, cells(grams), 1)
                sizes.append(len(grams))
                keys.append(class_key(grams))
                marks.append(signature(grams))
            marks = np.array(marks).reshape(-1, 4)
            nothing = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), *(pa.array(marks[:, i]) for i in range(4)), *nothing]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        packed = [zlib.compress(c.astype("<i8").tobytes(), 1) for c in np.split(counts, CHUNKS)]
        empty = [pa.nulls(CHUNKS, kind) for kind in (arrow_id, *[pa.int64()] * 6)]
        if arrow_id is not None and counts.any():
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(CHUNKS), pa.int32()), pa.array(packed, pa.binary())], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = ["id", "n_grams", "key", *SIGNATURES, "chunk", "counts"]
    arrow_id = to_arrow_type(docs.schema["id"].dataType)
    kind = dict(docs.dtypes)["id"]
    schema = f"id {kind}, n_grams bigint, key bigint, " + ", ".join(f"{s} bigint" for s in SIGNATURES) + ", chunk int, counts binary"
    return docs.select("id", "text").mapInArrow(work, schema)


def counted(parts: DataFrame) -> np.ndarray:
    """The counts of all n-grams by cell: the sum over tasks, of a fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(counts), "<i8")
                totals[chunk] = totals[chunk] + counts if chunk in totals else counts
        if totals:
            packed = [zlib.compress(c.tobytes(), 1) for c in totals.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "counts"])

    shape = "chunk int, counts binary"
    # Summed in the tasks that read the parts, then by chunk.
    summed = parts.mapInArrow(add, shape).repartition(CHUNKS, "chunk").mapInArrow(add, shape)
    out = np.zeros((CHUNKS, (1 << CELL_BITS) // CHUNKS), np.int64)
    for row in summed.toLocalIterator():
        out[row.chunk] += np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return out.ravel()


def prefixes(docs: DataFrame, like: Likeness, counts: np.ndarray) -> DataFrame:
    """(gram, key, n_grams, place): the rare-first prefixes of all texts; equal sets may give equal rows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, rarity = Powers(), shared.value
        seen: set[int] = set()
        for batch in batches:
            found: list[tuple[np.ndarray, int, int]] = []
            for grams in ngram_sets(batch.column(0).to_pylist(), like.n, powers):
                if not len(grams):
                    continue
                key = class_key(grams)
                if key in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                take = like.prefix(len(grams))
                rare = rarity[cells(grams)]
                if take < len(grams) // 2:
                    border = np.partition(rare, take - 1)[take - 1]
                    near = np.flatnonzero(rare <= border)
                    grams_near, rare = grams[near], rare[near]
                else:
                    grams_near = grams
                order = np.lexsort((grams_near, rare))[:take]
                found.append((grams_near[order].view(np.int64), key, len(grams)))
            if found:
                lengths = [len(g) for g, _, _ in found]
                places = np.concatenate([np.arange(m) for m in lengths])
                columns = [np.concatenate([g for g, _, _ in found]), np.repeat([k for _, k, _ in found], lengths), np.repeat([m for _, _, m in found], lengths), places]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["gram", "key", "n_grams", "place"])

    return docs.select("text").mapInArrow(work, "gram bigint, key bigint, n_grams bigint, place bigint")


def needed(like: Likeness, a: str, b: str) -> Column:
    return F.expr(f"(({a} + {b}) * {like.share} + {like.share + like.share_of - 1}) div {like.share + like.share_of}")


def may_link(like: Likeness) -> Column:
    """Length, positional and suffix filters on the columns of both sides.

    The positional bound holds at the first common n-gram of a pair, so a pair that
    links passes at one of its common n-grams at least. Sets with an odd difference in
    so many of 256 parts differ in as many n-grams at least, which bounds what they
    have in common.
    """
    length = F.expr(f"{like.share_of} * least(n_a, n_b) >= {like.share} * greatest(n_a, n_b)")
    rest = F.expr("least(n_a - place_a, n_b - place_b)")
    return length & (rest >= needed(like, "n_a", "n_b")) & odd_parts(like)


HEAD = ("gram", "key", "n_grams", "place")


def paired(rows: dict[str, np.ndarray], like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) of rows with the same n-gram that pass the length and the positional
    filter. Rows are sorted by n-gram, at most ``FEW`` of each."""
    firsts, seconds = [], []
    for k in range(1, FEW):
        i = np.flatnonzero(rows["gram"][:-k] == rows["gram"][k:])
        if not len(i):
            break
        j = i + k
        n_a, n_b = rows["n_grams"][i], rows["n_grams"][j]
        least = ((n_a + n_b) * like.share + like.share + like.share_of - 1) // (like.share + like.share_of)
        rest = np.minimum(n_a - rows["place"][i], n_b - rows["place"][j])
        a, b = rows["key"][i], rows["key"][j]
        ok = (like.share_of * np.minimum(n_a, n_b) >= like.share * np.maximum(n_a, n_b)) & (rest >= least) & (a != b)
        firsts.append(np.minimum(a, b)[ok])
        seconds.append(np.maximum(a, b)[ok])
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *firsts]), np.concatenate([nothing, *seconds])


def grouped(heads: DataFrame, like: Likeness) -> DataFrame:
    """Prefix rows by n-gram: (a, b) for pairs of small groups, (gram, key, n_grams, place) for rows of large ones.

    Rows come sorted by n-gram; a task holds one batch and the group that is open at its
    end, of which it keeps no more than ``FEW`` rows: a larger group is passed on as it is read.
    """
    names = ["a", "b", *HEAD]

    def out(pairs: tuple[np.ndarray, np.ndarray], large: dict[str, np.ndarray]) -> pa.RecordBatch:
        m, n = len(pairs[0]), len(large["gram"])
        left = [pa.concat_arrays([pa.array(p), pa.nulls(n, pa.int64())]) for p in pairs]
        right = [pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(large[c])]) for c in HEAD]
        return pa.RecordBatch.from_arrays([*left, *right], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in HEAD}
        large_gram = None
        for batch in batches:
            rows = {c: np.concatenate([held[c], batch.column(i).to_numpy()]) for i, c in enumerate(HEAD)}
            if not len(rows["gram"]):
                continue
            # Equal sets may have been read by several tasks: one row of each class for an n-gram.
            again = np.zeros(len(rows["gram"]), bool)
            again[1:] = (rows["gram"][1:] == rows["gram"][:-1]) & (rows["key"][1:] == rows["key"][:-1])
            rows = {c: v[~again] for c, v in rows.items()}
            starts = np.flatnonzero(np.concatenate([[True], rows["gram"][1:] != rows["gram"][:-1]]))
            sizes = np.diff(np.append(starts, len(rows["gram"])))
            is_large = sizes > FEW
            if large_gram is not None and rows["gram"][0] == large_gram:
                is_large[0] = True
            last_open = not is_large[-1]
            large_gram = None if last_open else rows["gram"][-1]
            cut = int(starts[-1]) if last_open else len(rows["gram"])
            mask = np.repeat(is_large, sizes)
            held = {c: v[cut:] for c, v in rows.items()}
            done = {c: v[:cut] for c, v in rows.items()}
            mask = mask[:cut]
            yield out(paired({c: v[~mask] for c, v in done.items()}, like), {c: v[mask] for c, v in done.items()})
        yield out(paired(held, like), {c: np.zeros(0, np.int64) for c in HEAD})

    sorted_rows = heads.repartition("gram").sortWithinPartitions("gram", "key").select(*HEAD)
    return sorted_rows.mapInArrow(work, ", ".join(f"{c} bigint" for c in names))


def odd_parts(like: Likeness) -> Column:
    """The suffix filter on the signatures of both sides, see ``may_link``."""
    differ = F.expr(" + ".join(f"bit_count({s}_a ^ {s}_b)" for s in SIGNATURES))
    return F.expr("n_a + n_b") - differ >= 2 * needed(like, "n_a", "n_b")


def suffix_filtered(pairs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose signatures let them link."""

    def of(name: str) -> DataFrame:
        return classes.select(F.col("key").alias(name), F.col("n_grams").alias(f"n_{name}"), *[F.col(s).alias(f"{s}_{name}") for s in SIGNATURES])

    return pairs.join(of("a"), "a").join(of("b"), "b").where(odd_parts(like)).select("a", "b")


def side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("gram", F.col("key").alias(name), F.col("part").alias(f"part_{name}"), F.col("n_grams").alias(f"n_{name}"), F.col("place").alias(f"place_{name}"), *[F.col(s).alias(f"{s}_{name}") for s in SIGNATURES])


def stars(parted: DataFrame, like: Likeness, number: int) -> DataFrame:
    """Pairs (a, b): in each n-gram's group one member, another one each round, with all
    those of other components that may link to it."""
    described = F.struct("key", "part", "n_grams", "place", *SIGNATURES)
    groups = (
        parted.groupBy("gram")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"), F.min_by(described, F.xxhash64("key", F.lit(number))).alias("head"))
        .where("low <> high")
        .select("gram", "head.*")
    )
    met = side(groups, "a").join(side(parted, "b"), "gram").where("part_a <> part_b").where(may_link(like))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def crossings(parted: DataFrame, like: Likeness) -> DataFrame:
    """All pairs (a, b) of different components that share an n-gram and may link."""
    groups = parted.groupBy("gram").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("gram")
    still = parted.join(groups, "gram", "left_semi")
    return side(still, "a").join(side(still, "b"), "gram").where("a < b AND part_a <> part_b").where(may_link(like)).select("a", "b").distinct()


class Texts:
    """Compressed texts, one for each class that was compared so far."""

    def __init__(self, docs: DataFrame, classes: DataFrame, like: Likeness):
        self.docs, self.classes, self.like = docs, classes, like
        self.held: DataFrame | None = None

    def add(self, keys: DataFrame) -> DataFrame:
        """All texts held, those of ``keys`` (distinct) among them."""
        wanted = keys if self.held is None else keys.join(self.held.select("key"), "key", "left_anti")
        ids = cut_lineage(wanted.join(self.classes.select("key", "label"), "key").select(F.col("label").alias("id")))
        n = self.like.n

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                texts = batch.column(0).to_pylist()
                keys = [class_key(grams) for grams in ngram_sets(texts, n, powers)]
                bodies = [zlib.compress((t or "").encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())], names=["key", "body"])

        new = cut_lineage(self.docs.join(ids, "id", "left_semi").select("text").mapInArrow(packed, "key bigint, body binary"))
        self.held = new if self.held is None else self.held.union(new)
        return self.held

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, by their whole sets."""
        keys = cut_lineage(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "key"))
        held = self.add(keys).join(keys, "key", "left_semi")
        met = pairs.join(held.select(F.col("key").alias("a"), F.col("body").alias("of_a")), "a").join(
            held.select(F.col("key").alias("b"), F.col("body").alias("of_b")), "b"
        )
        like = self.like

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            # Pairs with the same text often follow one another.
            made: dict[int, np.ndarray] = {}

            def grams(key: int, body: pa.BinaryScalar) -> np.ndarray:
                if key not in made:
                    if len(made) >= 64:
                        made.clear()
                    text = zlib.decompress(body.as_py()).decode("utf-8", "surrogatepass")
                    made[key] = next(ngram_sets([text], like.n, powers))
                return made[key]

            for batch in batches:
                a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                linked = []
                for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
                    one, other = grams(x, batch.column(2)[i]), grams(y, batch.column(3)[i])
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    linked.append(like.share_of * common >= like.share * (len(one) + len(other) - common))
                mask = np.array(linked, bool)
                yield pa.RecordBatch.from_arrays([pa.array(a[mask]), pa.array(b[mask])], names=["a", "b"])

        # A text with a repeated id may have been read for another one: hence distinct.
        return cut_lineage(met.select("a", "b", "of_a", "of_b").mapInArrow(compare, "a bigint, b bigint").distinct())


def similar_texts(docs: DataFrame, like: Likeness = Likeness(), *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for each row of ``docs``.

    ``class_id`` is the smallest id with the same set of n-grams, ``component_id`` the
    smallest id that links lead to. A text of fewer than n words has its whole sequence
    as its one n-gram; null texts and texts without words have none and are their own
    class and component. Words are split at ASCII white space with A-Z lower-cased.
    Repeated rows are kept; rows without an id take part, but give no id to others.
    Extra columns are ignored; an empty table gives an empty one.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    table = cut_lineage(described(rows, like.n))
    texts = table.where("chunk IS NULL")
    counts = counted(table.where("chunk IS NOT NULL").select("chunk", "counts"))
    classes = cut_lineage(
        texts.where("n_grams > 0")
        .groupBy("key")
        .agg(F.min("id").alias("label"), F.first("n_grams").alias("n_grams"), *[F.first(s).alias(s) for s in SIGNATURES])
        .where("label IS NOT NULL")
    )
    met = cut_lineage(grouped(prefixes(rows, like, counts), like))
    near = met.where("a IS NOT NULL").select("a", "b").distinct()
    shared = cut_lineage(met.where("gram IS NOT NULL").select(*HEAD).distinct().join(classes.select("key", *SIGNATURES), "key"))
    labels, texts_held = classes.select("key", "label"), Texts(rows, classes, like)
    links, parted, found = None, shared.withColumn("part", F.col("key")), None
    for number in range(STAR_ROUNDS + 1):
        # The last time around, everything that is still apart is compared.
        last = number == STAR_ROUNDS
        pairs = crossings(parted, like) if last else stars(parted, like, number)
        if number == 0:
            pairs = pairs.union(suffix_filtered(near, classes, like)).distinct()
        pairs = cut_lineage(pairs)
        if not pairs.limit(1).count():
            if last:
                break
            continue
        new = texts_held.verified(pairs)
        links = new if links is None else links.union(new)
        found = components(labels, links)
        first = found.join(labels.select("label", F.col("key").alias("part")), "label").select("key", "part")
        parted = shared.join(first, "key", "left").withColumn("part", F.coalesce("part", "key"))
    if found is None:
        found = labels.limit(0)
    of_class = classes.select("key", F.col("label").alias("class_id")).join(found.withColumnRenamed("label", "component_id"), "key", "left")
    return texts.select("id", "n_grams", F.when(F.col("n_grams") > 0, F.col("key")).alias("key")).join(of_class, "key", "left").select(
        F.col("id").alias(doc_id),
        F.col("n_grams").alias("n_shingles"),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("component_id", "class_id", "id").alias("component_id"),
    )


def keep_one(docs: DataFrame, like: Likeness = Likeness(), *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: of its smallest id; rows without words or id all stay.

    If that id has several rows, all of them stay. All columns are kept.
    """
    found = similar_texts(docs, like, doc_id=doc_id, text=text)
    gone = found.where((F.col("n_shingles") > 0) & (F.col("component_id") < F.col(doc_id))).select(doc_id).distinct()
    return docs.join(gone, doc_id, "left_anti").select([f"`{c}`" for c in docs.columns])
