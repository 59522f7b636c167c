"""Token sequences packed by exact complements.

Documents become pieces of at most ``capacity`` tokens. What can be packed depends on
the number of pieces of each length alone, and there are at most ``capacity`` lengths,
so the driver plans over those counts. Sums of one, two and three available lengths are
indexed by their sum: the gap that a length leaves is looked up among them, and a
combination that fills it exactly is consumed as often as the counts allow; what is
left is placed best fit. Spark then numbers the pieces of each length and every piece
reads its place off the plan. The plan is a few numbers for each length, however many
pieces there are.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

CAPACITY = 2048
END_ID = 0
CHUNK_ROWS = 500

# Fixed value: how byte-level vocabularies of this kind split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such vocabularies: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of texts as little-endian 32-bit runs, as the tokenizer file defines them.

    If the file is a plain byte-level vocabulary whose ids rise in the order of its
    merges, the same ids come from merging by rank, several times as fast. Texts with a
    special token, and other kinds of files, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = self.by_rank(json.loads(self.tokenizer.to_str()))

    @staticmethod
    def by_rank(spec: dict):
        import tiktoken

        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        if not plain or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            return None
        letters, added = byte_letters(), {t["id"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = model["vocab"]
        if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or any(vocabulary.get(c, 256) >= 256 for c in letters):
            return None
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if i not in added}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.ranked is None or any(s in text for s in self.special):
            return self.whole(text)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of all documents.

    A document is its token ids and ``end_id``. Longer ones are cut so that all pieces
    but the first have ``capacity`` tokens. Null and empty texts are the end alone.
    Repeated rows give repeated pieces. ``vocabulary`` is a file that the executors can
    read. Extra columns are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            names, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for at in range(0, len(texts), CHUNK_ROWS):
                rows: list[tuple] = []
                for row, text in enumerate(texts[at : at + CHUNK_ROWS], at):
                    ids = encoder.encode(text) + end
                    n = len(ids) // 4
                    start, stop = 0, n % capacity or capacity
                    number = 0
                    while start < n:
                        part = ids[4 * start : 4 * stop]
                        rows.append((row, number, start, stop - start, zlib.crc32(part), part if with_ids else None))
                        start, stop, number = stop, stop + capacity, number + 1
                row, number, start, length, crc, part = zip(*rows)
                columns = [names.take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array(part, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[doc_id, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    kind = dict(docs.dtypes)[doc_id]
    schema = f"`{doc_id}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(doc_id, text).mapInArrow(cut, schema)


class SumIndex:
    """Available lengths by the sums that one, two or three of them make.

    ``of_two[s]`` marks each length a that has a partner s - a, ``of_three[s]`` each a for which
    the sum s - a of two is there: tables that are addressed by the sum and hold one
    member of each combination. Both are kept right as counts run out: a length that is used up, or of
    which only one is left, is taken out of the entries that name it. Whether a
    combination names one length more often than there are pieces of it is left to the caller for
    sums of three.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        some = self.left > 0
        self.of_two = np.zeros((capacity + 1, capacity + 1), bool)
        for a in np.flatnonzero(some).tolist():
            self.of_two[a:, a] = some[: capacity + 1 - a]
        for a in np.flatnonzero(self.left[: capacity // 2 + 1] == 1).tolist():
            self.of_two[2 * a, a] = False
        self.twos = self.of_two.sum(1)
        self.of_three = np.zeros_like(self.of_two)
        for a in np.flatnonzero(some).tolist():
            self.of_three[a:, a] = self.twos[: capacity + 1 - a] > 0

    def drop_pair(self, a: int, b: int) -> None:
        """Take out the sum of two lengths."""
        total = a + b
        if total > self.capacity or not self.of_two[total, a]:
            return
        self.of_two[total, a] = self.of_two[total, b] = False
        self.twos[total] -= 1 if a == b else 2
        if not self.twos[total]:
            others = np.flatnonzero(self.left[: self.capacity + 1 - total] > 0)
            self.of_three[others + total, others] = False

    def take(self, combination: tuple[int, ...], times: int) -> None:
        for x in combination:
            self.left[x] -= times
        for x in set(combination):
            if self.left[x] <= 1:
                self.drop_pair(x, x)
            if self.left[x] == 0:
                for partner in np.flatnonzero(self.of_two[np.arange(x, self.capacity + 1), x]).tolist():
                    self.drop_pair(x, partner)
                self.of_three[:, x] = False

    def pairs(self, total: int) -> list[tuple[int, int]]:
        """Available pairs with that sum, the most uneven first."""
        larger = np.flatnonzero(self.of_two[total, (total + 1) // 2 :])[::-1] + (total + 1) // 2
        return [(a, total - a) for a in larger.tolist()]

    def triple(self, total: int, beside: int = 0) -> tuple[int, int, int] | None:
        """An available triple with that sum, its largest member as large as can be; ``beside`` is in use once."""
        for a in np.flatnonzero(self.of_three[total])[::-1].tolist():
            if 3 * a < total:
                return None
            for b, c in self.pairs(total - a):
                if b <= a and self.times((a, b, c, beside) if beside else (a, b, c)):
                    return a, b, c
        return None

    def times(self, combination: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // combination.count(x) for x in combination)


class Planner:
    """Fills sequences from the number of pieces of each length: exactly where the index of sums
    has what a length leaves, else by best fit."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.index = SumIndex(counts, capacity)
        self.left = self.index.left
        self.plan: list[tuple[tuple[int, ...], int]] = []

    def complement(self, first: int, size: int) -> tuple[int, ...] | None:
        """``size`` available lengths that fill exactly what ``first`` leaves."""
        gap = self.capacity - first
        if size == 1:
            return (gap,) if self.index.times((first, gap)) else None
        if size == 2:
            return next((pair for pair in self.index.pairs(gap) if self.index.times((first, *pair))), None)
        return self.index.triple(gap, first)

    def run(self, passes: tuple[tuple[int, ...], ...]) -> list[tuple[tuple[int, ...], int]]:
        """(lengths in order, number of such sequences).

        Each pass goes from the longest length to the shortest and fills up with as many
        others as the pass names, in that order; the rest is placed by best fit.
        """
        if n := int(self.left[self.capacity]):
            self.plan.append(((self.capacity,), n))
            self.index.take((self.capacity,), n)
        for sizes in passes:
            for first in range(self.capacity - 1, 0, -1):
                while self.left[first] and (rest := next(filter(None, (self.complement(first, size) for size in sizes)), None)):
                    combination = (first, *rest)
                    n = self.index.times(combination)
                    self.index.take(combination, n)
                    self.plan.append((combination, n))
        self.best_fit()
        return self.plan

    def best_fit(self) -> None:
        open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        room = np.zeros(self.capacity + 1, bool)

        def put(combination: tuple[int, ...], n: int) -> None:
            gap = self.capacity - sum(combination)
            if gap:
                open_bins.setdefault(gap, []).append((combination, n))
                room[gap] = True
            else:
                self.plan.append((combination, n))

        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            while n:
                fitting = np.flatnonzero(room[length:])
                if not len(fitting):
                    full, each = divmod(n, self.capacity // length)
                    if full:
                        put((length,) * (self.capacity // length), full)
                    if each:
                        put((length,) * each, 1)
                    break
                gap = int(fitting[0]) + length
                combination, bins = open_bins[gap].pop()
                used = min(n, bins)
                if used < bins:
                    open_bins[gap].append((combination, bins - used))
                room[gap] = bool(open_bins[gap])
                put((*combination, length), used)
                n -= used
        self.left[:] = 0
        self.plan.extend(entry for entries in open_bins.values() for entry in entries)


#: Passes that plans are tried with: all sizes at once, one size after the other, fewer sizes, best fit alone.
ORDERS = (((1, 2, 3),), ((1,), (2,), (3,)), ((1,), (2,)), ((1,),), ())


def smallest_plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The plan with the fewest sequences; the first of equally small ones.

    A plan depends on the counts alone, at most one for each length, so several cost
    little; triples that use up short pieces can cost more sequences than they fill.
    """
    plans = (Planner(counts, capacity).run(passes) for passes in ORDERS)
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def places(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, number of the first piece, first sequence, offset), sorted: pieces of
    a length take its rows' places one after the other."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for combination, times in plan:
        offset = 0
        for length in combination:
            rows.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    ``pieces`` has ``length`` from 1 to ``capacity``. Hot lengths are numbered in as many
    buckets as there are shuffle partitions, by a number drawn once per row. Input
    columns named ``sequence_id`` or ``offset`` are replaced; no pieces give no rows.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(
        pieces.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("record"), "length", F.rand(29).alias("u")).withColumn(
            "bucket", F.floor(F.col("u") * buckets).cast("int")
        )
    )
    counted = fixed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(smallest_plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = (
        fixed.withColumn("number", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("u")))
        .join(before, ["length", "bucket"])
        .select("record", "length", (F.col("number") - 1 + F.col("before")).alias("number"))
    )
    shift = np.int64(1 << 48)
    keys = table[:, 0] * shift + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (np.asarray(batch.column(i), np.int64) for i in (1, 2))
            at = np.searchsorted(keys, length * shift + number, side="right") - 1
            sequence = table[at, 2] + number - table[at, 1]
            columns = [batch.column(0), pa.array(sequence), pa.array(table[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=["record", "sequence_id", "offset"])

    kind = fixed.schema["record"].dataType.simpleString()
    out = numbered.mapInArrow(place, f"record {kind}, sequence_id bigint, offset bigint")
    return out.select(*[F.col("record").getField(c).alias(c) for c in kept], "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """All documents as pieces (``token_pieces``) with their places (``pack_pieces``)."""
    return pack_pieces(token_pieces(docs, vocabulary, capacity=capacity, **options), capacity)
