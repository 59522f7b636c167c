"""Quality scores from a factorisation machine.

A text becomes a sparse row of hashed words (share of the text, in the Euclidean norm),
structure statistics in bins, and a bin of its recorded length. The machine adds to a
linear model the interaction of every two features as a product of low-rank vectors;
with the sum-of-squares identity a row is scored in time linear in its features:
half the sum over factors of (sum of v x) squared minus the sum of (v x) squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.bytewords import Powers, Words, blocks

WORD_BUCKETS = 2048
BINS = 10
RANK = 8
#: Most labelled rows that a model is fitted on; the ones with the smallest hash of their id.
SAMPLE_ROWS = 8_000
EPOCHS = 8
BATCH = 128
#: Small samples are gone through more often, for so many steps at least.
LEAST_STEPS = 600
RATE = 0.02
DECAY = 1e-5

# Shares are binned on these borders, averages on powers of two.
SHARES = np.array([0.001, 0.01, 0.03, 0.08, 0.16, 0.3, 0.5, 0.7, 0.9])
SHARE_STATS = ("upper", "digit", "punctuation", "space", "high", "bar", "marked", "repeated", "new_words", "top_word", "lines", "capital")
SIZE_STATS = ("bytes", "words", "word_bytes", "line_bytes", "recorded")
FEATURES = WORD_BUCKETS + (len(SHARE_STATS) + 2 * len(SIZE_STATS)) * BINS

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
MARKED = np.zeros(256, bool)
MARKED[list(b"!#$%&*|<>{}\\^~@=+_")] = True


@dataclass(frozen=True)
class Rows:
    """Sparse rows: those of row i are ``index[bounds[i]:bounds[i + 1]]``."""

    index: np.ndarray
    value: np.ndarray
    bounds: np.ndarray


def features(texts: list[str | None], recorded: list[int | None]) -> Iterator[Rows]:
    """Rows of whole texts, in order. Empty texts have only the lowest bins."""
    powers = Powers()
    for first, raw in blocks(texts):
        yield block_features(raw, recorded[first : first + len(raw)], powers)


def block_features(raw: list[bytes], recorded: list[int | None], powers: Powers) -> Rows:
    words, n = Words(raw, powers), len(raw)
    begin = np.concatenate([[0], words.ends[:-1]])
    size = words.ends - begin - 1

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[words.bytes])])
        return total[words.ends - 1] - total[begin]

    n_words = np.diff(words.first)
    bucket = (words.hash >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS
    keys, counts = np.unique(words.doc * WORD_BUCKETS + bucket, return_counts=True)
    key_doc = keys // WORD_BUCKETS
    norm = np.sqrt(np.bincount(key_doc, counts.astype(float) ** 2, n))
    weight = counts / norm[key_doc]

    # Distinct words and the commonest one.
    order = np.lexsort((words.hash, words.doc))
    h, d = words.hash[order], words.doc[order]
    change = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])) if len(h) else np.empty(0, int)
    runs = np.diff(np.concatenate([change, [len(h)]]))
    distinct = np.bincount(d[change], minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, d[change], runs)
    twice = np.bincount(d[change], np.where(runs > 1, runs, 0), n)
    capital = np.bincount(words.doc[UPPER[words.bytes[words.start]]], minlength=n)
    newline = np.zeros(256, bool)
    newline[10] = True
    high = np.zeros(256, bool)
    high[128:] = True
    bar = np.zeros(256, bool)
    bar[124] = True
    lines = count(newline)
    letters = np.maximum(size, 1)
    of_words = np.maximum(n_words, 1)
    shares = np.stack(
        [
            count(UPPER) / letters,
            count(DIGIT) / letters,
            count(PUNCTUATION) / letters,
            count(SPACE) / letters,
            count(high) / letters,
            count(bar) / letters,
            count(MARKED) / letters,
            twice / of_words,
            distinct / of_words,
            top / of_words,
            lines / letters * 10,
            capital / of_words,
        ]
    )
    known = np.array([r if r is not None and r > 0 else 0 for r in recorded], float)
    sizes = np.log2(1 + np.stack([size, n_words, size / of_words, size / (lines + 1), known]).astype(float))
    share_at = np.searchsorted(SHARES, shares) + (np.arange(len(shares)) * BINS)[:, None]
    size_at = np.minimum(sizes.astype(int), 2 * BINS - 1) + (np.arange(len(sizes)) * 2 * BINS)[:, None]
    stats = WORD_BUCKETS + np.concatenate([share_at, len(SHARE_STATS) * BINS + size_at]).T

    width = stats.shape[1]
    per_row = np.bincount(key_doc, minlength=n) + width
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    index, value = np.empty(bounds[-1], np.int32), np.ones(bounds[-1], np.float32)
    own = np.arange(len(keys)) + key_doc * width
    index[own], value[own] = keys % WORD_BUCKETS, weight
    rest = (bounds[1:] - width)[:, None] + np.arange(width)
    index[rest] = stats
    return Rows(index, value, bounds)


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, rows: Rows) -> np.ndarray:
        """Probability of label 1 for each row, by the sum-of-squares identity."""
        x, v = rows.value.astype(float), self.factors[rows.index]
        starts = rows.bounds[:-1]
        vx = v * x[:, None]
        total = np.add.reduceat(vx, starts) if len(starts) else np.zeros((0, v.shape[1]))
        squares = np.add.reduceat(vx * vx, starts) if len(starts) else total
        plain = np.add.reduceat(self.linear[rows.index] * x, starts) if len(starts) else np.zeros(0)
        z = self.bias + plain + 0.5 * (total**2 - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], *, rank: int = RANK, epochs: int = EPOCHS, seed: int = 3) -> Machine:
    """Adam on the logistic loss over (index, value, target) rows; the result depends on the rows and the seed alone.

    Without rows the machine scores one half everywhere.
    """
    random = np.random.default_rng(seed)
    linear, factors = np.zeros(FEATURES, np.float32), random.normal(0, 0.05, (FEATURES, rank)).astype(np.float32)
    if not rows:
        return Machine(0.0, linear, np.zeros_like(factors))
    y = np.array([t for _, _, t in rows], np.float32)
    share = min(max(y.mean(), 0.01), 0.99)
    bias = float(np.log(share / (1 - share)))
    state = [np.zeros((2, *p.shape), np.float32) for p in (linear, factors)]
    step = 0
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // len(rows)))
    for epoch in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            picked = order[at : at + BATCH]
            x = np.zeros((len(picked), FEATURES), np.float32)
            for i, r in enumerate(picked):
                x[i, rows[r][0]] = rows[r][1]
            total = x @ factors
            z = bias + x @ linear + 0.5 * ((total**2).sum(1) - ((x * x) @ (factors * factors)).sum(1))
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[picked]) / len(picked)
            weighted = x * error[:, None]
            by_factors = weighted.T @ total - factors * (x * weighted).sum(0)[:, None] + DECAY * factors
            by_linear = weighted.sum(0) + DECAY * linear
            step += 1
            rate = np.float32(RATE * (1 - epoch / epochs))
            for p, g, s in zip((linear, factors), (by_linear, by_factors), state):
                s[0] += 0.1 * (g - s[0])
                s[1] += 0.01 * (g * g - s[1])
                p -= rate * (s[0] / np.float32(1 - 0.9**step)) / (np.sqrt(s[1] / np.float32(1 - 0.99**step)) + np.float32(1e-8))
            bias -= rate * error.sum()
    return Machine(float(bias), linear, factors)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """Rows that no model may learn a label from; those without an id are among them."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id", text: str = "text", recorded: str | None = "n_chars", sample_rows: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Features and targets of at most ``sample_rows`` labelled documents outside the held-out fold.

    A document with several labels counts with their mean; null labels do not count.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .where(~held_out(doc_id))
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.avg(F.col(label).cast("double")).alias("target"))
    )
    # Bounded by sample_rows, hence fit for a broadcast.
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), (F.col(recorded) if recorded in docs.columns else F.lit(None)).cast("long").alias("recorded"))
    sample = rows.join(F.broadcast(picked), "id").select("id", "text", "recorded", "target")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = 0
            for found in features(texts, lengths):
                n = len(found.bounds) - 1
                parts = [slice(found.bounds[i], found.bounds[i + 1]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        pa.array([found.index[p].astype("<i2").tobytes() for p in parts], pa.binary()),
                        pa.array([found.value[p].astype("<f4").tobytes() for p in parts], pa.binary()),
                        batch.column(3).slice(at, n),
                    ],
                    names=["id", "index", "value", "target"],
                )
                at += n

    kind = dict(sample.dtypes)["id"]
    made = sample.mapInArrow(rows_of, f"id {kind}, index binary, value binary, target double")
    collected = made.groupBy("id").agg(F.first("index").alias("index"), F.first("value").alias("value"), F.first("target").alias("target")).collect()
    collected.sort(key=lambda r: r.id)
    return [(np.frombuffer(r["index"], "<i2"), np.frombuffer(r.value, "<f4"), r.target) for r in collected]


def score(docs: DataFrame, machine: Machine, *, text: str = "text", recorded: str | None = "n_chars", into: str = "score") -> DataFrame:
    """``docs`` with ``into``: the machine's probability of label 1 for each row.

    Every row is scored, null and empty texts as texts without words, repeated rows
    alike. An input column of that name is replaced, other columns stay. The model has
    a fixed size and goes along with the task.
    """
    kept = [c for c in docs.columns if c != into]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text)).to_pylist()
            lengths = batch.column(names.index(recorded)).to_pylist() if recorded in names else [None] * len(texts)
            scores = [machine.scores(rows) for rows in features(texts, lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *scores]))], names=[*names, into])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes if c != into)
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(work, f"{fields}, `{into}` double")


def train(docs: DataFrame, labels: DataFrame, **options) -> Machine:
    """A machine for ``label`` from the labelled documents outside the held-out fold."""
    return fit(training_rows(docs, labels, **options))
