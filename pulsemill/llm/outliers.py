"""Quality rules on text statistics, and robust multivariate outliers among them.

Within each language and source the statistics of a text, transformed so that regular
texts lie close together, are rows of a point cloud. The minimum covariance determinant
finds the part of the cloud (three quarters of it) whose covariance has the least
determinant: from several starts, the rows nearest to the current estimate give the next
one until the determinant no longer falls. Mean and covariance of that part are not moved
by a quarter of irregular texts; what lies far from them by Mahalanobis distance goes.

Every round is one aggregation: rows are summed by group, start and a bucket of their
distance, so a group with a third of all rows is combined before it is sent and gives as
many rows as there are buckets. The nearest part is then the first buckets of a group.
Estimates stay in tables, however many sources there are. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class Feature:
    """A transformed statistic. ``spread`` is a standard deviation that regular texts may always
    have: it is added to what is measured, so a statistic that is nearly always 0 has no covariance of 0."""

    name: str
    sql: str
    spread: float


FEATURES = (
    Feature("length", "ln(greatest(n_words, 1))", 0.3),
    Feature("word length", "ln(greatest(word_chars, 1) / greatest(n_words, 1))", 0.1),
    Feature("symbols", "ln(1 + 100 * n_symbols / greatest(word_chars, 1))", 0.3),
    Feature("repeated words", "ln(1 + 100 * n_repeat_words / greatest(n_words, 1))", 0.7),
    Feature("repeated lines", "ln(1 + n_dup_lines)", 0.5),
)


@dataclass(frozen=True)
class Robust:
    """Parameters of the estimate.

    ``coverage``: share of a group that the least covariance is sought for. ``least_rows``:
    smaller groups are estimated together (see ``group_of``). ``cutoff``: largest squared
    distance that is kept; the quantile of chi-square with as many degrees of freedom as
    there are features: 50 has 1.4e-9 of regular rows above it with five.
    """

    coverage: float = 0.75
    least_rows: int = 50
    cutoff: float = 50.0
    rounds: int = 20
    settled: float = 0.01


#: Median and 0.975 quantile of chi-square with five degrees of freedom, and
#: what a covariance of the rows below that quantile is short of.
CHI_MEDIAN, CHI_HIGH, CUT_FACTOR = 4.351, 12.833, 1.055

#: Buckets for each e-fold of the squared distance, and for each unit of a feature.
DISTANCE_STEPS, FEATURE_STEPS = 16, 32


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` (long).

    Words are separated by white space of ASCII. ``n_dup_lines`` counts lines with a word
    that equal an earlier one; ``n_repeat_words`` counts words inside windows of three that
    occur twice or more in the text. Windows are known by 64-bit hashes. Null texts count as empty ones,
    whole texts are read, and nothing is shuffled. Input columns of these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    held = docs.select(
        *kept,
        F.array_remove(F.split(whole, SPACES), "").alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(whole, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    words, n = F.col("_words"), F.size("_words")
    windows = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    counted = held.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    covered = F.when(repeats, covered_words(F.col("_windows"))).otherwise(F.lit(0))
    return counted.withColumn("n_repeat_words", covered.cast("long")).drop("_windows")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, also where a lambda inside uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def covered_words(windows: Column) -> Column:
    """Number of words inside windows (of three words, by hash) that occur more than once."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(rows: Column) -> Column:
        def has_twin(row: Column, k: Column) -> Column:
            before, after = F.get(rows, k - 1)["h"], F.get(rows, k + 1)["h"]
            return F.coalesce(before == row["h"], F.lit(False)) | F.coalesce(after == row["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(rows, has_twin), lambda row: row["i"]))

    def covered(places: Column) -> Column:
        """Each window adds three words less those that the one before it covers."""
        fresh = F.transform(places, lambda p, k: F.coalesce(F.least(p - F.get(places, k - 1), F.lit(3)), F.lit(3)))
        return F.aggregate(fresh, F.lit(0), lambda a, b: a + b)

    return bound(bound(placed, repeated), covered)


def group_of(rows: DataFrame, by: list[str], least: int) -> DataFrame:
    """(*by, _group, _rows): which rows are estimated together, and how many they are.

    Groups of fewer than ``least`` rows are put together with the other small ones that
    share the first column of ``by``, and those that are still too few with all others;
    what is too few even then has no group. Nulls in ``by`` are a value like others.
    """
    level = rows.groupBy(*by).agg(F.count("*").alias("_n")).withColumn("_group", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
    for name in (F.to_json(F.struct(by[0]), {"ignoreNullFields": "false"}), F.lit("rest")):
        pooled = F.when(F.col("_n") < least, name).otherwise(F.col("_group"))
        level = level.withColumn("_group", pooled).withColumn("_n", F.sum("_n").over(Window.partitionBy("_group")))
    return level.where(F.col("_n") >= least).select(*by, "_group", F.col("_n").alias("_rows"))


def moments(features: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(features), 2))


def sums(features: int) -> list[Column]:
    """Count, sums and sums of products over feature columns ``x0`` and so on."""
    x = [F.col(f"x{i}") for i in range(features)]
    return [F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(features)], *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in moments(features)]]


def added_up(features: int) -> list[Column]:
    """The same from such sums."""
    names = ["n", *[f"s{i}" for i in range(features)], *[f"p{i}_{j}" for i, j in moments(features)]]
    return [F.sum(c).alias(c) for c in names]


def total(parts: list[str]) -> str:
    return " + ".join(parts) or "0D"


def estimate(summed: DataFrame, features: tuple[Feature, ...], keys: list[str], factor: float = 1.0) -> DataFrame:
    """Mean ``m``, whitening ``w`` and ``logdet`` from sums.

    The covariance (times ``factor``) plus the squares of the spreads is cut into a lower triangle
    times its transpose; ``w`` is the inverse of the triangle, row by row, so that a row's
    squared distance is the length of ``w`` times its difference from the mean.
    """
    k = range(len(features))
    own = {i: f"{features[i].spread ** 2!r}D" for i in k}
    df = summed.selectExpr(
        *keys,
        *[f"s{i} / n AS m{i}" for i in k],
        *[f"(p{i}_{j} / n - s{i} * s{j} / n / n) * {factor!r}D" + (f" + {own[i]}" if i == j else "") + f" AS c{j}_{i}" for i, j in moments(len(features))],
    )
    for j in k:
        # The spreads keep this positive; the bound is for rounding.
        rest = total([f"l{j}_{q} * l{j}_{q}" for q in range(j)])
        df = df.selectExpr("*", f"sqrt(greatest(c{j}_{j} - ({rest}), {own[j]} / 2)) AS l{j}_{j}")
        below = [(i, total([f"l{i}_{q} * l{j}_{q}" for q in range(j)])) for i in k if i > j]
        df = df.selectExpr("*", *[f"(c{i}_{j} - ({sum_})) / l{j}_{j} AS l{i}_{j}" for i, sum_ in below])
    for i in k:
        left = [(j, total([f"l{i}_{q} * w{q}_{j}" for q in range(j, i)])) for j in range(i)]
        df = df.selectExpr("*", f"1D / l{i}_{i} AS w{i}_{i}", *[f"-({sum_}) / l{i}_{i} AS w{i}_{j}" for j, sum_ in left])
    return df.selectExpr(
        *keys,
        f"array({', '.join(f'm{i}' for i in k)}) AS m",
        f"array({', '.join(f'w{i}_{j}' for i in k for j in range(i + 1))}) AS w",
        f"2 * ({total([f'ln(l{i}_{i})' for i in k])}) AS logdet",
    )


def distance(k: int) -> Column:
    """Squared distance of columns ``x0`` and so on from columns ``m`` and ``w``."""
    place = {(i, j): i * (i + 1) // 2 + j for i in range(k) for j in range(i + 1)}
    rows = [total([f"w[{place[i, j]}] * (x{j} - m[{j}])" for j in range(i + 1)]) for i in range(k)]
    return F.expr(total([f"power({row}, 2)" for row in rows]))


def bucket(squared: Column) -> Column:
    return F.floor(F.ln(squared + F.lit(1e-9)) * DISTANCE_STEPS).cast("int")


def nearest(bucketed: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The buckets of each group, nearest first, that are needed for ``share`` of its rows."""
    order = Window.partitionBy(*keys).orderBy("bucket")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("n").over(Window.partitionBy(*keys))
    return bucketed.withColumns({"_before": before, "_every": every}).where(F.col("_before") < F.lit(share) * F.col("_every")).drop("_before", "_every")


def quantile(bucketed: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    """The bucket that the given share of each group's rows is reached in."""
    return nearest(bucketed, keys, share).groupBy(*keys).agg(F.max("bucket").alias(name))


def first_estimates(points: DataFrame, features: tuple[Feature, ...]) -> DataFrame:
    """Two starts for each group: medians and quartile ranges, and mean and covariance of all rows."""
    k = len(features)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(f"x{i}") * FEATURE_STEPS).cast("int").alias("bucket")) for i in range(k)]))
    counted = cut_lineage(
        points.select("_group", values.alias("v")).select("_group", "v.i", "v.bucket").groupBy("_group", "i", "bucket").agg(F.count("*").alias("n"))
    )
    keys = ["_group", "i"]
    middle = quantile(counted, keys, 0.25, "low").join(quantile(counted, keys, 0.5, "mid"), keys).join(quantile(counted, keys, 0.75, "high"), keys)

    def each(value: Column) -> list[Column]:
        return [F.max(F.when(F.col("i") == i, value)) for i in range(k)]

    # A quartile range is 1.349 standard deviations of a normal distribution.
    deviation = (F.col("high") - F.col("low")) / F.lit(FEATURE_STEPS * 1.349)
    wide = middle.groupBy("_group").agg(
        F.array(*each((F.col("mid") + 0.5) / FEATURE_STEPS)).alias("m"), F.array(*each(deviation)).alias("d")
    )
    weights = []
    for i, feature in enumerate(features):
        d = F.get("d", F.lit(i))
        weights += [F.lit(0.0)] * i + [1.0 / F.sqrt(d * d + F.lit(feature.spread ** 2))]
    plain = wide.select("_group", F.lit("medians").alias("_start"), "m", F.array(*weights).alias("w"), F.lit(float("inf")).alias("logdet"))
    classic = estimate(points.groupBy("_group").agg(*sums(k)), features, ["_group"]).select("_group", F.lit("all rows").alias("_start"), "m", "w", F.lit(float("inf")).alias("logdet"))
    return plain.unionByName(classic)


def by_distance(points: DataFrame, estimates: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Sums of each group's rows by the bucket of their distance."""
    placed = points.join(estimates.select(*keys, "m", "w"), "_group").withColumn("bucket", bucket(distance(k)))
    return placed.groupBy(*keys, "bucket").agg(*sums(k))


def minimum_covariance(points: DataFrame, features: tuple[Feature, ...] = FEATURES, robust: Robust = Robust()) -> DataFrame:
    """(_group, m, w): robust mean and whitening of each group. ``points``: (_group, x0, x1, ...).

    A start goes on while a round lowers its log determinant by more than ``settled``, for at
    most ``rounds``; the one that ends lowest wins. It is scaled so that the median distance
    is that of chi-square (never down), and estimated anew once from the rows inside the
    0.975 quantile.
    """
    k, keys = len(features), ["_group", "_start"]
    current = cut_lineage(first_estimates(points, features))
    settled = []
    for _ in range(robust.rounds):
        near = nearest(by_distance(points, current, keys, k), keys, robust.coverage)
        found = estimate(near.groupBy(*keys).agg(*added_up(k)), features, keys)
        held = current.select(*keys, F.struct("m", "w", "logdet").alias("held"))
        fell = F.col("held.logdet") - F.col("logdet") > robust.settled
        both = cut_lineage(found.join(held, keys).select(*keys, "held", F.struct("m", "w", "logdet").alias("found"), fell.alias("fell")))
        settled.append(both.where("NOT fell").select(*keys, "held.*"))
        current = both.where("fell").select(*keys, "found.*")
        if current.isEmpty():
            break
    for part in settled:
        current = current.unionByName(part)
    first = Window.partitionBy("_group").orderBy("logdet", "_start")
    best = cut_lineage(current.withColumn("place", F.row_number().over(first)).where("place = 1").select("_group", "m", "w"))
    counted = cut_lineage(by_distance(points, best, ["_group"], k))
    scaled = with_median(best, counted)
    inner = by_distance(points, scaled, ["_group"], k).where(F.col("bucket") < F.floor(F.ln(F.lit(CHI_HIGH)) * DISTANCE_STEPS))
    again = cut_lineage(estimate(inner.groupBy("_group").agg(*added_up(k)), features, ["_group"], CUT_FACTOR).select("_group", "m", "w"))
    return cut_lineage(with_median(again, by_distance(points, again, ["_group"], k)))


def with_median(estimates: DataFrame, bucketed: DataFrame) -> DataFrame:
    """``estimates`` with the whitening scaled to a median distance of at most that of chi-square."""
    middle = quantile(bucketed, ["_group"], 0.5, "mid")
    ratio = F.greatest(F.exp((F.col("mid") + 0.5) / DISTANCE_STEPS) / CHI_MEDIAN, F.lit(1.0))
    return estimates.join(middle, "_group").select("_group", "m", F.transform("w", lambda x: x / F.sqrt(ratio)).alias("w"))


def mark_outliers(
    rows: DataFrame, regular: Column, by: list[str], features: tuple[Feature, ...] = FEATURES, robust: Robust = Robust(), into: str = "is_outlier"
) -> DataFrame:
    """``rows`` with ``into``: whether a row lies far from the regular ones of its group.

    Estimates are made from the rows where ``regular`` holds, by the columns ``by`` (the first one is
    what small groups are pooled by); other rows are never marked, nor are those of a
    group without an estimate. Rows are read several times: hand in a table. Repeated rows each count.
    An empty table gives an empty one. An input column named ``into`` is replaced.
    """
    known = [c for c in rows.columns if c != into]
    judged = [F.struct(*[F.col(f"`{c}`") for c in known]).alias("_row"), F.coalesce(regular, F.lit(False)).alias("_regular")]
    vectors = rows.select(
        *judged, *[F.col(f"`{c}`").alias(f"_by{i}") for i, c in enumerate(by)], *[F.expr(f.sql).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    )
    keys = [f"_by{i}" for i in range(len(by))]
    xs = [f"x{i}" for i in range(len(features))]
    used = vectors.where("_regular").select(*keys, *xs)
    groups = cut_lineage(group_of(used, keys, robust.least_rows))

    def placed(frame: DataFrame, how: str) -> DataFrame:
        same = [F.col(f"v.{c}").eqNullSafe(F.col(f"g.{c}")) for c in keys]
        return frame.alias("v").join(groups.alias("g"), same, how).drop(*[F.col(f"g.{c}") for c in keys])

    points = cut_lineage(placed(used, "inner").select("_group", *xs))
    estimates = minimum_covariance(points, features, robust)
    far = distance(len(features)) > robust.cutoff
    return (
        placed(vectors, "left")
        .join(estimates, "_group", "left")
        .select("_row.*", (F.col("_regular") & F.coalesce(far, F.lit(False))).alias(into))
    )


def base_failed() -> Column:
    """Whether a text is too short or repeats itself, by its statistics."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_texts(docs: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source"), robust: Robust = Robust()) -> DataFrame:
    """``docs`` without ``text``, with the statistics, ``base_failed`` and ``kept``.

    A text is kept if it does not fail the base rules and is no outlier of its language and
    source. Statistics are worked out once and written to the shared folder.
    """
    stated = cut_lineage(text_statistics(docs, text).drop(text).withColumn("base_failed", base_failed()))
    marked = mark_outliers(stated, ~F.col("base_failed"), list(by), robust=robust)
    return marked.withColumn("kept", ~F.col("base_failed") & ~F.col("is_outlier"))
