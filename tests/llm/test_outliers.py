"""Text statistics by brute force, and the robust estimate against numpy."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pulsemill.llm import native_queries, outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
K = len(outliers.FEATURES)
SPREAD = np.diag([f.spread**2 for f in outliers.FEATURES])


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[words[i], words[i + 1], words[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def fails(n_words, n_repeat):
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def squared(x, m, cov):
    d = x - m
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def buckets(d):
    return np.floor(np.log(d + 1e-9) * outliers.DISTANCE_STEPS)


def share_below(values, share):
    """The bucket that holds the given share of all values."""
    return sorted(values)[max(0, int(np.ceil(share * len(values))) - 1)]


def robust(x, settings):
    """The estimate with numpy: (mean, covariance)."""
    bins = np.floor(x * outliers.FEATURE_STEPS)
    low, mid, high = ([share_below(bins[:, i], q) for i in range(K)] for q in (0.25, 0.5, 0.75))
    deviation = (np.array(high) - np.array(low)) / (outliers.FEATURE_STEPS * 1.349)
    starts = {
        "medians": ((np.array(mid) + 0.5) / outliers.FEATURE_STEPS, np.diag(deviation**2) + SPREAD),
        "all rows": (x.mean(0), np.cov(x.T, bias=True) + SPREAD),
    }
    ended = {}
    for name, (m, cov) in starts.items():
        held = (np.inf, m, cov)
        for _ in range(settings.rounds):
            b = buckets(squared(x, held[1], held[2]))
            near = x[b <= share_below(b, settings.coverage)]
            cov = np.cov(near.T, bias=True) + SPREAD
            found = (np.linalg.slogdet(cov)[1], near.mean(0), cov)
            if not held[0] - found[0] > settings.settled:
                break
            held = found
        ended[name] = held
    _, m, cov = ended[min(ended, key=lambda s: (ended[s][0], s))]

    def scaled(m, cov):
        b = share_below(buckets(squared(x, m, cov)), 0.5)
        return cov * max(1.0, np.exp((b + 0.5) / outliers.DISTANCE_STEPS) / outliers.CHI_MEDIAN)

    cov = scaled(m, cov)
    inner = x[buckets(squared(x, m, cov)) < np.floor(np.log(outliers.CHI_HIGH) * outliers.DISTANCE_STEPS)]
    m, cov = inner.mean(0), np.cov(inner.T, bias=True) * outliers.CUT_FACTOR + SPREAD
    return m, scaled(m, cov)


@pytest.fixture(scope="module")
def clouds(spark):
    """Three groups of points; a fifth of one lies far away, in a direction that no single column shows."""
    rng = np.random.default_rng(5)
    out = {}
    for name, n in (("a", 900), ("b", 300), ("c", 80)):
        mix = rng.normal(size=(K, K)) * 0.4
        out[name] = rng.normal(size=(n, K)) @ mix + rng.normal(size=K) * 3
    away = out["a"][:180].copy()
    away[:, 0] += 6
    away[:, 1] -= 6
    out["a"][:180] = away
    out["b"][:, 4] = 0.0
    rows = [(g, *map(float, p)) for g, x in out.items() for p in x]
    return out, spark.createDataFrame(rows, "_group string, " + ", ".join(f"x{i} double" for i in range(K))).repartition(5)


def test_estimates_equal_numpy(clouds):
    out, points = clouds
    settings = outliers.Robust()
    got = {r._group: r for r in outliers.minimum_covariance(points).collect()}
    assert set(got) == set(out)
    for g, x in out.items():
        m, cov = robust(x, settings)
        w = np.zeros((K, K))
        w[np.tril_indices(K)] = got[g].w
        assert np.allclose(got[g].m, m, atol=1e-6)
        assert np.allclose(np.linalg.inv(w.T @ w), cov, rtol=1e-5, atol=1e-8)
    # The planted fifth does not move the estimate, as it does the plain mean.
    clean = out["a"][180:]
    far = squared(out["a"], *robust(out["a"], settings))
    assert (far[:180] > settings.cutoff).all() and (far[180:] < settings.cutoff).all()
    assert np.abs(np.array(got["a"].m) - clean.mean(0)).max() < 0.15


def test_statistics_of_odd_texts(spark):
    rnd = random.Random(6)
    texts = [None, "", " \n\t", "a", "a a a a", "a b a b a b", "one\ntwo\none\n \n \ntwo", "ü#|x\x0bß <y>\x1f z", "a b c d a b c", "#" * 40, "a b c d"]
    texts += ["".join(rnd.choices(["a ", "b ", "c\n", "é\t", "# ", "a b c\n", "\x0b"], k=rnd.randrange(90))) for _ in range(300)]
    texts.append(" ".join(rnd.choices(["x", "y", "zz"], k=40_000)))
    rows = [(i, t, "old", 9) for i, t in enumerate(texts)] + [(5, texts[5], "old", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, i int")
    got = outliers.text_statistics(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == statistics(r.text), r.text
    assert outliers.text_statistics(docs.limit(0)).collect() == []


def prose(rnd, words, bad=False):
    text = " ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(words))
    return text.replace(" ", "##$ ") if bad else text


@pytest.mark.parametrize("sources", [3, 40])
def test_irregular_texts_go_and_regular_ones_stay(spark, sources):
    """Few large groups, and many small ones that are pooled by language."""
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        lang = "en" if i % 3 else None
        rows.append((i, prose(rnd, rnd.randint(60, 400), bad=i % 10 == 0), lang, f"s{i % sources}", "x"))
    rows += [(1000, None, "en", "s1", "x"), (1001, "", None, None, "x"), (1002, "same words here " * 40, "en", "s1", "x"), (1003, "short", "en", "s0", "x")]
    rows += [(1004, prose(rnd, 12_000), "en", "s1", "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string").repartition(4)
    got = outliers.judge_texts(docs)
    assert got.columns[:3] == ["doc_id", "lang", "source"] and got.columns.count("kept") == 1
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (1000, 1001, 1002, 1003):
            assert r.base_failed and not r.kept and not r.is_outlier
        else:
            assert not r.base_failed and r.kept == (r.doc_id == 1004 or r.doc_id % 10 != 0), r


def test_too_few_texts_are_not_judged(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 80, bad=i == 0), "en", "s") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in outliers.judge_texts(docs).collect())
    assert outliers.judge_texts(docs.limit(0)).collect() == []
    alike = spark.createDataFrame([(i, rows[1][1], "en", "s") for i in range(200)], docs.schema)
    assert all(r.kept for r in outliers.judge_texts(alike).collect())


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in native_queries.op11_quality_rules(spark, folder).collect()}
    stated = {i: statistics(d.text) for i, d in docs.items()}
    # Sources of fewer than 50 regular texts are pooled by language, languages likewise.
    regular = [i for i, s in stated.items() if not fails(s[0], s[4])]
    by = Counter((docs[i].lang, docs[i].source) for i in regular)
    group = {i: (docs[i].lang, docs[i].source) if by[docs[i].lang, docs[i].source] >= 50 else docs[i].lang for i in regular}
    sizes = Counter(group.values())
    group = {i: g if sizes[g] >= 50 else "rest" for i, g in group.items()}
    sizes = Counter(group.values())
    x = {i: np.array([np.log(s[0]), np.log(s[1] / s[0]), np.log(1 + 100 * s[2] / s[1]), np.log(1 + 100 * s[4] / s[0]), np.log(1 + s[3])]) for i, s in stated.items() if i in group}
    kept = {}
    for g in sizes:
        ids = [i for i in regular if group[i] == g]
        cloud = np.array([x[i] for i in ids])
        far = squared(cloud, *robust(cloud, outliers.Robust())) if len(ids) >= 50 else np.zeros(len(ids))
        kept |= {i: bool(d <= 50) for i, d in zip(ids, far)}
    assert set(got) == set(docs)
    for i, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stated[i]
        assert r.base_failed == (i not in group) and r.kept == kept.get(i, False)
    assert not all(kept.values())


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = outliers.text_statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
