"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest

from pulsemill.llm import python_queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]


def brute_words(rows, least=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def edits(word):
    """Every word one edit away, by trying all letters at all places."""
    for i in range(len(word) + 1):
        for c in LETTERS:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        yield word[:i] + word[i + 1 :]


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        near = {x for x in edits(w) if x != w and x in counts}
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[w] = (best if best is not None and counts[best] >= 2 * n else None, n, len(near))
    rows = {}
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, near, counts[form] if form else None)
    return rows


def as_map(df):
    got = df.collect()
    made = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(made) == len(got)
    return made


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_variants(brute_words(rows))
    got = as_map(python_queries.op12_spelling(spark, folder))
    assert got == want
    assert sum(1 for v in want.values() if v[0]) > 50 and any(v[0] and v[1] != v[0] for v in want.values())


@pytest.mark.parametrize("held", [2, 200_000])
def test_odd_texts(spark, held):
    rnd = random.Random(1)
    words = ["straße", "Straßen", "École", "ÉCOLE", "×÷×÷×", "colour", "color", "colors", "abcde"]
    rows = [(i, " ".join(rnd.choices(words, k=30)) + "|x1colour9colour", "n", 1) for i in range(200)]
    rows += [(1, None, "", 0), (2, "", "", 0), (None, "colour colour colour", "", 0), (5, "ab " * 50_000 + "colour " * 50_000, "", 0)]
    rows += [(7, "zweimal zweimal", "", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(4)
    want = brute_words([r[:2] for r in rows])
    counted = spelling.count_words(docs, held=held)
    assert {r.word: r.n for r in counted.collect()} == want and "École".translate(LOWER) in want
    assert as_map(spelling.group_variants(counted)) == brute_variants(want)


def test_every_single_edit_is_found(spark):
    """All edits of words of all lengths, with ties and long chains of forms."""
    rnd = random.Random(3)
    counts = {}
    for length in (5, 6, 7, 8, 12, 31):
        base = "".join(rnd.choices("abé", k=length))
        for x in [base, *rnd.sample(list(edits(base)), 300)]:
            if len(x) >= 5:
                counts.setdefault(x, rnd.choice([3, 6, 6, 13, 40]))
    chain = "mountain"
    for i in range(12):
        counts[chain] = 3 << i
        chain = chain[:i % 8] + rnd.choice("xyz") + chain[i % 8 + 1 :]
    counted = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_map(spelling.group_variants(counted)) == brute_variants(counts)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "to be or not")], "doc_id long, text string")
    assert as_map(spelling.group_variants(spelling.count_words(docs))) == {}
    assert as_map(spelling.group_variants(spelling.count_words(docs.limit(0)))) == {}
    lone = spark.createDataFrame([("words", 9)], "word string, n long")
    assert as_map(spelling.group_variants(lone)) == {"words": (None, "words", 9, 0, None)}
    with pytest.raises(ValueError):
        spelling.group_variants(lone, lead=1)


def test_words_are_never_broadcast(spark, monkeypatch):
    """However small the files of the words are: the driver would hold them all."""
    made, cut = [], spelling.cut_lineage

    def kept(df):
        made.append(df)
        return cut(df)

    monkeypatch.setattr(spelling, "cut_lineage", kept)
    words = spark.createDataFrame([("colour", 40), ("color", 20), ("colors", 8), ("words", 5)], "word string, n long")
    made.append(spelling.group_variants(words))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in made]
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
