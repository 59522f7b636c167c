"""Fill-in-the-middle: rotations, exact round trips, odd texts."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsemill.llm import fill_middle as fim
from pulsemill.llm import python_queries

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKS = fim.Sentinels()


def expected(doc_id, text):
    """The output by slices and joins."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("step", [1, 3, 1 << 16])
def test_rotation_exchanges_blocks(step, monkeypatch):
    monkeypatch.setattr(fim, "STEP_BYTES", step)
    for start in range(3):
        for left in range(6):
            for right in range(6):
                raw = bytes(range(20))
                buffer = bytearray(raw)
                cut, stop = start + left, start + left + right
                fim.rotate(buffer, start, cut, stop)
                assert bytes(buffer) == raw[:start] + raw[cut:stop] + raw[start:cut] + raw[stop:]
                fim.rotate(buffer, start, start + right, stop)
                assert bytes(buffer) == raw


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aé<PSM> \t\n\x0b\x1f 😀", max_size=40), st.integers(0, 10**6), st.integers(0, 10**6), st.sampled_from(["psm", "spm"]))
def test_any_cut_is_undone(text, a, b, form):
    raw = text.encode()
    assert [raw[x:y].decode() for x, y in zip([0, *fim.unit_ends(raw)], fim.unit_ends(raw))] == UNITS.findall(text)
    # The marks must not occur in the text, but any beginning of one may.
    if not MARKS.occur_in(raw):
        first, second = sorted((a % (len(raw) + 1), b % (len(raw) + 1)))
        assert fim.restore(bytes(fim.arrange(raw, first, second, form, MARKS)), form, MARKS) == raw


def test_marks_that_could_be_confused_are_refused():
    for marks in ((b"<P>", b"<P>", b"<M>"), (b"", b"<S>", b"<M>"), (b"aa", b"b", b"c"), (b"<", b"<S>", b"<M>")):
        with pytest.raises(ValueError):
            fim.Sentinels(*marks)
    assert fim.restore(bytes(fim.arrange(b"one two three", 4, 8, "psm", fim.Sentinels(b"\x01", b"\x02", b"\x03"))), "psm", fim.Sentinels(b"\x01", b"\x02", b"\x03")) == b"one two three"


@pytest.mark.parametrize("batch", [1, 1 << 24])
def test_odd_rows(spark, batch, monkeypatch):
    monkeypatch.setattr(fim, "BATCH_BYTES", batch)
    rnd = random.Random(2)
    texts = [None, "", " ", "\n\t\x0b", "word", " word ", "a <P> b", "<S>", "x<M>", "<<P", "é ü 😀 ß", "a b c"]
    texts += [" ".join(rnd.choices(["one", "zwö", "<", "S>", "\n", "P>"], k=rnd.randrange(60))) for _ in range(120)]
    texts.append("long word " * 300_000)
    rows = [(i, t, "mine", 7) for i, t in enumerate(texts)] + [(3, texts[20], "again", 1), (3, texts[20], "again", 1), (None, "no id here at all", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3)
    made = fim.fill_middle(docs)
    got = fim.restore_text(made).collect()
    assert made.columns == ["doc_id", "text", "n", "output", "form", "n_units", "prefix_chars", "middle_chars"]
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.restored == (r.text or "")
    assert fim.restore_text(fim.fill_middle(docs.limit(0))).collect() == []


def test_shares_are_followed(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one two three four' AS text")
    some = {s: fim.fill_middle(docs, shares=s).groupBy("form").count().collect() for s in (fim.Shares(1, 0, 80), fim.Shares(1, 100, 0), fim.Shares(1, 100, 25))}
    none, all_psm, mixed = (dict(map(tuple, rows)) for rows in some.values())
    assert none == {"plain": 4000} and all_psm == {"psm": 4000}
    assert 800 < mixed["spm"] < 1200 and mixed["spm"] + mixed["psm"] == 4000


def test_query_keeps_every_document(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in python_queries.op13_fill_middle(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n, form, prefix, middle, output = expected(d.doc_id, d.text)
        r = got[d.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
