"""Fill-in-the-middle training texts by block rotation inside one buffer.

A text is cut at two places between its units (a word with the white space before it, or
white space at the end). Sentinels are inserted at the cuts of a ``bytearray``, which
leaves prefix, middle and suffix in reading order, each behind its sentinel; the order to
be trained on is reached by exchanging two neighbouring blocks in place: both are reversed
and then the whole. The same rotation leads back, so a text is restored from its output
and form alone. Nothing is shuffled; a text costs its own size and one buffer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsemill.llm.bytewords import SPACE

PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bytes that a reversal exchanges at a time, and bytes of text in a batch that is handed on.
STEP_BYTES = 1 << 16
BATCH_BYTES = 16 << 20


@dataclass(frozen=True)
class Sentinels:
    """Marks in front of the three parts.

    None may begin inside another or inside itself, so that a mark next to text is found
    where it was put: the first byte of each occurs nowhere else in any of them.
    """

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or not all(marks) or any(m[0] in other[1:] for m in marks for other in marks):
            raise ValueError("sentinels must differ and must not begin inside one another")
        if any(a != b and b.startswith(a) for a in marks for b in marks):
            raise ValueError("no sentinel may be the beginning of another")

    def occur_in(self, raw: bytes | bytearray) -> bool:
        return any(m in raw for m in (self.prefix, self.suffix, self.middle))


@dataclass(frozen=True)
class Shares:
    """How the forms are drawn: ``changed`` in 100 texts are cut, of these ``spm`` in 100 put the suffix first."""

    seed: int = 42
    changed: int = 50
    spm: int = 80


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2^32 from the digest of seed and id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def unit_ends(raw: bytes) -> np.ndarray:
    """Where each unit of the text ends: at the end of a word, and at the end of the text."""
    space = SPACE[np.frombuffer(raw, np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(raw)) if len(raw) else ends


def reverse(view: np.ndarray, start: int, stop: int) -> None:
    """Reverse ``view[start:stop]`` in place, from both ends inwards."""
    while stop - start > 1:
        n = min((stop - start) // 2, STEP_BYTES)
        left = view[start : start + n].copy()
        view[start : start + n] = view[stop - n : stop][::-1]
        view[stop - n : stop] = left[::-1]
        start, stop = start + n, stop - n


def rotate(buffer: bytearray, start: int, cut: int, stop: int) -> None:
    """Exchange the blocks ``start:cut`` and ``cut:stop`` of the buffer in place."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, start, cut)
    reverse(view, cut, stop)
    reverse(view, start, stop)


def arrange(raw: bytes, first: int, second: int, form: str, marks: Sentinels) -> bytearray:
    """The text with sentinels, its parts in the order of ``form``; cuts are byte places."""
    buffer = bytearray(raw)
    buffer[second:second] = marks.suffix
    buffer[first:first] = marks.middle
    buffer[0:0] = marks.prefix
    middle = first + len(marks.prefix)
    suffix = second + len(marks.prefix) + len(marks.middle)
    # prefix, middle, suffix -> prefix, suffix, middle or suffix, prefix, middle
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes, form: str, marks: Sentinels) -> bytes:
    """The text that ``arrange`` was given."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    middle = buffer.index(marks.middle)
    if form == PSM:
        rotate(buffer, buffer.index(marks.suffix), middle, len(buffer))
    else:
        # suffix | prefix, middle -> prefix, middle | suffix
        rotate(buffer, 0, buffer.index(marks.prefix), len(buffer))
    for mark in (marks.suffix, marks.middle, marks.prefix):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def code_points(raw: bytes) -> int:
    """Bytes that do not continue a character."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def transform(raw: bytes, drawn: list[int], shares: Shares, marks: Sentinels) -> tuple[bytes, str, int, int | None, int | None]:
    """(output, form, units, code points of the prefix, of the middle) of one text."""
    ends = unit_ends(raw)
    n = len(ends)
    if not raw or drawn[2] % 100 >= shares.changed or marks.occur_in(raw):
        return raw, PLAIN, n, None, None
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted(d % (n + 1) for d in drawn[:2]))
    form = SPM if drawn[3] % 100 < shares.spm else PSM
    output = arrange(raw, first, second, form, marks)
    return bytes(output), form, n, code_points(raw[:first]), code_points(raw[first:second])


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of each text; null is empty."""
    return (b"" if x is None else x for x in column.cast(pa.binary()).to_pylist())


def fill_middle(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shares: Shares = Shares(), marks: Sentinels = Sentinels()
) -> DataFrame:
    """``docs`` with ``output``, ``form`` (plain, psm, spm), ``n_units``, ``prefix_chars`` and ``middle_chars``.

    A text stays as it is (form plain, counts of characters null) if it is empty or null,
    contains a sentinel, or is not drawn. Draws depend on seed and id alone, so repeated rows
    and rows with the same or a null id are cut alike, and any text can be made again. Whole
    texts are read however long they are. Input columns with the names of the results are
    replaced, all others kept. An empty table gives an empty one.
    """
    made = {"output": pa.string(), "form": pa.string(), "n_units": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
    kept = [c for c in docs.columns if c not in made]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held, start = [], 0, 0

            def handed_on(stop: int) -> pa.RecordBatch:
                columns = [batch.column(c).slice(start, stop - start) for c in kept]
                results = [pa.array(values, kind if kind != pa.string() else pa.binary()) for values, kind in zip(zip(*rows), made.values())]
                results = [r.cast(kind) for r, kind in zip(results, made.values())]
                return pa.RecordBatch.from_arrays([*columns, *results], names=[*kept, *made])

            ids = batch.column(doc_id).to_pylist()
            for i, (number, raw) in enumerate(zip(ids, as_bytes(batch.column(text)))):
                output, form, *counts = transform(raw, draws(shares.seed, number), shares, marks)
                rows.append((output, form.encode(), *counts))
                held += len(output)
                if held >= BATCH_BYTES:
                    yield handed_on(i + 1)
                    rows, held, start = [], 0, i + 1
            if rows:
                yield handed_on(len(ids))

    fields = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes if c not in made)
    added = "output string, form string, n_units bigint, prefix_chars bigint, middle_chars bigint"
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(apply, f"{fields}, {added}")


def restore_text(
    rows: DataFrame, *, output: str = "output", form: str = "form", into: str = "restored", marks: Sentinels = Sentinels()
) -> DataFrame:
    """``rows`` with the text that each output was made from, read off output and form alone.

    A null output gives an empty text; a null form counts as plain. An input column with the
    name of the result is replaced.
    """
    kept = [c for c in rows.columns if c != into]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(form).to_pylist()
            texts, held, start = [], 0, 0

            def handed_on(stop: int) -> pa.RecordBatch:
                columns = [batch.column(c).slice(start, stop - start) for c in kept]
                return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, into])

            for i, raw in enumerate(as_bytes(batch.column(output))):
                texts.append(restore(raw, forms[i] or PLAIN, marks))
                held += len(raw)
                if held >= BATCH_BYTES:
                    yield handed_on(i + 1)
                    texts, held, start = [], 0, i + 1
            if texts:
                yield handed_on(len(forms))

    fields = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes if c != into)
    return rows.select(*[f"`{c}`" for c in kept]).mapInArrow(apply, f"{fields}, `{into}` string")
