"""Secrets in texts, found with a trigram inverted index.

Each rule's pattern gives a Boolean trigram query (``trigrams``). Texts are indexed
in segments of a few megabytes inside the task that read them: the postings of the
mandatory trigrams are intersected, and only the candidates are verified with the
pattern itself. Rules without mandatory trigrams look at every text. There is no
shuffle, so no key can be hot and a lost task is simply run again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from pulsemill.llm.trigrams import Postings, trigram_query, trigrams_of

SEGMENT_BYTES = 4 << 20
PLACEHOLDER = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and without overlap; matches whose ``group`` is
    shorter than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base patterns and their least lengths.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
# Published formats of keys and tokens.
MORE_RULES = (
    # To the END line of the same kind, unless another key begins before it; else the header alone.
    Rule("private_key", r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----)?"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    """Rules made ready once per task."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern), trigram_query(r.pattern)) for r in rules]
        self.postings = Postings(set().union(*(trigrams_of(q) for _, _, q in self.rules)))

    def segment(self, texts: list[str], raw: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, number of the rule, end), sorted."""
        self.postings.index(raw)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, pattern, query) in enumerate(self.rules):
            for i in self.postings.answer(query).tolist():
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), number, m.end()))
        for spans in found:
            spans.sort()
        return found

    def all(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int]]]:
        batch: list[str] = []
        raw: list[bytes] = []
        held = 0
        for text in texts:
            batch.append(text or "")
            raw.append(batch[-1].encode("utf-8", "surrogatepass").lower())
            held += len(raw[-1])
            if held >= SEGMENT_BYTES:
                yield from self.segment(batch, raw)
                batch, raw, held = [], [], 0
        yield from self.segment(batch, raw)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end), by start, then order of the rules.

    Places are code points, ends exclusive. A null or empty text has no spans; a
    repeated row is judged each time; whole texts are read however long they are. An
    input column named ``spans`` is replaced. An empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c != spans]
    kinds = [r.kind for r in rules]
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            found = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in s] for s in scanner.all(texts)]
            columns = [batch.column(c) for c in kept] + [pa.array(found, made)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, spans])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in docs.dtypes if c != spans)
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(scan, f"{fields}, `{spans}` array<struct<kind: string, start: bigint, end: bigint>>")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", placeholder: str = PLACEHOLDER) -> DataFrame:
    """``docs`` in which every secret in ``text`` is replaced; overlapping secrets together.

    All other columns and all rows stay. Null texts stay null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            clean = []
            for t, spans in zip(texts, scanner.all(texts)):
                if spans:
                    whole = merged([(a, b) for a, _, b in spans])
                    starts = [0, *(b for _, b in whole)]
                    t = placeholder.join(t[a:b] for a, b in zip(starts, [*(a for a, _ in whole), len(t)]))
                clean.append(t)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return docs.mapInArrow(scan, docs.schema)
