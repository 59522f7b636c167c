"""Boolean trigram queries: what a text must contain for a pattern to match in it.

A query is ``True`` (nothing is mandatory), a trigram, or ("and" | "or", parts).
Trigrams are bytes of the text with A-Z lower-cased, so that they serve patterns
for either case.
"""

from __future__ import annotations

import re
import re._constants as kinds
import re._parser as parser

import numpy as np

#: Strings that are followed at once; beyond it a query only becomes less selective.
FOLLOWED = 64


def both(*parts):
    flat = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def either(*parts):
    flat = tuple(dict.fromkeys(parts))
    return True if not flat or True in flat else flat[0] if len(flat) == 1 else ("or", flat)


def of_strings(strings: frozenset[bytes]):
    return either(*(both(*(s[i : i + 3] for i in range(len(s) - 2))) for s in sorted(strings)))


#: Letters of ASCII that other letters equal where case is ignored beyond ASCII.
FOLDED_BEYOND = frozenset(map(ord, "iIkKsS"))


def literal(code: int, flags: int) -> frozenset[bytes] | None:
    """The bytes of a character, None if it stands for others too that have other bytes."""
    if flags & re.IGNORECASE and (code > 127 or (code in FOLDED_BEYOND and not flags & re.ASCII)):
        return None
    return frozenset([chr(code).encode("utf-8", "surrogatepass").lower()])


def walk(tree, flags: int) -> tuple[frozenset[bytes] | None, object]:
    """(all strings that the part matches, if few; else None, the query it implies)."""
    exact, strings, query = True, frozenset([b""]), True
    for kind, value in tree:
        some, needs = element(kind, value, flags)
        if some is not None and len(grown := {a + b for a in strings for b in some}) <= FOLLOWED:
            strings = frozenset(grown)
            continue
        query = both(query, of_strings(strings), needs)
        exact, strings = False, frozenset([b""])
        if some is not None:
            strings = some
    return (strings, of_strings(strings)) if exact else (None, both(query, of_strings(strings)))


def element(kind, value, flags: int):
    if kind is kinds.LITERAL:
        return literal(value, flags), True
    if kind is kinds.IN:
        options = [literal(v, flags) if k is kinds.LITERAL else None for k, v in value]
        if len(options) <= 8 and None not in options:
            return frozenset().union(*options), True
        return None, True
    if kind is kinds.BRANCH:
        ways = [walk(branch, flags) for branch in value[1]]
        if all(some is not None for some, _ in ways) and len(union := frozenset().union(*(s for s, _ in ways))) <= FOLLOWED:
            return union, of_strings(union)
        return None, either(*(needs for _, needs in ways))
    if kind is kinds.SUBPATTERN:
        _, added, removed, inner = value
        return walk(inner, (flags | added) & ~removed)
    if kind is kinds.ATOMIC_GROUP:
        return walk(value, flags)
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, inner = value
        some, needs = walk(inner, flags)
        if some is not None and most is not kinds.MAXREPEAT and most <= 4:
            runs = repeated(some, least, most)
            if runs is not None:
                return runs, of_strings(runs)
        return None, needs if least else True
    if kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return frozenset([b""]), True
    return None, True


def repeated(strings: frozenset[bytes], least: int, most: int) -> frozenset[bytes] | None:
    """All strings of ``least`` to ``most`` of the given ones in a row, None if they are too many to follow."""
    runs, longer = set(), {b""}
    for n in range(most + 1):
        if n >= least:
            runs |= longer
        if len(runs) > FOLLOWED:
            return None
        if n < most:
            longer = {a + b for a in longer for b in strings}
            if len(longer) > FOLLOWED:
                return None
    return frozenset(runs)


def trigram_query(pattern: str):
    """The query that every text with a match of ``pattern`` satisfies; True: scan all."""
    tree = parser.parse(pattern)
    return walk(tree, tree.state.flags)[1]


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


class Postings:
    """Inverted index of one segment of texts, for the trigrams that queries name."""

    def __init__(self, trigrams: set[bytes]):
        self.slots = {t: i + 1 for i, t in enumerate(sorted(trigrams))}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, slot in self.slots.items():
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = slot

    def index(self, texts: list[bytes]) -> None:
        """Take lower-cased texts; each trigram gets the sorted numbers of those with it."""
        self.n = len(texts)
        joined = np.frombuffer(b"\n\n".join(texts), np.uint8)
        self.of = {}
        if len(joined) < 3 or not self.slots:
            return
        codes = joined[:-2].astype(np.uint32)
        codes <<= 8
        codes |= joined[1:-1]
        codes <<= 8
        codes |= joined[2:]
        slot = self.table[codes]
        at = np.flatnonzero(slot)
        ends = np.cumsum([len(t) + 2 for t in texts])
        doc = np.searchsorted(ends, at, side="right")
        pairs = np.unique(slot[at].astype(np.int64) * self.n + doc)
        own, docs = pairs // self.n, pairs % self.n
        for t, s in self.slots.items():
            a, b = np.searchsorted(own, [s, s + 1])
            self.of[t] = docs[a:b]

    def answer(self, query) -> np.ndarray:
        """Numbers of the texts that satisfy the query."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.of.get(query, np.empty(0, np.int64))
        parts = sorted(map(self.answer, query[1]), key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out
