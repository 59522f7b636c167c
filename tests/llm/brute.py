"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(texts, n, share, of):
    """{id: (size of its set, smallest id that links lead to)}"""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if of * common >= share * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(texts, width):
    """{id: (bytes, removed, spans, digest of the rest)}"""
    raw = {i: (t or "").encode() for i, t in texts.items()}
    first = {}
    for i in sorted(raw):
        for k in range(len(raw[i]) - width + 1):
            first.setdefault(raw[i][k : k + width], i)
    out = {}
    for i, data in raw.items():
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            if first[data[k : k + width]] < i:
                gone[k : k + width] = b"\x01" * width
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def secrets(text):
    """(kind, start, end) of the base kinds."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(
        [
            ("assign", r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
            ("access", r"AKIA[A-Z0-9]+", 0, 18),
            ("hex", r"[0-9a-f]+", 0, 16),
        ]
    ):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def by_id(rows):
    out = defaultdict(list)
    for row in rows:
        out[row[0]].append(tuple(row[1:]))
    return dict(out)
