"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Helpers for tasks: texts are joined to one run of bytes, words are cut at given
separators and hashed with a rolling polynomial over random byte values, so the cost
is a few passes over the bytes whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 19
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1
BYTE_VALUES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, made longer when a block needs it."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -size, 1 << 64))])
        return self.up[:n], self.down[:n]


def blocks(texts: list[str | None], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts as bytes) in runs of about ``most`` bytes; null is empty."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        held.append(b"" if text is None else text.encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


class Words:
    """Words of one block: ``hash`` and ``doc`` (number within the block) of each, in order."""

    def __init__(self, raw: list[bytes], powers: Powers, lower: bool = True):
        joined = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        self.bytes = joined
        if lower:
            joined = LOWER[joined]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.ends = np.cumsum(lengths)
        self.n = len(raw)
        space = SPACE[joined]
        change = np.flatnonzero(np.diff(np.concatenate([[True], space])))
        self.start, self.stop = change[0::2], change[1::2]
        up, down = powers.to(len(joined) + 1)
        total = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[joined] * up[:-1], out=total[1:])
        self.hash = mixed((total[self.stop] - total[self.start]) * down[self.start])
        self.doc = np.searchsorted(self.ends, self.start, side="right")
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, bounds): those of text i are ``hash[bounds[i]:bounds[i + 1]]``, in order.

        A text of fewer than ``n`` words has one, of the whole sequence; one without words none.
        """
        counts = np.diff(self.first)
        made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
        bounds = np.concatenate([[0], np.cumsum(made)])
        places = np.repeat(self.first[:-1] - bounds[:-1], made) + np.arange(bounds[-1])
        out = np.zeros(bounds[-1], np.uint64)
        left = np.repeat(np.minimum(counts, n), made)
        for k in range(n):
            has = left > k
            whole = has.all()
            word = self.hash[places + k] if whole else self.hash[np.where(has, places + k, 0)] if len(self.hash) else out
            step = mixed(out * np.uint64(BASE) + word + np.uint64(k + 1))
            out = step if whole else np.where(has, step, out)
        return out, bounds
