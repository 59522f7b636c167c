"""Suffix arrays by induced sorting, in numpy.

Suffixes are smaller (S) or larger (L) than their successor. The leftmost S suffixes
of each run are sorted by their substrings, named, and ordered by recursion on the
names; the order of all others is induced from them in two linear sweeps. A sweep
goes through the first letters: all suffixes of a bucket that are known induce their
predecessors at once, and those that fall into the same bucket form the next batch.
"""

from __future__ import annotations

import numpy as np

#: Names beyond this many letters are written as two letters for the recursion.
LETTERS = 4096
#: Shorter strings of names end the recursion and are sorted by pairs of ranks.
SHORT = 1 << 18


def smaller(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last suffix is L, as the end counts as the smallest letter."""
    n = len(text)
    turn = np.empty(n, bool)
    turn[:-1] = text[1:] != text[:-1]
    turn[-1] = True
    at = np.where(turn, np.arange(n, dtype=np.int32), n)
    after = np.minimum.accumulate(at[::-1])[::-1]
    rises = np.empty(n, bool)
    rises[:-1] = text[1:] > text[:-1]
    rises[-1] = False
    return rises[after]


class Sweep:
    """Both sweeps over one text: from an order of the leftmost S suffixes to that of all."""

    def __init__(self, text: np.ndarray, letters: int):
        self.text, self.letters, self.n = text, letters, len(text)
        self.is_s = smaller(text)
        self.leftmost = np.flatnonzero(self.is_s & ~np.concatenate([[True], self.is_s[:-1]])).astype(np.int32)
        # One place more, which stands for what is before the first suffix.
        self.s_before = np.append(self.is_s, False)
        self.l_before = np.append(~self.is_s, False)
        self.count = np.arange(self.n)
        self.n_l = np.bincount(text[~self.is_s], minlength=letters)
        self.n_s = np.bincount(text[self.is_s], minlength=letters)
        self.l_start = np.concatenate([[0], np.cumsum(self.n_l)])
        self.s_start = np.concatenate([[0], np.cumsum(self.n_s)])

    def put(self, into: np.ndarray, head: np.ndarray, suffixes: np.ndarray, letters: np.ndarray) -> None:
        """Append suffixes to the buckets of their letters, in order."""
        order = letters.argsort(kind="stable")
        letters = letters[order]
        size = np.bincount(letters, minlength=self.letters)
        shift = head - (size.cumsum() - size)
        into[shift[letters] + self.count[: len(letters)]] = suffixes[order]
        head += size

    def larger_before(self, suffixes: np.ndarray) -> np.ndarray:
        before = suffixes - 1
        return before[self.l_before[before]]

    def smaller_before(self, suffixes: np.ndarray) -> np.ndarray:
        before = suffixes - 1
        return before[self.s_before[before]]

    def induce(self, leftmost: np.ndarray) -> np.ndarray:
        text = self.text
        first = text[leftmost]
        leftmost = leftmost[np.argsort(first, kind="stable")]
        bounds = np.searchsorted(text[leftmost], np.arange(self.letters + 1))
        large = np.empty(self.l_start[-1], np.int32)
        head = self.l_start[:-1].copy()
        large[head[text[-1]]] = self.n - 1
        head[text[-1]] += 1
        for letter in np.flatnonzero(self.n_l + self.n_s):
            done = self.l_start[letter]
            while done < head[letter]:
                batch = large[done : head[letter]]
                done = head[letter]
                if len(found := self.larger_before(batch)):
                    self.put(large, head, found, text[found])
            batch = leftmost[bounds[letter] : bounds[letter + 1]]
            if len(batch) and len(found := self.larger_before(batch)):
                self.put(large, head, found, text[found])
        # Right to left: buckets of S suffixes are filled from their ends.
        small = np.empty(self.s_start[-1], np.int32)
        head = self.s_start[:-1].copy()
        for letter in np.flatnonzero(self.n_l + self.n_s)[::-1]:
            done = self.s_start[letter]
            while done < head[letter]:
                batch = small[done : head[letter]]
                done = head[letter]
                if len(found := self.smaller_before(batch)):
                    self.put(small, head, found, text[found])
            batch = large[self.l_start[letter] : self.l_start[letter + 1]][::-1]
            if len(batch) and len(found := self.smaller_before(batch)):
                self.put(small, head, found, text[found])
        return self.joined(large, small)

    def joined(self, large: np.ndarray, small: np.ndarray) -> np.ndarray:
        """Each letter's L suffixes, then its S suffixes, which were found last to first."""
        out = np.empty(self.n, np.int32)
        letters = np.arange(self.letters)
        out[np.arange(len(large)) + np.repeat(self.s_start[:-1], self.n_l)] = large
        of = np.repeat(letters, self.n_s)
        out[self.l_start[of + 1] + self.s_start[of] + self.s_start[of + 1] - 1 - np.arange(len(small))] = small
        return out


def names(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each leftmost S suffix to the next, in order of the text."""
    m = len(leftmost)
    place = np.empty(len(text), np.int32)
    place[leftmost] = np.arange(m)
    rank = place[ordered]
    length = np.empty(m, np.int64)
    length[:-1] = np.diff(leftmost) + 1
    length[-1] = len(text) - leftmost[-1]
    a, b = rank[:-1], rank[1:]
    same = (length[a] == length[b]) & (a != m - 1) & (b != m - 1)
    left = np.flatnonzero(same)
    step = 0
    while len(left):
        equal = text[leftmost[a[left]] + step] == text[leftmost[b[left]] + step]
        same[left[~equal]] = False
        step += 1
        left = left[equal]
        left = left[length[a[left]] > step]
    number = np.concatenate([[0], np.cumsum(~same)])
    out = np.empty(m, np.int64)
    out[rank] = number
    return out, int(number[-1]) + 1


def by_doubling(ranks: np.ndarray) -> np.ndarray:
    """Suffix array of a string of ranks by sorting pairs of doubling reach."""
    m, reach = len(ranks), 1
    while True:
        second = np.zeros(m, np.int64)
        second[: max(0, m - reach)] = ranks[reach:] + 1
        key = ranks * (m + 2) + second
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        ranks = np.empty(m, np.int64)
        ranks[order] = new
        if new[-1] == m - 1:
            return order
        reach *= 2


def suffix_array(text: np.ndarray, letters: int = 256) -> np.ndarray:
    """Starts of all suffixes in lexicographic order (a prefix of another comes first)."""
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32)
    sweep = Sweep(text, letters)
    leftmost = sweep.leftmost
    if len(leftmost) > 1:
        found = sweep.induce(leftmost)
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        ordered = found[is_leftmost[found]]
        named, count = names(text, leftmost, ordered)
        if count < len(leftmost):
            if len(named) < SHORT:
                order = by_doubling(named)
            elif count <= LETTERS:
                order = suffix_array(named.astype(np.uint16), count)
            elif count <= LETTERS * LETTERS and 5 * len(named) < 2 * len(text):
                base = int(np.sqrt(count)) + 1  # as few letters as two of them need
                pairs = np.empty(2 * len(named), np.uint16)
                pairs[0::2], pairs[1::2] = named // base, named % base
                order = suffix_array(pairs, base)
                order = order[order % 2 == 0] // 2
            else:  # two letters for a name would hardly make the string shorter
                order = by_doubling(named)
            leftmost = leftmost[order]
        else:
            leftmost = ordered
    return sweep.induce(leftmost)


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, first byte highest; zeros past the end."""
    out = np.zeros(len(text) + 8, np.uint64)
    out[: len(text)] = text
    for shift in (1, 2, 4):
        later = np.zeros_like(out)
        later[:-shift] = out[shift:]
        out = (out << np.uint64(8 * shift)) | later
    return out[: len(text)]


def common_prefixes(text: np.ndarray, order: np.ndarray, fresh: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: of each suffix, in order of the text, with the one before it in ``order``.

    Where both are preceded by the same letter the value is one less than the last
    one's; only the others, and places marked ``fresh``, are compared letter by letter,
    up to ``most``. So values are exact up to ``most`` less the distance to the last
    such place.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    direct = fresh | (before <= 0) | (place == 0)
    rest = np.flatnonzero(~direct)
    direct[rest[text[rest - 1] != text[before[rest] - 1]]] = True
    words = words_at(text)
    a = np.flatnonzero(direct & (before >= 0))
    value = np.zeros(n, np.int64)
    active = a
    for reach in range(0, most, 8):
        p, q = active + reach, before[active] + reach
        inside = np.maximum(p, q) < n
        active, p, q = active[inside], p[inside], q[inside]
        differ = words[p] ^ words[q]
        room = n - np.maximum(p, q)
        zero = np.zeros(len(active), np.int64)
        for bits in (32, 16, 8):  # leading equal bytes
            high = (differ >> np.uint64(64 - bits)) == 0
            zero += np.where(high, bits // 8, 0)
            differ = np.where(high, differ << np.uint64(bits), differ)
        zero = np.where(differ == 0, 8, zero)
        value[active] += np.minimum(zero, room)
        active = active[(zero == 8) & (room > 8)]
    last = np.maximum.accumulate(np.where(direct, place, 0))
    return np.maximum(value[last] - (place - last), 0)
