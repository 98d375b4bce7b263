"""A bidirectional FM-index over a delimited list of words, searched for many patterns at once.

The text is ``$w1$w2...$wn`` read as a ring.  Two Burrows-Wheeler transforms,
of the text and of its mirror image, are kept as wavelet matrices; a pattern is
a pair of equally long suffix-rank intervals, one in each.  Adding a symbol at
an end of the pattern narrows the interval of that end's transform by a rank
query, and moves the other one by the number of smaller symbols there.  All
operations work on numpy arrays of states, so a step costs a few array
operations for a whole batch of patterns.
"""

from __future__ import annotations

import numpy as np

LEVELS = 7  # symbols 0..127; 0 is the delimiter
FIRST = 0xC0  # U+00C0..U+00FF follow a-z


def encode(words: list[str]) -> list[np.ndarray]:
    """Symbols of words over a-z and U+00C0..U+00FF."""
    out = []
    for w in words:
        c = np.frombuffer(w.encode("latin-1"), np.uint8)
        out.append(np.where(c < 128, c - 96, c - np.uint8(FIRST - 27)).astype(np.uint8))
    return out


def rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in sorted order; they must be distinct.

    The first key packs eight symbols; ranks then double their reach until no
    two rotations agree.
    """
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(8):
        key = (key << LEVELS) | np.roll(text, -j)
    reach = 8
    while True:
        values, rank = np.unique(key, return_inverse=True)
        if len(values) == n:
            order = np.empty(n, np.int64)
            order[rank] = np.arange(n)
            return order
        key = rank.astype(np.int64) * len(values) + np.roll(rank, -reach)
        reach *= 2


class Wavelet:
    """Rank queries over a symbol sequence (a Burrows-Wheeler transform)."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        counts = np.bincount(symbols, minlength=1 << LEVELS)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])  # of each symbol in sorted order
        self.zeros, self.split = [], []
        start = np.zeros(1 << LEVELS, np.int64)  # where the way of a symbol begins on the last level
        every = np.arange(1 << LEVELS)
        s = symbols
        for k in range(LEVELS - 1, -1, -1):
            bit = (s >> k) & 1
            before = np.zeros(n + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            z = int(before[n])
            self.zeros.append(before)
            self.split.append(z)
            start = np.where((every >> k) & 1, z + start - before[start], before[start])
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.shift = first - start

    def extend(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """(lo, size, smaller): the interval after adding ``symbol``; how many smaller symbols stand in the old one."""
        hi, smaller = lo + size, np.zeros(len(lo), np.int64)
        for i, k in enumerate(range(LEVELS - 1, -1, -1)):
            z, at = self.zeros[i], self.split[i]
            l0, h0 = z[lo].astype(np.int64), z[hi].astype(np.int64)
            one = ((symbol >> k) & 1).astype(bool)
            smaller += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, at + lo - l0, l0), np.where(one, at + hi - h0, h0)
        return lo + self.shift[symbol], hi - lo, smaller

    def children(self, lo: np.ndarray, size: np.ndarray):
        """(state, lo, size, symbol, smaller) for every symbol that stands in a state's interval."""
        hi = lo + size
        state = np.arange(len(lo))
        symbol, smaller = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for z, at in zip(self.zeros, self.split, strict=True):
            l0, h0 = z[lo].astype(np.int64), z[hi].astype(np.int64)
            a, b = h0 > l0, (hi - lo) > (h0 - l0)
            state = np.concatenate([state[a], state[b]])
            smaller = np.concatenate([smaller[a], (smaller + h0 - l0)[b]])
            symbol = np.concatenate([symbol[a] << 1, (symbol[b] << 1) | 1])
            lo, hi = np.concatenate([l0[a], (at + lo - l0)[b]]), np.concatenate([h0[a], (at + hi - h0)[b]])
        return state, lo + self.shift[symbol], hi - lo, symbol, smaller


class States:
    """Patterns under way: their number, the interval of the growing end, the start of the other one, the size."""

    def __init__(self, pattern, lo, other, size):
        self.pattern, self.lo, self.other, self.size = pattern, lo, other, size

    def __len__(self):
        return len(self.pattern)

    def take(self, keep) -> States:
        return States(self.pattern[keep], self.lo[keep], self.other[keep], self.size[keep])

    def plus(self, more: States) -> States:
        pairs = zip(vars(self).values(), vars(more).values(), strict=True)
        return States(*(np.concatenate(p) for p in pairs))

    def extend(self, side: Wavelet, symbol: np.ndarray) -> States:
        lo, size, smaller = side.extend(self.lo, self.size, symbol)
        return States(self.pattern, lo, self.other + smaller, size).take(size > 0)

    def children(self, side: Wavelet) -> tuple[States, np.ndarray]:
        state, lo, size, symbol, smaller = side.children(self.lo, self.size)
        return States(self.pattern[state], lo, self.other[state] + smaller, size), symbol


class WordIndex:
    """Bidirectional index over distinct words; ``near`` finds those at one error."""

    def __init__(self, words: list[str]):
        codes = encode(words)
        lengths = np.array([len(c) + 1 for c in codes], np.int64)
        ends = np.cumsum(lengths)
        text = np.zeros(int(ends[-1]) if len(words) else 1, np.uint8)
        for c, e in zip(codes, ends, strict=True):
            text[e - len(c):e] = c
        self.n, self.words = len(text), words
        self.order = rotations(text)
        self.starts = ends - lengths
        mirror = text[::-1].copy()
        self.left = Wavelet(text[self.order - 1])  # grows patterns to the left
        self.right = Wavelet(mirror[rotations(mirror) - 1])  # grows patterns to the right

    def _search(self, codes: np.ndarray, half: int, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word): words that equal a pattern but for one replaced or added symbol past its first ``half``.

        ``codes`` has a pattern a row, read from the side where the search starts.
        """
        side = self.right if forward else self.left
        count, length = codes.shape
        zero, none = np.zeros(count, np.int64), np.zeros(0, np.int64)
        exact = States(np.arange(count), zero, zero, zero + self.n).extend(side, zero)
        for j in range(half):
            exact = exact.extend(side, codes[exact.pattern, j].astype(np.int64))
        off = States(none, none, none, none)  # those that have used their error
        for j in range(half, length + 1):
            if not len(exact) and not len(off):
                break
            grown, symbol = exact.children(side)
            wanted = codes[grown.pattern, j] if j < length else np.zeros(len(grown), np.uint8)
            other = (symbol != 0) & (symbol != wanted)
            off = off.plus(grown.take(other))  # an added symbol; one equal to the next is found behind it
            off = off.extend(side, codes[off.pattern, j].astype(np.int64) if j < length else np.zeros(len(off), np.int64))
            if j < length:
                off = off.plus(grown.take(other))  # a replaced one
                exact = grown.take(symbol == wanted)
        rank = off.other if forward else off.lo  # the suffix rank of $word$ in the text itself
        return off.pattern, np.searchsorted(self.starts, self.order[rank])

    def near(self, asked: list[str], forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """(i, j): ``words[j]`` is ``asked[i]`` with one symbol replaced or added behind its first
        half (``forward``: that half and the word's start match exactly) or before its second one."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(asked):
            by_length.setdefault(len(w), []).append(i)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for length, rows in by_length.items():
            codes = np.stack(encode([asked[i] for i in rows]))
            first = length // 2
            p, w = self._search(codes if forward else codes[:, ::-1], first if forward else length - first, forward)
            found.append((np.array(rows, np.int64)[p], w))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
