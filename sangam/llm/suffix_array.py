"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array steps.

Suffixes are classified as smaller (S) or larger (L) than the next; the leftmost of each run of S are
sorted by their substrings, named, and sorted as a shorter text, by doubling; L suffixes are then induced from left
to right and S suffixes from right to left. A scan runs over symbol buckets: a range of buckets in
which no suffix induces another of the same range is scanned as one array, others are halved, and a
single bucket is scanned in as many steps as its symbol's longest run has places.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last symbol is the only smallest one, and S."""
    n = len(text)
    rises = np.zeros(n, dtype=bool)
    rises[-1] = True
    rises[:-1] = text[:-1] < text[1:]
    differs = np.ones(n, dtype=bool)
    differs[:-1] = text[:-1] != text[1:]
    # within a run of one symbol the class is that of its last place
    deciding = np.flatnonzero(differs)
    return rises[np.repeat(deciding, np.diff(deciding, prepend=-1))]


class _Scan:
    """One induction: from left to right for L suffixes, mirrored for S suffixes."""

    def __init__(self, text, small, order, starts, rightwards):
        self.text, self.order, self.starts, self.rightwards = text, order, starts, rightwards
        self.wanted = ~small if rightwards else small
        self.free = starts[:-1].copy() if rightwards else starts[1:].copy()  # next place, or one past it

    def _induced(self, seen: np.ndarray) -> np.ndarray:
        before = seen[seen > 0] - 1
        return before[self.wanted[before]]

    def _place(self, found: np.ndarray) -> None:
        """Put suffixes into their buckets in the order in which they were induced."""
        symbols = self.text[found]
        by = symbols.argsort(kind="stable")
        found, symbols = found[by], symbols[by]
        n = len(symbols)
        cuts = (symbols[1:] != symbols[:-1]).nonzero()[0] + 1
        if len(cuts) == 0:
            self._place_alike(found, symbols[0])
            return
        first = np.empty(len(cuts) + 1, dtype=np.int64)
        first[0], first[1:] = 0, cuts
        sizes = np.empty(len(first), dtype=np.int64)
        sizes[:-1], sizes[-1] = cuts - first[:-1], n - cuts[-1]
        heads = symbols[first]
        rank = np.arange(n) - first.repeat(sizes)
        if self.rightwards:
            self.order[self.free[symbols] + rank] = found
            self.free[heads] += sizes
        else:
            self.order[self.free[symbols] - 1 - rank] = found
            self.free[heads] -= sizes

    def _place_alike(self, found: np.ndarray, symbol: int) -> None:
        at = self.free[symbol]
        if self.rightwards:
            self.order[at : at + len(found)] = found
            self.free[symbol] = at + len(found)
        else:
            self.order[at - len(found) : at] = found[::-1]
            self.free[symbol] = at - len(found)

    def _filled(self, low: int, high: int) -> np.ndarray:
        part = self.order[self.starts[low] : self.starts[high]]
        part = part[part >= 0]
        return part if self.rightwards else part[::-1]

    def run(self) -> None:
        todo = [(0, len(self.starts) - 1)]
        while todo:
            low, high = todo.pop()
            found = self._induced(self._filled(low, high))
            if not len(found):
                continue
            symbols = self.text[found]
            inside = (symbols >= low) & (symbols < high)
            if not inside.any():
                self._place(found)
            elif high - low > 1:
                middle = (low + high) // 2
                halves = [(low, middle), (middle, high)]
                todo += halves[::-1] if self.rightwards else halves
            else:
                self._one_bucket(low)

    def _one_bucket(self, symbol: int) -> None:
        """Suffixes of a bucket that induce others of the same bucket: step by step along the run."""
        fresh = self._filled(symbol, symbol + 1)
        while len(fresh):
            found = self._induced(fresh)
            fresh = found[self.text[found] == symbol]
            if len(fresh):
                self._place_alike(fresh, symbol)
        found = self._induced(self._filled(symbol, symbol + 1))
        found = found[self.text[found] != symbol]
        if len(found):
            self._place(found)


def _induce(text, small, starts, seeds) -> np.ndarray:
    """The order of all suffixes that follows from leftmost S suffixes in this order."""
    order = np.full(len(text), -1, dtype=np.int64)
    symbols = text[seeds]
    by = np.argsort(symbols, kind="stable")
    sizes = np.bincount(symbols, minlength=len(starts) - 1)
    ends = np.cumsum(sizes)
    order[starts[1:][symbols[by]] - ends[symbols[by]] + np.arange(len(seeds))] = seeds[by]
    _Scan(text, small, order, starts, True).run()
    # S suffixes are induced anew from the L suffixes alone, but for the last one
    held = order >= 0
    held[held] = small[order[held]]
    order[held] = -1
    order[0] = len(text) - 1
    scan = _Scan(text, small, order, starts, False)
    scan.free[0] = 0
    scan.run()
    return order


def _names(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings from one leftmost S to the next, equal ones alike, by place in ``leftmost``."""
    ends = np.append(leftmost[1:], leftmost[-1])
    lengths = ends - leftmost + 1
    place = np.empty(len(text), dtype=np.int64)
    place[leftmost] = np.arange(len(leftmost))
    by = place[ordered]
    new = np.ones(len(by), dtype=bool)
    alike = np.flatnonzero(lengths[by[1:]] == lengths[by[:-1]])
    left, right, size = leftmost[by[alike]], leftmost[by[alike + 1]], lengths[by[alike]]
    # equal lengths: compare symbol by symbol, dropping pairs as they differ
    same, at, open_ = np.ones(len(alike), dtype=bool), 0, np.arange(len(alike))
    while len(open_):
        equal = text[left[open_] + at] == text[right[open_] + at]
        same[open_[~equal]] = False
        at += 1
        open_ = open_[equal & (size[open_] > at)]
    new[alike[same] + 1] = False
    names = np.empty(len(by), dtype=np.int64)
    names[by] = np.cumsum(new) - 1
    return names


def doubled(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order, by ever longer beginnings: twice as many symbols a round, of those not told apart yet.

    For texts of names: these have about as many symbols as places, so that induction, a step for each few buckets, takes longer.
    """
    n, size = len(text), 1
    order = text.argsort(kind="stable")
    symbols, open_ = text[order], np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    while True:
        # the rank of suffixes alike so far is the first place they have in the order
        new = np.ones(len(open_), dtype=bool)
        new[1:] = symbols[1:] != symbols[:-1]
        rank[order[open_]] = open_[new].repeat(np.diff(np.flatnonzero(new), append=len(new)))
        open_ = open_[~(new & np.append(new[1:], True))]
        if not len(open_):
            return order
        some = order[open_]
        after = some + size
        symbols = rank[some] * (n + 1)
        symbols[after < n] += rank[after[after < n]] + 1
        by = symbols.argsort()
        order[open_], symbols = some[by], symbols[by]
        size *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order; symbols are 0 and up, and 0 stands at the end only."""
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    small = classify(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(text))])
    order = _induce(text, small, starts, leftmost)
    is_leftmost = np.zeros(len(text), dtype=bool)
    is_leftmost[leftmost] = True
    ordered = order[is_leftmost[order]]
    names = _names(text, leftmost, ordered)
    if names.max() + 1 < len(names):
        ordered = leftmost[doubled(names)]
    return _induce(text, small, starts, ordered)


def common_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, length): per place the suffix before it in the order, and their common prefix.

    ``left`` is the number of symbols from each place to the end of its part, which
    prefixes don't cross. Where a place and its previous are both preceded by one symbol, the
    length is one less than at the place before; the others are compared, 8 symbols at a time.
    """
    n = len(text)
    previous = np.full(n, -1, dtype=np.int64)
    previous[order[1:]] = order[:-1]
    has = previous >= 0
    follows = np.zeros(n, dtype=bool)
    inner = np.flatnonzero(has & (previous > 0))
    inner = inner[inner > 0]
    follows[inner] = (previous[inner - 1] == previous[inner] - 1) & (text[inner - 1] == text[previous[inner] - 1])
    compared = np.flatnonzero(has & ~follows)
    most = np.minimum(left[compared], left[previous[compared]])
    lengths = np.zeros(len(compared), dtype=np.int64)
    padded = np.concatenate([text, np.zeros(8, dtype=text.dtype)])
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        a, b = compared[open_] + lengths[open_], previous[compared[open_]] + lengths[open_]
        equal = np.ones(len(open_), dtype=bool)
        step = np.zeros(len(open_), dtype=np.int64)
        for k in range(8):
            equal &= padded[a + k] == padded[b + k]
            step += equal
        lengths[open_] += step
        open_ = open_[equal & (lengths[open_] < most[open_])]
    lengths = np.minimum(lengths, most)
    out = np.zeros(n, dtype=np.int64)
    out[compared] = lengths
    # carry along places that follow
    base = np.where(follows, 0, np.arange(n))
    np.maximum.accumulate(base, out=base)
    out = np.maximum(out[base] - (np.arange(n) - base), 0)
    return previous, np.where(has, out, 0)
