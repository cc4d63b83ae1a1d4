"""Suffix arrays and an FM-index over word numbers, in numpy."""

from __future__ import annotations

import numpy as np


def sort_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the prefix each suffix shares with the one before it.

    0 is a separator: every separator differs from all others, so no suffix is
    compared beyond one. The last symbol has to be a separator. Prefixes are
    doubled, and only suffixes that still tie are sorted again. Where two
    neighbours part, after h to 2h symbols, the rest of what they share is the
    least shared prefix between the places of their tails, which parted earlier;
    so a few arrays suffice however long the repeats are.
    """
    n = len(symbols)
    gap = symbols == 0
    single = np.where(gap, np.cumsum(gap) - 1, symbols.astype(np.int64) + int(gap.sum()))
    order = np.argsort(single, kind="stable")
    first = np.ones(n, bool)
    first[1:] = np.diff(single[order]) != 0
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    # n stands for neighbours that have not parted yet.
    lcp = np.where(first, 0, n).astype(np.int32)
    slots = np.flatnonzero(~(first & np.append(first[1:], True)))
    h = 1
    while len(slots):
        at = order[slots]
        key = rank[at] * (n + 1) + rank[at + h]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        first = np.ones(len(at), bool)
        first[1:] = np.diff(key) != 0
        was = rank[at]
        parted = np.flatnonzero(first[1:] & (was[1:] == was[:-1])) + 1
        lcp[slots[parted]] = h + _shared(single, rank, lcp, at[parted - 1] + h, at[parted] + h, h)
        rank[at] = slots[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        slots = slots[~(first & np.append(first[1:], True))]
        h *= 2
    return order, rank, lcp


def _shared(
    single: np.ndarray, rank: np.ndarray, lcp: np.ndarray, i: np.ndarray, j: np.ndarray, h: int
) -> np.ndarray:
    """Common prefixes of suffixes i and j that differ within h symbols, by classes of h symbols."""
    if h > 8:
        low, high = np.minimum(rank[i], rank[j]), np.maximum(rank[i], rank[j])
        return least_between(pyramid(lcp), low + 1, high + 1) if len(i) else np.zeros(0, np.int32)
    found = np.zeros(len(i), np.int32)
    alive = np.arange(len(i))
    for t in range(h - 1):
        alive = alive[single[i[alive] + t] == single[j[alive] + t]]
        found[alive] += 1
    return found


def pyramid(values: np.ndarray) -> list[np.ndarray]:
    """``values``, the least of every two neighbours, of every four, and so on."""
    levels = [values]
    while len(levels[-1]) > 1:
        row = levels[-1]
        if len(row) % 2:
            row = np.append(row, np.iinfo(row.dtype).max)
        levels.append(np.minimum(row[::2], row[1::2]))
    return levels


def least_between(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value in each range [low, high); ranges must not be empty."""
    best = np.full(len(low), np.iinfo(levels[0].dtype).max, levels[0].dtype)
    todo = np.arange(len(low))
    for row in levels:
        odd = low % 2 == 1
        best[todo[odd]] = np.minimum(best[todo[odd]], row[low[odd]])
        odd = high % 2 == 1
        best[todo[odd]] = np.minimum(best[todo[odd]], row[high[odd] - 1])
        low, high = (low + 1) // 2, high // 2
        more = low < high
        low, high, todo = low[more], high[more], todo[more]
        if not len(todo):
            break
    return best


def smaller_before(levels: list[np.ndarray], at: np.ndarray, strict: bool) -> np.ndarray:
    """The last place before each place whose value is smaller (or as small); one must exist."""
    value = levels[0][at]
    node, depth = at.copy(), np.zeros(len(at), np.int8)
    todo = np.arange(len(at))
    # Up, until a left neighbour holds a small enough value.
    for t, row in enumerate(levels):
        here = node[todo]
        beside = row[here - 1]
        hit = (here % 2 == 1) & ((beside < value[todo]) if strict else (beside <= value[todo]))
        node[todo] = np.where(hit, here - 1, here // 2)
        depth[todo[hit]] = t
        todo = todo[~hit]
        if not len(todo):
            break
    # Down again, to the right where that holds one.
    for t in range(int(depth.max(initial=0)), 0, -1):
        todo = np.flatnonzero(depth >= t)
        row, right = levels[t - 1], node[todo] * 2 + 1
        beside = row[np.minimum(right, len(row) - 1)]
        fits = ((beside < value[todo]) if strict else (beside <= value[todo])) & (right < len(row))
        node[todo] = right - ~fits
    return node


class FMIndex:
    """Counts and locates phrases of ``symbols`` by backward search.

    The Burrows-Wheeler transform is kept as a wavelet matrix: per bit of the
    symbols one prefix count of ones. Suffix positions are kept for every
    ``sample``-th place and for each place after a separator, so a walk back
    never steps over a separator.
    """

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        order, _, _ = sort_suffixes(symbols)
        self.bwt = symbols[order - 1].astype(np.int64)
        top = int(symbols.max(initial=0)) + 1
        counts = np.bincount(symbols, minlength=top + 1)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        self.bits = max(1, top.bit_length())
        self.levels = []
        rest = self.bwt
        for b in range(self.bits - 1, -1, -1):
            one = (rest >> b) & 1
            ones = np.concatenate([[0], np.cumsum(one)]).astype(np.int32)
            self.levels.append((ones, len(rest) - int(ones[-1])))
            rest = np.concatenate([rest[one == 0], rest[one == 1]])
        kept = (order % sample == 0) | (self.bwt == 0)
        self.kept, self.nth, self.places = kept, np.cumsum(kept) - 1, order[kept]

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``end`` of the transform."""
        low = np.zeros_like(end)
        for b, (ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            one = (symbol >> b) & 1 == 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases of one length, one phrase a row."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.bwt), np.int64)
        alive = np.arange(len(phrases))
        for t in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, t]
            known = c < len(self.below) - 1
            c = np.where(known, c, 0)
            a, b = (self.below[c] + self.rank(c, x[alive]) for x in (lo, hi))
            lo[alive], hi[alive] = a, np.where(known, b, a)
            alive = alive[lo[alive] < hi[alive]]
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        walk = np.flatnonzero(~self.kept[rows])
        while len(walk):
            c = self.bwt[rows[walk]]
            rows[walk] = self.below[c] + self.rank(c, rows[walk])
            steps[walk] += 1
            walk = walk[~self.kept[rows[walk]]]
        return self.places[self.nth[rows]] + steps
