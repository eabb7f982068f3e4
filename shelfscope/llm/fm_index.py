"""A word-level FM-index of one shard: suffix order, Burrows-Wheeler text in a wavelet matrix, backward search of
many phrases at once, and positions from sampled suffixes.  All steps are numpy passes over the shard."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions of ``seq`` in the order of their suffixes.  0 separates runs: a comparison ends
    there, ties go by position.  ``seq`` must end with 0."""
    n = len(seq)
    bits = max(1, int(seq.max(initial=0)).bit_length())
    depth = max(1, min(8, 62 // bits, n))
    key = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for d in range(depth):  # the first `depth` symbols of every suffix in one integer
        sym = np.zeros(n, np.int64)
        sym[:n - d] = seq[d:]
        sym[ended] = 0
        key = (key << bits) | sym
        ended |= sym == 0
    order = np.argsort(key, kind="stable")
    head = np.empty(n, bool)
    head[:1] = True
    head[1:] = (key[order[1:]] != key[order[:-1]]) | ended[order[1:]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    alone = head & np.append(head[1:], True)
    open_slots, reach = np.flatnonzero(~alone), depth
    while len(open_slots):  # double the compared length, for suffixes that still tie
        pos = order[open_slots]
        key = rank[pos] * n + rank[pos + reach]
        by = np.argsort(key, kind="stable")
        pos, key = pos[by], key[by]
        order[open_slots] = pos
        head = np.append(True, key[1:] != key[:-1])
        rank[pos] = np.maximum.accumulate(np.where(head, open_slots, 0))
        open_slots = open_slots[~(head & np.append(head[1:], True))]
        reach *= 2
    return order


class WaveletMatrix:
    """Rank and access over symbols, one bit vector with running counts per bit of the symbol."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        cur = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (cur >> level & 1).astype(bool)
            self.bits.append(bit)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            cur = np.concatenate([cur[~bit], cur[bit]])
            self.zeros.append(int(len(bit) - bit.sum()))
        self.first = np.searchsorted(self._sorted_key(cur), self._sorted_key(np.arange(1 << self.levels)))

    def _sorted_key(self, sym: np.ndarray) -> np.ndarray:
        """Order of the symbols below the last level: by their bits read from the lowest up."""
        out = np.zeros(len(sym), np.int64)
        for level in range(self.levels):
            out = out << 1 | (sym >> level & 1)
        return out

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before slot ``at``."""
        for k in range(self.levels):
            ones = self.ones[k][at]
            at = np.where(symbol >> (self.levels - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at - self.first[symbol]

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each slot and how often it stands before."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            ones, bit = self.ones[k][at], self.bits[k][at]
            symbol = symbol << 1 | bit
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    def __init__(self, seq: np.ndarray):
        n = len(seq)
        order = suffix_order(seq)
        before = seq[order - 1].astype(np.int64)  # seq[-1] is the last separator
        self.n, self.tree = n, WaveletMatrix(before)
        counts = np.bincount(seq, minlength=1 << self.tree.levels)
        self.smaller = np.concatenate([[0], np.cumsum(counts)])
        sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sampled = sampled
        self.sample_no = np.cumsum(sampled, dtype=np.int32) - 1
        self.samples = order[sampled].astype(np.int32)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot ranges [lo, hi) of the suffixes that begin with each phrase (rows, left-aligned)."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for back in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > back) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - back].astype(np.int64)
            known = symbol < 1 << self.tree.levels
            lo[live[~known]] = hi[live[~known]] = 0
            live, symbol = live[known], symbol[known]
            lo[live] = self.smaller[symbol] + self.tree.rank(symbol, lo[live])
            hi[live] = self.smaller[symbol] + self.tree.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in these slots: walk back to a sampled one."""
        slots, steps = slots.copy(), np.zeros(len(slots), np.int64)
        walk = np.flatnonzero(~self.sampled[slots])
        while len(walk):
            symbol, rank = self.tree.access_rank(slots[walk])
            slots[walk] = self.smaller[symbol] + rank
            steps[walk] += 1
            walk = walk[~self.sampled[slots[walk]]]
        return self.samples[self.sample_no[slots]] + steps


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [lo, hi), and the number of the range of each."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which], which
