"""A run-length index of texts: run-compressed Burrows-Wheeler transform with suffix samples at run ends.

Space is in runs, not bytes: run heads, run starts, counts by symbol before each run, and two samples a run, one of the suffix position
and one of the smallest document in the run; beside these, the document of every row, for runs that an interval cuts. Patterns are matched backwards, all at once in numpy. ``matching_statistics``
streams a text and gives the longest match that starts at each of its places; ``long_matches`` marks the places covered by matches of
some length with an earlier document.

This is the method in one process, for one block of a corpus. The README says why the distributed query deals strings by content instead.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol must be the least and unique."""
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    step, n = 1, len(symbols)
    while True:
        key = rank * (rank.max() + 2)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class RunLengthIndex:
    def __init__(self, texts: list[bytes]):
        """Index texts in order of document; each ends in a separator of its own, less than any byte."""
        n = len(texts)
        self.docs = n
        parts = [np.concatenate((np.frombuffer(t, np.uint8).astype(np.int64) + n, [n - 1 - i])) for i, t in enumerate(texts)]
        text = np.concatenate(parts)
        doc = np.repeat(np.arange(n), [len(p) for p in parts])
        order = suffix_array(text)
        bwt = text[order - 1]
        new = np.concatenate(([True], bwt[1:] != bwt[:-1]))
        self.start = np.flatnonzero(new)
        self.head = bwt[self.start]
        self.length = len(bwt)
        ends = np.concatenate((self.start[1:], [self.length]))
        self.end_sample = order[ends - 1]
        #: The smallest document of the suffixes in each run, and within runs where an interval cuts one.
        self.run_doc = np.minimum.reduceat(doc[order], self.start)
        self._row_doc = doc[order]
        counts = np.bincount(text, minlength=n + 256)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        by = np.argsort(self.head, kind="stable")
        self._runs_of = by
        size = (ends - self.start)[by]
        total = np.cumsum(size)
        first = np.searchsorted(self.head[by], np.arange(n + 257))
        self._first = first
        self._count = np.concatenate(([0], total))
        # Keys that order runs by (symbol, start), so that one search serves all symbols.
        self._key = self.head[by] * (self.length + 1) + self.start[by]

    @property
    def runs(self) -> int:
        return len(self.start)

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of a symbol before a row of the transform."""
        at = np.searchsorted(self._key, symbol * (self.length + 1) + row, "left")
        base = self._first[symbol]
        whole = self._count[at] - self._count[base]
        last = np.maximum(at - 1, 0)
        run = self._runs_of[last]
        end = np.append(self.start[1:], self.length)[run]
        over = np.where(at > base, np.maximum(end - row, 0), 0)
        return whole - over

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after a symbol is put before the matches."""
        return self.before[symbol] + self.rank(symbol, lo), self.before[symbol] + self.rank(symbol, hi)

    def intervals(self, text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each string of ``length`` in the text, the rows of its occurrences."""
        s = np.frombuffer(text, np.uint8).astype(np.int64) + self.docs
        at = np.arange(max(len(s) - length + 1, 0))
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.length)
        for k in range(length - 1, -1, -1):
            lo, hi = self.extend(s[at + k], lo, hi)
        return lo, hi

    def matching_statistics(self, text: bytes) -> np.ndarray:
        """Length of the longest match that starts at each place: all places are extended in step, by doubling of the end."""
        n = len(text)
        out = np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), n - np.arange(n)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            ok = self._occurs(text, np.flatnonzero(open_), mid[open_])
            where = np.flatnonzero(open_)
            low[where[ok]] = mid[open_][ok]
            high[where[~ok]] = mid[open_][~ok] - 1
            out = low
        return out

    def _occurs(self, text: bytes, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        s = np.frombuffer(text, np.uint8).astype(np.int64) + self.docs
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.length)
        for k in range(int(length.max(initial=0)) - 1, -1, -1):
            live = np.flatnonzero((length > k) & (hi > lo))
            if len(live):
                lo[live], hi[live] = self.extend(s[at[live] + k], lo[live], hi[live])
        return hi > lo

    def least_document(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest document in each interval; whole runs by their sample, cut ones by their rows."""
        out = np.full(len(lo), self.docs)
        for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
            if b > a:
                first, last = np.searchsorted(self.start, [a, b], "left")
                edge = self.start[first] if first < len(self.start) else self.length
                inner_end = self.start[last - 1] if last > first else edge
                rows = [self._row_doc[a : min(b, edge)], self.run_doc[first : max(last - 1, first)], self._row_doc[max(inner_end, a) : b]]
                out[i] = min(int(x.min()) for x in rows if len(x))
        return out

    def long_matches(self, text: bytes, document: int, length: int = 50) -> np.ndarray:
        """Mask of bytes covered by strings of ``length`` that also start in a smaller document."""
        lo, hi = self.intervals(text, length)
        edge = np.zeros(len(text) + 1, np.int64)
        hit = np.flatnonzero(self.least_document(lo, hi) < document)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + length, -1)
        return np.cumsum(edge)[: len(text)] > 0
