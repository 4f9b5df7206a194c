"""A compressed FM-index over word segments: wavelet matrix, backward search, matching ends.

The text is all segments one after the other, each closed by a separator that no search uses. The
suffix order comes from prefix doubling; as no match crosses a separator, the longest segment bounds
the rounds. The Burrows-Wheeler transform is held as a wavelet matrix, one packed bit vector with
running counts for each bit of a symbol. All searches run in lockstep over numpy arrays.
"""

from __future__ import annotations

import numpy as np


class _Bits:
    """A packed bit vector with a count before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([np.zeros(1, np.int32), np.cumsum(counts, dtype=np.int32)[:-1]])
        self.zeros = len(bits) - int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FmIndex:
    """Index of segments given as arrays of symbols from 1 on."""

    def __init__(self, text: np.ndarray, longest: int, symbols: int):
        """``text``: segments with a 0 behind each; ``symbols``: greatest symbol."""
        n = len(text)
        self.size = n
        order = self._suffixes(text, longest)
        transform = text[order - 1]
        counts = np.bincount(text, minlength=symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.levels: list[tuple[int, _Bits]] = []
        rest = transform
        for bit in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            ones = (rest >> bit) & 1 == 1
            self.levels.append((bit, _Bits(ones)))
            rest = np.concatenate([rest[~ones], rest[ones]])
        #: Where each symbol's run begins below the last level.
        every = np.arange(symbols + 1)
        self.start = self._down(every, np.zeros(symbols + 1, np.int64))

    @staticmethod
    def _suffixes(text: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in order, separators apart by place and before all symbols."""
        n = len(text)
        ends = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))
        width = 1
        while True:
            # Beyond a separator nothing matters: those ranks differ already.
            key = rank * (rank.max() + 2)
            key[: n - width] += rank[width:] + 1
            key[ends] = np.arange(len(ends)) - len(ends)
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            width *= 2
            if new[-1] == n - 1 or width > longest:
                return order

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> bit) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one more symbol in front."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.start[symbol]
        return base + both[: len(symbol)], base + both[len(symbol) :]

    def reach(
        self, text: np.ndarray, begin: np.ndarray, end: np.ndarray, need: int
    ) -> np.ndarray:
        """Matching statistics: for each ``text[begin..end]`` (inclusive) the least place from which
        the part up to ``end`` occurs ``need`` times or more; end + 1 if not even the last word does.
        """
        found = end + 1
        live = np.arange(len(begin))
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.size, np.int64)
        at = end.copy()
        while len(live):
            low, high = self.step(text[at], low, high)
            good = high - low >= need
            live, low, high, at = live[good], low[good], high[good], at[good]
            found[live] = at
            more = at > begin[live]
            live, low, high, at = live[more], low[more], high[more], at[more] - 1
        return found


def repeated_windows(
    index: FmIndex, text: np.ndarray, offset: np.ndarray, windows: np.ndarray, width: int, need: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, last window) of the windows that occur ``need`` times or more.

    Segment i begins at ``offset[i]`` of ``text`` and has ``windows[i]`` windows of ``width`` words.
    A range of windows is settled from its end: what the matching statistics reach is reported;
    the windows before it share a middle part, and if that fails none of them can occur.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    which = np.flatnonzero(windows > 0)
    first, last = np.zeros(len(which), np.int64), windows[which].astype(np.int64) - 1
    while len(which):
        at = offset[which]
        reach = index.reach(text, at + first, at + last + width - 1, need) - at
        hit = reach <= last
        out.append((which[hit], reach[hit], last[hit]))
        last = np.where(hit, reach - 1, last - 1)
        left = first <= last
        which, first, last = which[left], first[left], last[left]
        at = offset[which]
        middle = index.reach(text, at + last, at + first + width - 1, need) - at
        whole = middle <= last
        which, first, last = which[whole], first[whole], last[whole]
        single = first == last
        out.append((which[single], first[single], last[single]))
        which, first, last = which[~single], first[~single], last[~single]
        half = (first + last) // 2
        which = np.concatenate([which, which])
        first, last = np.concatenate([first, half + 1]), np.concatenate([half, last])
    parts = [np.concatenate(column) for column in zip(*out, strict=True)] if out else []
    return tuple(parts) if parts else (np.zeros(0, np.int64),) * 3
