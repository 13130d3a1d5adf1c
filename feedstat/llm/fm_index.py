"""A compressed FM-index over a sequence of integers: backward search on a wavelet matrix."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(-(-(len(bits) + 1) // 64) * 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[: len(own)] = own
        self.words = packed.view("<u8").astype(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        word = at >> 6
        rest = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & rest)


class FMIndex:
    """Finds where patterns of at most ``depth - 1`` symbols occur in ``text`` (integers from 0).

    Suffixes are sorted by their first ``depth`` symbols, which is all such patterns see. The
    text ends in a symbol of its own, below all others, at ``suffixes[0]``.
    """

    def __init__(self, text: np.ndarray, depth: int):
        text = np.append(text + 1, 0)
        n = len(text)
        rank, done = text.astype(np.int64), 1
        while done < depth:
            behind = np.zeros(n, np.int64)
            behind[: n - done] = rank[done:] + 1
            rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + behind, return_inverse=True)[1].astype(np.int64)
            done *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        symbols = int(text.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        # a suffix at the start of the text has no symbol before it: one that no pattern has
        last = np.where(self.suffixes > 0, text[self.suffixes - 1], symbols)
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            ones = (last >> bit) & 1 == 1
            self.levels.append((bit, Bits(ones), int(n - ones.sum())))
            last = np.concatenate((last[~ones], last[ones]))
        self.origin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns with ``symbol`` put before them."""
        symbol = symbol + 1
        base = self.first[symbol] - self.origin[symbol]
        return base + self._down(symbol, low), base + self._down(symbol, high)

    def matches(self, patterns: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of rows of symbols, from the last symbol backwards.

        For each row: how many symbols match before fewer than ``least`` occurrences are left,
        and the suffix range of that match.
        """
        count, width = patterns.shape
        low, high = np.zeros(count, np.int64), np.full(count, len(self.suffixes))
        matched, active = np.zeros(count, np.int64), np.arange(count)
        for column in range(width - 1, -1, -1):
            a, b = self.extend(patterns[active, column], low[active], high[active])
            more = b - a >= least
            active, a, b = active[more], a[more], b[more]
            low[active], high[active] = a, b
            matched[active] += 1
            if not len(active):
                break
        return matched, low, high
