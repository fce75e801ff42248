"""A compressed FM-index over words: wavelet matrix of the Burrows-Wheeler transform.

Texts are short runs of words, separated by the symbol 0, so suffixes need sorting by
their first ``DEPTH`` words only: patterns up to that length are found exactly.  Rank
takes one popcount per bit of the alphabet; queries are vectorised over patterns.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
DEPTH = 16


class Bits:
    """Bit vector with rank: 64-bit words and the ones before each of them."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(U64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        below = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)


class FMIndex:
    """Index of ``text``: int64 symbols from 0 (the separator), any number of runs."""

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        self.suffixes = self._sorted_suffixes(text)
        bwt = text[self.suffixes - 1]  # position -1 is the last separator
        top = int(text.max()) if n else 0
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, top.bit_length()))):
            ones = (bwt >> bit & 1).astype(np.uint8)
            self.levels.append((bit, Bits(ones), int(n - ones.sum())))
            bwt = np.concatenate((bwt[ones == 0], bwt[ones == 1]))
        self.origin = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))

    @staticmethod
    def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
        rank, width = text.astype(np.int64), 1
        while width < DEPTH:
            after = np.concatenate((rank[width:], np.zeros(min(width, len(rank)), np.int64)))
            _, rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)
            width *= 2
        return np.argsort(rank, kind="stable")

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the ranges of ``symbol`` followed by the patterns of [low, high)."""
        base = self.before[symbol] - self.origin[symbol]
        return base + self._walk(symbol, low), base + self._walk(symbol, high)

    def matching(self, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, up to ``length``, of the pattern that ends at each text position:
        how many words back it occurs at least twice, and its range there.  Patterns may
        not cross a separator."""
        n = len(ends)
        matched, low, high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.arange(n)
        symbol = self.text[ends]
        a, b = self.before[symbol], self.before[symbol + 1]
        for step in range(1, length + 1):
            going = b - a > 1  # a range of one is the pattern itself
            live, a, b = live[going], a[going], b[going]
            matched[live], low[live], high[live] = step, a, b
            if step == length or not len(live):
                break
            a, b = self.extend(self.text[ends[live] - step], a, b)
        return matched, low, high
