"""A compressed full-text index over word numbers: FM-index on a wavelet matrix."""

from __future__ import annotations

import numpy as np


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers of the pairs in their order, equal pairs alike."""
    key = first * (np.int64(second.max(initial=0)) + 2) + second + 1
    order = np.argsort(key, kind="stable")
    new = np.zeros(len(key), np.int64)
    new[1:] = key[order[1:]] != key[order[:-1]]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new)
    return out


def _later(names: np.ndarray, by: int) -> np.ndarray:
    out = np.full(len(names), -1, np.int64)
    if by < len(names):
        out[:-by] = names[by:]
    return out


class Bits:
    """Bits with constant-time counts of the ones before a place: 64 to a word, and
    one count for each word.
    """

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.word = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.word.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.word), np.int32)
        np.cumsum(np.bitwise_count(self.word)[:-1], out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = self.word[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[block] + np.bitwise_count(low)


class WaveletMatrix:
    """Counts of any symbol before any place, in one step for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.width = max(1, int(n_symbols - 1).bit_length())
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(self.width)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        everything = np.arange(n_symbols)
        self.base = self._down(everything, np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            r = ones.ones(at)
            at = np.where(symbol >> bit & 1, zeros + r, at - r)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.base[symbol]


class FMIndex:
    """Index of ``text``, which holds pieces with a 0 after each.

    ``owner`` names the document of each place; the index keeps, for all places that
    start with the same ``window`` words, the smallest owner.
    """

    def __init__(self, text: np.ndarray, owner: np.ndarray, window: int):
        self.window = window
        names, depth, half = _names(text, np.zeros_like(text)), 1, None
        while depth <= window:  # suffixes in order of more words than a window has
            half, half_depth = names, depth
            names = _names(names, _later(names, depth))
            depth *= 2
        order = np.argsort(names, kind="stable")
        n_symbols = int(text.max(initial=0)) + 1
        self.below = np.zeros(n_symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=n_symbols), out=self.below[1:])
        self.bwt = WaveletMatrix(text[order - 1], n_symbols)
        a, b = half[order], _later(half, window - half_depth)[order] if window > half_depth else half[order]
        new = np.ones(len(text), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.starts = Bits(new)
        self.group_at = np.append(np.flatnonzero(new), len(text))
        self.smallest = np.minimum.reduceat(owner[order], self.group_at[:-1])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Ranges of the places that start with ``symbol`` and then the old match."""
        both = self.bwt.rank(np.append(symbol, symbol), np.append(lo, hi))
        low = self.below[symbol]
        return low + both[: len(lo)], low + both[len(lo) :]

    def first_owner(self, text: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Matching statistics of pieces, read from their last word backwards.

        The match grows by one word at a time and is cut back to ``window`` words, the
        threshold. Yields ``(pieces, places, owners)``: at ``places`` in these pieces a
        match of ``window`` words begins, whose smallest owner in the index is given.
        Pieces must occur in the index.
        """
        order = np.argsort(start - end, kind="stable")
        size = (end - start)[order]
        last = text[end[order] - 1]
        lo, hi = self.below[last], self.below[last + 1]
        for step in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -step, "left"))  # pieces longer than step
            place = end[order[:n]] - 1 - step
            lo, hi = lo[:n], hi[:n]
            if step:
                lo, hi = self.extend(text[place], lo, hi)
            if step + 1 >= self.window:
                group = self.starts.ones(lo + 1) - 1
                lo, hi = self.group_at[group], self.group_at[group + 1]
                yield order[:n], place, self.smallest[group]
