"""Words of Arrow text columns as numpy arrays, hashed without a Python loop.

A batch's texts lie behind one another in one Arrow buffer, so word bounds and
word hashes of all its rows come from a few array operations over its bytes. Word
classes are given by byte: bytes above 0x7F belong to characters above U+007F,
which are either all word characters or none, so this equals the class by character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20  # bytes hashed at once; longer words make a block longer
SLICE = 4 << 20  # bytes of text handled at once by the operators

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.ones(256, bool)
    for a, b in ranges:
        out[a : b + 1] = False
    return out


SPACED = _class((0x20, 0x20), (0x09, 0x0D))  # [^\x20\x09-\x0D]
PLAIN = _class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, _BLOCK + 1)
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        if size > 4 * _BLOCK:  # one odd row should not stay in memory
            return both[0], both[1]
        _powers = both[0], both[1]
    return _powers


@dataclass
class Words:
    """``doc[i]``: row of word ``i``; ``data[start[i]:end[i]]``: its bytes."""

    n_docs: int
    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray

    def first(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same in every process."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(self.start):
            at = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, at + _BLOCK, "right")))
            part = self.data[at : int(self.end[j - 1])]
            power, inverse = _tables(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
            a, b = self.start[i:j] - at, self.end[i:j] - at
            h = (sums[b] - sums[a]) * inverse[a]
            out[i:j] = mix(h + (b - a).astype(np.uint64) * _BASE)
            i = j
        return out

    def texts(self) -> pa.Array:
        """The words as an Arrow string column."""
        size = self.end - self.start
        to = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=to[1:])
        flat = np.repeat(self.start - to[:-1], size) + np.arange(to[-1])
        return pa.Array.from_buffers(
            pa.large_string(),
            len(size),
            [None, pa.py_buffer(to), pa.py_buffer(np.ascontiguousarray(self.data[flat]))],
        )


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and each row's bounds in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(texts: pa.Array, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Maximal runs of ``kind`` bytes in each row. No word crosses two rows."""
    data, bounds = bytes_of(texts)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    here, before, after = inside[1:-1], inside[:-2].copy(), inside[2:].copy()
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = False
    after[bounds[1:][full] - 1] = False
    start = np.flatnonzero(here & ~before)
    end = np.flatnonzero(here & ~after) + 1
    doc = np.searchsorted(bounds, start, "right") - 1
    return Words(len(bounds) - 1, data, doc, start, end, bounds)


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``size`` bytes of text, or one row."""
    _, bounds = bytes_of(texts)
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield i, j
        i = j


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` consecutive word hashes at each place where they fit. Places
    that run over the end of a row are the caller's to leave out.
    """
    if len(h) < n:
        return np.zeros(0, np.uint64)
    done, out = 1, h
    while done * 2 <= n:
        out = mix(out[:-done] * _BASE + out[done:])
        done *= 2
    if done < n:
        out = mix(out[: len(h) - n + 1] * _BASE + out[n - done :] + np.uint64(n))
    return out


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of ``counts`` values a row."""
    to = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=to[1:])
    return pa.ListArray.from_arrays(pa.array(to), pa.array(values, kind))
