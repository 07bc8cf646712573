"""Vectorised tokenising of Arrow text columns, for use inside tasks.

A word is a maximal run of bytes outside ``0x20 0x09-0x0D``.  None of those
bytes occurs inside a multi-byte UTF-8 character, so words can be found on
the raw UTF-8 buffer of an Arrow string array, without a Python string per
row.  Every function takes whole texts; null texts have no words.

Hashes are 64-bit and depend on the bytes of the word only (not on the
process or the platform), so any task may compute and compare them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
_CHUNK = 1 << 19                         # bytes hashed at once: bounds the 8-byte temporaries
_BASE = np.uint64(0x9E3779B97F4A7C15)    # odd, so invertible modulo 2**64
_STEPS = np.array([0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.size = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, _CHUNK * 2)
            self.up = _powers(_BASE, self.size)
            self.down = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), self.size)
        return self.up, self.down


_POWERS = _Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column: row i is bytes[offsets[i]:offsets[i+1]].
    Null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and the index of each row's first word."""
    n = len(raw)
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    inside = ~gap
    before = np.empty(n + 1, bool)
    before[0] = before[n] = True
    before[1:n] = gap[:-1] if n else True
    before[off] = True                                   # a row boundary separates words
    start = np.flatnonzero(inside & before[:n])
    after = np.empty(n, bool)
    if n:
        after[:-1] = gap[1:]
        after[-1] = True
        after |= before[1:]
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(start, off)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte unchanged."""
    upper = (raw >= 65) & (raw <= 90)
    return raw + (upper * np.uint8(32))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word: a polynomial over its bytes, then mixed with its length."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + _CHUNK, side="right")))
        hi = end[j - 1]
        up, down = _POWERS.get(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def _combine(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words."""
    m = len(words) - n + 1
    total = np.full(m, np.uint64(n), np.uint64)
    for k in range(n):
        total += words[k:k + m] * _STEPS[k]
    return mix64(total)


def shingle_hashes(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the n-word shingles in order of position; a shorter, non-empty
    sequence counts as one shingle; no words give none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return _combine(words, min(n, len(words)))


def row_words(column: pa.Array, lower: bool = False) -> Iterator[np.ndarray]:
    """Word hashes of each row of a text column."""
    raw, off = utf8(column)
    if lower:
        raw = lower_ascii(raw)
    start, end, first = word_spans(raw, off)
    hashes = word_hashes(raw, start, end)
    for i in range(len(off) - 1):
        yield hashes[first[i]:first[i + 1]]


def row_shingle_sets(column: pa.Array, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row (A-Z lower-cased first)."""
    for words in row_words(column, lower=True):
        yield np.unique(shingle_hashes(words, n))


__all__ = ["SHINGLE", "mix64", "utf8", "word_spans", "lower_ascii", "word_hashes",
           "shingle_hashes", "row_words", "row_shingle_sets"]
