"""Vectorised work on batches of UTF-8 texts: words, word hashes, windows of words.

A batch is one byte buffer with the offsets of its texts, taken from an Arrow column without copying.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes handled at a time where a step needs eight bytes or more for each.
SLICE = 1 << 20

_rng = np.random.default_rng(20240229)
_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters, digits and the bytes of other characters.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def packed(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(
    buf: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _GAP
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    inside = ~gap[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` folds A-Z first."""
    out = np.empty(len(starts), np.uint64)
    codes = _CODES[_LOWER] if lower else _CODES
    lengths = ends - starts
    total = np.concatenate([[0], np.cumsum(lengths)])
    powers = np.full(1, _BASE, np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE, "right")) - 1)
        size = lengths[i:j]
        if len(powers) < size.max():
            powers = np.cumprod(np.full(int(size.max()), _BASE, np.uint64), dtype=np.uint64)
        at = np.arange(total[j] - total[i]) - np.repeat(total[i:j] - total[i], size)
        terms = codes[buf[np.repeat(starts[i:j], size) + at]] * powers[at]
        out[i:j] = np.add.reduceat(terms, total[i:j] - total[i])
        i = j
    return mix(out)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the index of its text, from the index of each text's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text: (hash, text index, index of the run's first word)."""
    n = len(hashes) - size + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _BASE + hashes[k : k + n]
    text = owners(first)
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(total[at]), text[at], at


def text_keys(hashes: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each text's sequence of words."""
    at = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
    terms = mix(hashes + mix(at.astype(np.uint64) * _BASE + np.uint64(salt)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    sums = total[first[1:]] - total[first[:-1]]
    return mix(sums + np.diff(first).astype(np.uint64) * _BASE)
