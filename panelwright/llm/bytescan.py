"""Vectorised word scans over the byte buffers of Arrow string columns.

A batch is cut into slices of about ``SLICE`` text bytes, so that the working
arrays stay small whatever the number of rows in a batch; a longer text forms a
slice of its own and is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of words that white space separates: everything but 0x20 and 0x09-0x0D
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
#: bytes of alphanumeric words in lower-cased text: digits, a-z and all non-ASCII letters
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def text_array(column: pa.Array) -> pa.Array:
    """A string column with nulls read as empty texts."""
    column = column.cast(pa.string()) if column.type != pa.string() else column
    return column.fill_null("") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row in them."""
    column = text_array(column)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` text bytes, or a single row."""
    _, offsets = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one entry more than rows)."""
    inside = kind[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    firsts, lasts = offsets[:-1], offsets[1:] - 1
    full = lasts >= firsts
    before[firsts[full]] = False
    after[lasts[full]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, 2 * SLICE)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)], dtype=np.uint64)
            _inverse = np.cumprod(np.r_[np.uint64(1), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)], dtype=np.uint64)
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by differences of prefix sums."""
    powers, inverse = _tables(len(data))
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=prefix[1:])
        return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def hashed_words(column: pa.Array, kind: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a slice, and the index of each row's first word."""
    data, offsets = buffers(column)
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets, kind)
    return span_hashes(data, starts, ends), rows


def word_hash(word: str) -> int:
    """The hash that ``hashed_words`` gives to one lower-cased word."""
    value = sum((b + 1) * pow(_BASE, i, 1 << 64) for i, b in enumerate(word.encode())) & _MASK
    return int(mix(np.array([(value + len(word.encode())) & _MASK], np.uint64))[0])
