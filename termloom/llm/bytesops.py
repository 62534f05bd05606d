"""Vectorised work on the bytes of many texts at once, for use inside tasks.

Texts come as Arrow columns and are taken in slices of a bounded number of bytes, so memory does not
grow with the batch; one text longer than the bound is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows; a NULL text is empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, every[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand."""
    base, inverse = _BASE, pow(_BASE, -1, 1 << 64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * powers(len(data), base)[:-1], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(len(data), inverse)[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) * _U(_ODD)))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of maximal runs of word bytes; no run crosses a text."""
    before = np.zeros(len(is_word) + 1, bool)
    before[1:] = is_word
    before[offsets] = False
    starts = np.flatnonzero(is_word & ~before[:-1])
    after = np.zeros(len(is_word) + 1, bool)
    after[:-1] = is_word
    after[offsets] = False
    ends = np.flatnonzero(is_word & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def space_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words, words before each text); words are split at 0x20, 0x09-0x0D."""
    data = lowered(data)
    starts, ends, counts = word_spans(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)
    return span_hashes(data, starts, ends), counts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` word hashes; one of the whole if there are fewer, none of nothing."""
    if not len(words):
        return words
    size = min(size, len(words))
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _U(_ODD)) | _U(1)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : i + len(total)] * factors[i]
    return mix(total + _U(size))
