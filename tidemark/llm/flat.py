"""Texts as flat numpy arrays, for work inside tasks.

An Arrow string column is one byte buffer with offsets. Words, shingles and letters are computed on
that buffer by array operations, a bounded slice of rows at a time (a text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    """A random number for each byte, 0 for white space; A-Z count as a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
    values[[0x20, *range(0x09, 0x0E)]] = 0
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; first word of each row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    values = _byte_values()[data]
    inside = values != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    at = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    powers = np.cumprod(np.full(max(int(at.max()), 0) + 1, _MULTIPLIER))
    return mix(np.add.reduceat(values * powers[np.maximum(at, 0)], starts)), first


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes, non-negative 63 bits) of every row.

    A row with fewer words than ``width`` has its whole word sequence as one shingle; a row without
    words has the empty set.
    """
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * _MULTIPLIER) | np.uint64(1)
    for row, data, offsets in text_slices(texts):
        words, first = word_hashes(data, offsets)
        count = len(words) - width + 1
        if count > 0:
            joined = np.zeros(count, np.uint64)
            for i in range(width):
                joined += words[i : i + count] * factors[i]
            joined = mix(joined) >> np.uint64(1)
        for i in range(len(offsets) - 1):
            a, b = first[i], first[i + 1]
            if b - a >= width:
                found = np.unique(joined[a : b - width + 1])
            elif b > a:
                short = (words[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                found = mix(np.array([short])) >> np.uint64(1)
            else:
                found = np.zeros(0, np.uint64)
            yield row + i, found.astype(np.int64)


@cache
def _letters() -> np.ndarray:
    """Lower-case letter for each code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, their lower-case letters (0: no letter) and the first code point of each row."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    whole = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, _letters()[points], whole[offsets]
