"""Helpers that the text operators share: Arrow text buffers and vectorised word hashing."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

#: Base of the polynomial hash over bytes, its inverse modulo 2**64, and the multiplier that joins words to shingles.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
WORD_STEP = 0xD6E8FEB86659FD93


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and its n + 1 offsets; a null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_string()).fill_null("")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), offsets


@functools.lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64."""
    return _powers(1 << max(16, int(n - 1).bit_length()), base)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[s:e]; equal slices get equal hashes wherever they stand."""
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes), BASE), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(len(codes) + 1, BASE_INVERSE)[starts])


#: A word is a run of bytes other than space and the controls 9 to 13; A-Z count as a-z.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hashes of the words of one text, in order."""
    if not len(data):
        return np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate(([True], SPACE[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    return slice_hashes(LOWER[data] if lower else data, starts, ends)


def shingle_set(data: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one text; with fewer words the whole sequence is one shingle."""
    words = word_hashes(data)
    if not len(words):
        return words
    width = min(k, len(words))
    steps, n = powers(width, WORD_STEP), len(words) - width + 1
    joined = np.zeros(n, np.uint64)
    for j in range(width):
        joined += words[j : j + n] * steps[j]
    return np.unique(mix(joined + np.uint64(width)))


def pieces(offsets: np.ndarray):
    """(row, start, end) of each text in the buffers of text_buffers()."""
    yield from zip(range(len(offsets) - 1), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
