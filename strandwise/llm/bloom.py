"""Bloom bitmaps built in parallel from hashes: which bits were hit, and which were hit more than once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a row gets, and bounds for the whole filter. At the upper bound (32 MB) more rows only mean more false hits.
BITS_A_ROW, LEAST_BITS, MOST_BITS, CHUNK_BITS = 16, 1 << 16, 1 << 28, 1 << 16


def bits_for(rows: int) -> int:
    """A power of two near BITS_A_ROW bits for each row, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS_A_ROW * rows - 1).bit_length()))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions for each 64-bit hash."""
    h = hashes.astype(np.uint64)
    return np.stack([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    once, more = np.zeros(CHUNK_BITS // 8, np.uint8), np.zeros(CHUNK_BITS // 8, np.uint8)
    for a, b in parts:
        more |= b | (once & a)
        once |= a
    return once, more


def repeated_bits(df: DataFrame, hash_column: str, bits: int) -> np.ndarray:
    """Bitmap of the positions that at least two rows hit. df: rows with a 64-bit hash.

    Each task sends a pair of compressed bitmaps for each chunk that it touched; chunks merge by key in pairs of
    groups of bounded size, and the driver gets bits / 8 bytes at most (MOST_BITS / 8 = 32 MB).
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = positions(h, bits)
            rows[1] = np.where(rows[0] == rows[1], rows[0], rows[1])
            where = np.concatenate([rows[0], rows[1][rows[0] != rows[1]]])
            where, count = np.unique(where, return_counts=True)
            byte, bit = (where >> np.uint64(3)).astype(np.int64), (1 << (where & np.uint64(7)).astype(np.int64)).astype(np.uint8)
            again = (count > 1) | ((once[byte] & bit) > 0)
            np.bitwise_or.at(more, byte[again], bit[again])
            np.bitwise_or.at(once, byte, bit)
        step = CHUNK_BITS // 8
        used = [k for k in range(bits // CHUNK_BITS) if once[k * step : (k + 1) * step].any()]
        for at in range(0, len(used), 64):
            part = used[at : at + 64]
            packed = [[zlib.compress(x[k * step : (k + 1) * step].tobytes(), 1) for k in part] for x in (once, more)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(packed[0], pa.binary()), pa.array(packed[1], pa.binary())], ["chunk", "once", "more"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for chunk, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                part = tuple(np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                kept[chunk] = _merged([kept[chunk], part] if chunk in kept else [part])
        for chunk, (_, more) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(more.tobytes(), 1)], pa.binary())], ["chunk", "more"])

    local_rows = df.select(F.col(hash_column).alias("h")).mapInArrow(local, "chunk int, once binary, more binary")
    merged = local_rows.repartition("chunk").mapInArrow(merge, "chunk int, more binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        bitmap[row.chunk * CHUNK_BITS // 8 : (row.chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(zlib.decompress(row.more), np.uint8)
    return bitmap


def hit_bits(df: DataFrame, hash_column: str, bits: int) -> np.ndarray:
    """Bitmap of the positions that any row hits."""
    twice = df.select(F.explode(F.array(hash_column, hash_column)).alias("h"))
    return repeated_bits(twice, "h", bits)


def held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True where all positions of a hash are set in the bitmap."""
    where = positions(hashes, len(bitmap) * 8)
    return ((bitmap[(where >> np.uint64(3)).astype(np.int64)] >> (where & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def may_hold(df: DataFrame, bitmap: np.ndarray, hashed: Column) -> Column:
    """True where all positions of the hash are set in the bitmap (broadcast; MOST_BITS / 8 bytes at most)."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def run(h: pd.Series) -> pd.Series:
        return pd.Series(held(shared.value, h.to_numpy().view(np.uint64)))

    return run(hashed)
