"""A bit set of 64-bit hashes with a bounded size, built by Spark, tested by
numpy: it never misses a key that was put in, and more keys only make it let
more others through."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the bound of the whole set (64 MB).
BITS_PER_KEY = 16
MAX_BITS = 1 << 29
_ROW_BITS = 32768  # of one row of bitmap_construct_agg


def build(keys: DataFrame, column: str) -> np.ndarray:
    """Bytes of the set over the bigint ``column``. One row of 4 KB per 32,768
    bits reaches the driver, ``MAX_BITS`` in all."""
    n = keys.count()
    bits = _ROW_BITS
    while bits < min(n * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    place = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    rows = (keys.select(place.alias("place"))
            .groupBy(F.bitmap_bucket_number("place").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    out = np.zeros(bits // 8, np.uint8)
    for part, got in rows.toLocalIterator():
        at = (part - 1) * _ROW_BITS // 8
        out[at:at + len(got)] = np.frombuffer(got, np.uint8)
    return out


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.astype(np.int64) & (len(bits) * 8 - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
