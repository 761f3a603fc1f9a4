"""CRC-32 of "left right" strings from the CRCs of their words, for whole
arrays: appending n bytes turns a CRC by a linear map that depends on n alone
(as zlib's crc32_combine does)."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np

#: CRC-32's polynomial, bits reversed (fixed value).
POLYNOMIAL = 0xEDB88320


def _turn(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map given by its values on single bytes, applied to ``crc``."""
    return (tables[..., 0, :][..., crc & 255] ^ tables[..., 1, :][..., (crc >> 8) & 255]
            ^ tables[..., 2, :][..., (crc >> 16) & 255] ^ tables[..., 3, :][..., crc >> 24])


def _one_byte() -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    value = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return (value >> 8) ^ step[value & 255]


@lru_cache(maxsize=64)
def _doubled(k: int) -> np.ndarray:
    """The map of 2^k zero bytes."""
    if k == 0:
        return _one_byte()
    half = _doubled(k - 1)
    return _turn(half, half)


@lru_cache(maxsize=4096)
def zero_bytes(n: int) -> np.ndarray:
    """The map of ``n`` zero bytes as 4 x 256 values."""
    out = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(n.bit_length()):
        if n >> k & 1:
            out = _turn(_doubled(k), out)
    return out


def crc32_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


class Pairs:
    """CRCs of "left right" over one set of distinct words."""

    def __init__(self, words: list[bytes]):
        self.alone = crc32_of(words)
        self._after = crc32_of([b" " + w for w in words])
        sizes, self._kind = np.unique(np.fromiter(map(len, words), np.int64, len(words)) + 1, return_inverse=True)
        self._maps = np.stack([zero_bytes(int(n)) for n in sizes]) if len(words) else np.zeros((0, 4, 256), np.uint32)

    def crc32(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``left`` and ``right``: places of words."""
        crc, kind = self.alone[left], self._kind[right]
        m = self._maps
        return (m[kind, 0, crc & 255] ^ m[kind, 1, (crc >> 8) & 255] ^ m[kind, 2, (crc >> 16) & 255]
                ^ m[kind, 3, crc >> 24] ^ self._after[right])
