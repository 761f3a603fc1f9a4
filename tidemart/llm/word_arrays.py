"""Words of Arrow text columns as numpy arrays: what operators 11, 12 and 13
share. Words are cut at ASCII bytes alone, so all work is on the UTF-8 bytes of
a whole slice of texts at once; distinct words are found by Arrow's dictionary
encoding."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD, GAP, BREAK = 0, 1, 2
#: Bytes of text that are worked on at once; a single longer text is one slice.
SLICE_BYTES = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def byte_classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of each byte: of a word, between words, or between pieces."""
    out = np.zeros(256, np.uint8)
    out[list(gaps)] = GAP
    out[list(breaks)] = BREAK
    return out


class Words(NamedTuple):
    """All words of a slice of texts, A-Z lower-cased."""

    ids: np.ndarray  # of each word: its place in ``spelt``
    spelt: pa.Array  # distinct words (binary)
    counts: np.ndarray  # words of each text
    joined: np.ndarray  # of each word: the next one follows it in the same piece of the same text

    @property
    def texts(self) -> np.ndarray:
        """Of each word: the place of its text in the slice."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def spellings(self) -> list[bytes]:
        return self.spelt.to_pylist()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], whole[off[0]:off[-1]]


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text, one row at least."""
    off, _ = _bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def words_of(texts: pa.Array, classes: np.ndarray) -> Words:
    off, raw = _bytes_of(texts)
    low = _LOWER[raw]
    kind = classes[low]
    inside = kind == WORD
    if not inside.any():
        return Words(np.zeros(0, np.int64), pa.array([], pa.large_binary()),
                     np.zeros(len(texts), np.int64), np.zeros(0, bool))
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[off[:-1][off[:-1] < len(raw)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(low[inside])]).dictionary_encode()
    counts = np.diff(np.searchsorted(starts, off))
    joined = np.ones(len(starts), bool)
    joined[np.cumsum(counts)[counts > 0] - 1] = False
    breaks = np.flatnonzero(kind == BREAK)
    if len(breaks):
        piece = np.searchsorted(breaks, starts)
        joined[:-1] &= piece[1:] == piece[:-1]
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, counts, joined)


def in_groups(words: Words, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words told apart by a code of their text as well (``groups``: one code
    per text). Returns the place of each word among the distinct (group, word)
    pairs, and the group and ``spelt`` place of each pair."""
    n = max(len(words.spelt), 1)
    both = np.repeat(groups.astype(np.int64), words.counts) * n + words.ids
    size = (int(groups.max()) + 1) * n if len(groups) else 0
    if size <= 8 * len(both):
        there = np.zeros(size, bool)
        there[both] = True
        distinct = np.flatnonzero(there)
        place = np.cumsum(there) - 1
        return place[both], distinct // n, distinct % n
    distinct, ids = np.unique(both, return_inverse=True)
    return ids, distinct // n, distinct % n


# keys ----------------------------------------------------------------------

#: Longer words are hashed by MD5, one by one.
_SHORT = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (uint64)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


_NUMBERS = [mixed(np.arange(1 + k, 257 + k, dtype=np.uint64)) for k in (0, 1000)]  # of each byte
_FACTORS = [mixed(np.arange(5000 + k, 5000 + _SHORT + k, dtype=np.uint64)) | np.uint64(1) for k in (0, 1000)]  # of each place


def _md5(word: bytes) -> tuple[int, int]:
    import hashlib

    d = hashlib.md5(word).digest()
    return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")


def word_keys(spelt: pa.Array) -> np.ndarray:
    """(words, 2): a 128-bit key of each distinct word (uint64)."""
    off, data = _bytes_of(spelt)
    n = len(spelt)
    if not n:
        return np.zeros((0, 2), np.uint64)
    sizes = np.diff(off)
    place = np.minimum(np.arange(len(data)) - np.repeat(off[:-1], sizes), _SHORT - 1)
    keys = np.empty((n, 2), np.uint64)
    for k in range(2):
        sums = np.zeros(n, np.uint64)
        some = sizes > 0
        sums[some] = np.add.reduceat(_NUMBERS[k][data] * _FACTORS[k][place], off[:-1][some])
        keys[:, k] = mixed(sums + sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes > _SHORT):
        keys[i] = _md5(data[off[i]:off[i + 1]].tobytes())
    return keys


def keys_in_groups(keys: np.ndarray, names: list[str], group: np.ndarray, word: np.ndarray) -> np.ndarray:
    """(pairs, 2): keys of (group, word) pairs as int64; ``names`` of the groups."""
    seeds = np.array([_md5(x.encode()) for x in names], np.uint64).reshape(-1, 2)
    return mixed(keys[word] ^ mixed(seeds[group])).view(np.int64)
