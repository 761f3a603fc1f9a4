"""Token ids in fixed-width binary files (op 6).

Documents are range-sorted by id, encoded, and written as files of bit-packed
ids: each id takes the fewest bits that hold the vocabulary. Blocks of
``BLOCK_IDS`` ids begin on a byte, so with the block offsets any block (hence
any document) is read and unpacked alone with numpy.

A file: ``TPK1``, blocks, document table (64-bit ids, NULL flags, starts in the
file), block offsets, then a fixed trailer with the counts and places of these.

Defined results: NULL text is empty (the end id alone); a NULL doc_id sorts
first; equal doc_ids stand in the order of their text's hash; repeated rows
keep one entry each; an empty table gives no rows and no files.
"""

from __future__ import annotations

import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared_files
from .bpe import begins_with_space, cuts_at_classes, load_tokenizer, split_words, vocabulary_size, word_parts
from .common import write_and_reread

MAGIC = b"TPK1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 24
CACHED_WORDS = 2_000_000
#: New words that are encoded in one call.
RUN_WORDS = 64
END_ID = 0
# fixed layout: bits per id, ids per block, ids, documents, place of the
# document table, place of the block offsets, magic
_TRAILER = struct.Struct("<BIQQQQ4s")

MANIFEST = "path string, pid int, serial int, n_ids bigint, n_docs bigint, n_bytes bigint"


def bits_for(vocabulary: int) -> int:
    """The least width that holds the ids 0 to ``vocabulary - 1``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids one after the other, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=count * width)
    weights = np.left_shift(np.uint32(1), np.arange(width, dtype=np.uint32))
    return bits.reshape(count, width).astype(np.uint32) @ weights


class Writer:
    """One file, block by block; at most a block and the document table are held."""

    def __init__(self, out, width: int, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.block_ids = out, width, block_ids
        self.at, self.n_ids = len(MAGIC), 0
        self.wait, self.waiting = [], 0
        self.doc_ids, self.starts, self.offsets = [], [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()).bit_length() > self.width:
            raise ValueError(f"an id needs more than {self.width} bits")
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.wait.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block_ids:
            flat = np.concatenate(self.wait)
            whole = len(flat) // self.block_ids * self.block_ids
            for a in range(0, whole, self.block_ids):
                self._block(flat[a:a + self.block_ids])
            self.wait, self.waiting = [flat[whole:]], len(flat) - whole

    def _put(self, data: bytes) -> int:
        begin = self.at
        self.out.write(data)
        self.at += len(data)
        return begin

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self._put(pack_bits(ids, self.width)))

    def close(self) -> int:
        if self.waiting:
            self._block(np.concatenate(self.wait))
        missing = np.array([d is None for d in self.doc_ids], bool)
        docs = self._put(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
                         + np.packbits(missing).tobytes() + np.array(self.starts, "<u8").tobytes())
        blocks = self._put(np.array(self.offsets, "<u8").tobytes())
        self._put(_TRAILER.pack(self.width, self.block_ids, self.n_ids, len(self.doc_ids), docs, blocks, MAGIC))
        self.out.close()
        return self.at


class Reader:
    """Random access to a file: any range of ids reads only its blocks."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - _TRAILER.size)
        (self.width, self.block_ids, self.n_ids, n, docs, blocks, magic) = _TRAILER.unpack(source.read(_TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file, or cut short")
        source.seek(docs)
        table = source.read(blocks - docs)
        ids = np.frombuffer(table, "<i8", n)
        flags = np.unpackbits(np.frombuffer(table, np.uint8, -(-n // 8), 8 * n), count=n)
        self.doc_ids = [None if f else int(d) for d, f in zip(ids, flags)]
        self.starts = np.append(np.frombuffer(table, "<u8", n, 8 * n + -(-n // 8)).astype(np.int64), self.n_ids)
        source.seek(blocks)
        n_blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.append(np.frombuffer(source.read(8 * n_blocks), "<u8").astype(np.int64), docs)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file."""
        if begin >= end:
            return np.empty(0, np.uint32)
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        out = []
        for k in range(first, last + 1):
            count = min(self.block_ids, self.n_ids - k * self.block_ids)
            a = int(self.offsets[k] - self.offsets[first])
            out.append(unpack_bits(data[a:a + -(-count * self.width // 8)], count, self.width))
        return np.concatenate(out)[begin - first * self.block_ids:end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class _SpacedWords(dict):
    """Ids (as bytes) of words with a space in front, encoded when first met.
    Bounded: the words met since the last turn, and those of the turn before."""

    def __init__(self, path: str, most: int):
        super().__init__()
        self.tok, self.spaced = load_tokenizer(path), begins_with_space(path)
        self.parts = word_parts if cuts_at_classes(path) else lambda word: None
        self.most, self.before, self.inner = most, {}, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = array("I", self.tok.encode(" " + word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def many(self, words: list[str]) -> list[bytes]:
        """Ids of each word. New words are cut into parts, so that a word met
        before is not encoded again with a stop or a line behind it, and encoded
        in runs: in a run, a word's first piece is the only one of it that
        begins with a space."""
        found = [*map(self.get, words)]
        if None not in found:
            return found
        cut, new = [], {}
        for w in dict.fromkeys(w for w, ids in zip(words, found) if ids is None):
            if w in self.before:
                continue
            parts = None if w.isalpha() else self.parts(w)
            if parts and len(parts) > 1:
                cut.append((w, parts))
                w = parts[0]
                if w in self or w in self.before:
                    continue
            if w and w == w.strip() and " " not in w:
                new[w] = None
        new = [*new]
        for a in range(0, len(new), RUN_WORDS):
            run = new[a:a + RUN_WORDS]
            [made] = self.tok.encode_batch_fast([" " + " ".join(run)], add_special_tokens=False)
            raw = array("I", made.ids).tobytes()
            ends = np.flatnonzero(self.spaced[np.frombuffer(raw, np.uint32)])
            if len(ends) == len(run):  # else a special token took a space: one by one
                ends = [*(4 * ends).tolist(), len(raw)]
                self.update((w, raw[x:y]) for w, x, y in zip(run, ends, ends[1:]))
        inner = self.inner  # parts without a space in front
        if cut and (new := [*{p: None for _, parts in cut for p in parts[1:] if p not in inner}]):
            made = self.tok.encode_batch_fast(new, add_special_tokens=False)
            inner.update((p, array("I", m.ids).tobytes()) for p, m in zip(new, made))
        for w, parts in cut:
            self[w] = self[parts[0]] + b"".join([inner[p] for p in parts[1:]])
        return [self[w] if ids is None else ids for w, ids in zip(words, found)]

    def turn(self) -> None:
        if len(self) > self.most // 2:
            self.before = dict(self)
            self.clear()
        if len(self.inner) > self.most // 8:
            self.inner.clear()


@lru_cache(maxsize=1)
def _spaced_words(path: str, most: int) -> _SpacedWords:
    """Kept from task to task of a Python worker."""
    return _SpacedWords(path, most)


class WordCache:
    """Encodes whole texts, looking up the words met before in this worker."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        self.tok, self.words = load_tokenizer(path), _spaced_words(path, most)

    def encode(self, text: str) -> np.ndarray:
        words = split_words(text)
        first = array("I", self.tok.encode(words[0], add_special_tokens=False).ids).tobytes()
        ids = first + b"".join(self.words.many(words[1:]))
        self.words.turn()
        return np.frombuffer(ids, np.uint32)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, *, doc_id: str = "doc_id",
                      text: str = "text", end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write every row's ids and ``end_id`` in ascending ``doc_id`` order;
    returns the manifest with ``start``, the ids in all files before each."""
    width = bits_for(max(vocabulary_size(tokenizer), end_id + 1))

    def run(batches):
        cache, out, serial, path = WordCache(tokenizer), None, 0, None
        end = np.array([end_id], np.uint32)
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()

        def close():
            n_bytes = out.close()
            return pa.RecordBatch.from_arrays([
                pa.array([path]), pa.array([pid], pa.int32()), pa.array([serial], pa.int32()),
                pa.array([out.n_ids]), pa.array([len(out.starts)]), pa.array([n_bytes])],
                names=["path", "pid", "serial", "n_ids", "n_docs", "n_bytes"])

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    path = f"{folder}/{shared_files.attempt_name(serial)}.tpk"
                    out = Writer(shared_files.create(path), width)
                out.add(d, np.concatenate([cache.encode(t.as_py() or ""), end]))
                if out.n_ids >= file_ids:
                    yield close()
                    out, serial = None, serial + 1
        if out is not None:
            yield close()

    # the last column spreads repeated rows, whose order does not matter
    source = docs.select(F.col(doc_id).cast("bigint").alias("_d"), F.col(text).alias("_t")).withColumns(
        {"_h": F.xxhash64("_t"), "_s": F.monotonically_increasing_id()})
    order = [F.col("_d").asc_nulls_first(), F.col("_h"), F.col("_s")]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).select("_d", "_t")
    manifest = write_and_reread(ranged.mapInArrow(run, MANIFEST), "token-manifest")
    # one row per partition, then one window per partition
    parts = manifest.groupBy("pid").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("pid").orderBy("serial").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("_inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(F.broadcast(parts), "pid")
            .select("path", (F.col("_before") + F.col("_inside")).cast("bigint").alias("start"), "n_ids", "n_docs"))


MAX_READ_TASKS = 20_000


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` (little-endian unsigned 32-bit) of every document
    in the files; ``start`` counts the ids of all documents before it."""
    n = manifest.count()

    def run(batches):
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with shared_files.read(path) as f:
                    r = Reader(f)
                    k = 0
                    while k < len(r.doc_ids):
                        # documents of about a million ids at a time, one at least
                        m = max(k + 1, int(np.searchsorted(r.starts, r.starts[k] + (1 << 20))) - 1)
                        flat = r.ids(int(r.starts[k]), int(r.starts[m])).astype("<u4").tobytes()
                        cut = ((r.starts[k:m + 1] - r.starts[k]) * 4).tolist()
                        yield pa.RecordBatch.from_arrays([
                            pa.array(r.doc_ids[k:m], pa.int64()), pa.array(r.starts[k:m] + base),
                            pa.array([flat[x:y] for x, y in zip(cut, cut[1:])], pa.binary())],
                            names=["doc_id", "start", "ids"])
                        k = m

    return (manifest.select("path", "start").repartition(max(1, min(n, MAX_READ_TASKS)))
            .mapInArrow(run, "doc_id bigint, start bigint, ids binary"))
