"""Line dedup over a corpus (op 2).

Lines become 128-bit hashes of their keys, range-partitioned by (hash,
document) with a secondary sort by document and position. One pass streams each
partition and decides, run by run, which occurrences go; only these positions
leave the pass, and they come back per document as a compressed bitmap of the
lines to keep, never as text. A hash that reaches over a partition border is
settled from per-partition counts (at most two runs per partition).

A key is the line with ASCII white space stripped at both ends and A-Z
lower-cased; lines whose key is shorter than ``min_key_chars`` always stay.
Modes: ``all`` drops every line whose key stands in ``min_docs`` documents or
more; ``first`` keeps the first occurrence in (document, position) order and
drops the later ones of such keys.

Defined results: NULL and empty text are one empty line. A document is a
distinct (id, text): repeated rows count as one document and each row gets the
same result; rows that share only the id are different documents. An empty
table gives no rows. Extra columns pass through ``apply`` untouched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_key, write_and_reread

WHITE = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10

_EVENTS = ("kind int, h1 bigint, h2 bigint, k1 bigint, k2 bigint, pos int, pid int, n_docs bigint")
DROP, OPEN, EDGE = 0, 1, 2


def line_hashes(docs: DataFrame, min_key_chars: int) -> DataFrame:
    """(hash, document, position) of every line that has a key, for ``docs``
    with columns doc, k1, k2, text."""

    def run(batches):
        import xxhash

        for b in batches:
            digests, counts, places = [], [], []
            for body in b.column(3):
                keys = [x.strip(WHITE).lower() for x in (body.as_py() or "").encode().split(b"\n")]
                if min_key_chars > 1:
                    at = [i for i, x in enumerate(keys) if len(x.decode()) >= min_key_chars]
                else:
                    at = [i for i, x in enumerate(keys) if len(x) >= min_key_chars]
                digests.extend(xxhash.xxh3_128_digest(keys[i]) for i in at)
                places.extend(at)
                counts.append(len(at))
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            of = pa.array(np.repeat(np.arange(b.num_rows), counts))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])),
                *[b.column(i).take(of) for i in range(3)],
                pa.array(np.array(places, dtype=np.int32))],
                names=["h1", "h2", "doc", "k1", "k2", "pos"])

    doc = T.StructField("doc", docs.schema["doc"].dataType)
    longs = [T.StructField(c, T.LongType()) for c in ("h1", "h2", "k1", "k2")]
    schema = T.StructType([*longs[:2], doc, *longs[2:], T.StructField("pos", T.IntegerType())])
    return docs.select("doc", "k1", "k2", "text").mapInArrow(run, schema)


class _Run:
    """Rows of one hash inside a partition, as they arrive. Rows are held only
    until the run has ``min_docs`` documents, so those of fewer documents."""

    def __init__(self, head, leads, min_docs, first, emit):
        self.head, self.leads = head, leads
        self.min_docs, self.first, self.emit = min_docs, first, emit
        self.held, self.n_docs, self.decided = None, 0, False

    def extend(self, cols, n_docs):
        self.n_docs += n_docs
        if self.decided:
            return [self.emit(DROP, cols)]
        self.held = cols if self.held is None else [np.concatenate(p) for p in zip(self.held, cols)]
        if self.n_docs < self.min_docs:
            return []
        self.decided = True
        gone, self.held = [c[1 if self.first else 0:] for c in self.held], None
        return [self.emit(DROP, gone)] if len(gone[0]) else []

    def finish(self, is_last):
        """A run that reaches over a border leaves its count, and the rows it
        could not decide; a later part of a run does not know if its head is
        the first occurrence either."""
        out, edge = [], self.leads or is_last
        if self.decided:
            if self.first and self.leads:
                out.append(self.emit(OPEN, self.head))
        elif edge:
            out.append(self.emit(OPEN, self.held))
        if edge:
            out.append(self.emit(EDGE, self.head, self.n_docs))
        return out


def _stream(min_docs: int, first: bool):
    """The pass over a sorted partition (h1, h2, k1, k2, pos): rows to drop,
    rows a border leaves open, and the counts of the runs at the borders."""

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        names = ["kind", "h1", "h2", "k1", "k2", "pos", "pid", "n_docs"]
        types = [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int64()]

        def emit(kind, cols, n_docs=0):
            n = len(cols[0])
            full = [np.full(n, kind), *cols, np.full(n, pid), np.full(n, n_docs)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)).cast(t) for c, t in zip(full, types)], names=names)

        cur, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy() for i in range(5)]
            h1, h2, k1, k2, _ = cols
            new_run = np.ones(len(h1), bool)
            new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new_run.copy()
            new_doc[1:] |= (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            goes_on = last is not None and last[:2] == (h1[0], h2[0])
            if goes_on:
                new_doc[0] = last[2:] != (k1[0], k2[0])
            last = (h1[-1], h2[-1], k1[-1], k2[-1])
            starts = np.flatnonzero(new_run)
            ends = np.append(starts[1:], len(h1))
            n_docs = np.add.reduceat(new_doc.astype(np.int64), starts)

            def part(i):
                return [c[starts[i]:ends[i]] for c in cols]

            def begin(i, leads):
                r = _Run([c[:1] for c in part(i)], leads, min_docs, first, emit)
                return r, r.extend(part(i), int(n_docs[i]))

            if goes_on:
                yield from cur.extend(part(0), int(n_docs[0]))
            else:
                if cur is not None:
                    yield from cur.finish(False)
                cur, shown = begin(0, cur is None)
                yield from shown
            if len(starts) > 1:
                yield from cur.finish(False)
                inner = np.arange(1, len(starts) - 1)
                big = inner[n_docs[inner] >= min_docs]
                if len(big):
                    pick = np.concatenate([np.arange(starts[i] + first, ends[i]) for i in big])
                    if len(pick):
                        yield emit(DROP, [c[pick] for c in cols])
                cur, shown = begin(len(starts) - 1, False)
                yield from shown
        if cur is not None:
            yield from cur.finish(True)

    return run


def dropped_lines(docs: DataFrame, *, min_docs: int = MIN_DOCS, min_key_chars: int = 1,
                  mode: str = "all") -> DataFrame:
    """``k1, k2, pos`` of every line to drop, for ``docs`` (doc, k1, k2, text)."""
    if mode not in ("all", "first"):
        raise ValueError(f"mode is 'all' or 'first', not {mode!r}")
    # the document belongs to the range, so a frequent line spreads over many
    # partitions; one document's equal lines stay together
    order = ["h1", "h2", "doc", "k1", "k2"]
    lines = (line_hashes(docs, min_key_chars).repartitionByRange(*order)
             .sortWithinPartitions(*order, "pos").select("h1", "h2", "k1", "k2", "pos"))
    events = write_and_reread(
        lines.mapInArrow(_stream(min_docs, mode == "first"), _EVENTS), "line-events")
    sure = events.filter(F.col("kind") == DROP).select("k1", "k2", "pos")
    pending = events.filter(F.col("kind") == OPEN)
    # partitions follow the order, so the head of the first one is the first occurrence
    totals = events.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("total"),
        F.min_by(F.struct("k1", "k2", "pos"), "pid").alias("head")).filter(F.col("total") >= min_docs)
    late = pending.join(totals, ["h1", "h2"])
    if mode == "first":
        late = late.filter(F.struct("k1", "k2", "pos") != F.col("head"))
    return sure.unionByName(late.select("k1", "k2", "pos"))


def keep_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """``k1, k2, dropped`` (zlib-compressed little-endian bitmap, bit i set
    where line i goes, trailing zero bytes left out) for documents that lose a
    line; every other document keeps all."""

    def pack(places):
        mask = np.zeros(int(max(places)) + 1, np.uint8)
        mask[np.asarray(places)] = 1
        return zlib.compress(np.packbits(mask, bitorder="little").tobytes(), 6)

    @F.pandas_udf("binary")
    def bitmap(places: pd.Series) -> pd.Series:
        return places.map(pack)

    gone = dropped_lines(docs, **options).groupBy("k1", "k2").agg(F.collect_set("pos").alias("places"))
    return gone.select("k1", "k2", bitmap("places").alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` (with row keys) plus ``kept_text``, ``n_lines``, ``n_dropped``."""
    @F.pandas_udf("kept_text string, n_lines bigint, n_dropped bigint")
    def kept(body: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        out = []
        for t, z in zip(body, dropped):
            lines = (t or "").split("\n")
            if z is None:
                out.append((t or "", len(lines), 0))
                continue
            bits = np.unpackbits(np.frombuffer(zlib.decompress(z), np.uint8), bitorder="little")
            stay = [x for i, x in enumerate(lines) if i >= len(bits) or not bits[i]]
            out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
        return pd.DataFrame(out, columns=["kept_text", "n_lines", "n_dropped"])

    return docs.join(bitmaps, ["k1", "k2"], "left").withColumn("_kept", kept(F.col(text), "dropped"))


def line_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
               min_docs: int = MIN_DOCS, min_key_chars: int = 1, mode: str = "all") -> DataFrame:
    """``row`` (the input's columns), ``kept_text``, ``n_lines``, ``n_dropped``
    for every input row."""
    keyed = docs.select(F.struct("*").alias("row"), *row_key(F.col(doc_id), F.col(text)),
                        F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    maps = keep_bitmaps(keyed.select("doc", "k1", "k2", "text"), min_docs=min_docs,
                        min_key_chars=min_key_chars, mode=mode)
    done = apply_bitmaps(keyed.select("row", "k1", "k2", "text"), maps)
    return done.select("row", "_kept.kept_text", "_kept.n_lines", "_kept.n_dropped")
