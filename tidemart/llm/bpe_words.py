"""BPE encoding and decoding through a distinct-word table (op 3).

1. ``split``: documents are cut into words (``bpe.split_words``). Each chunk of
   about ``chunk_bytes`` text becomes one row: the place of every word as a
   compressed array of codes into the chunk's own list of distinct words.
2. ``encode``: the chunks' words meet by hash bucket; each distinct word of a
   bucket is encoded once, and its ids go back to every chunk that has it.
3. ``join``: the ids return to the places by a join on the chunk and one
   vectorised gather per chunk. The places are bucketed by chunk when written,
   so only the small word lists are shuffled, never text or places.
4. ``decode``: ids are joined to the id-to-piece table. It has one row per
   vocabulary entry, so it is broadcast (size checked) and joined in arrays;
   ``encode`` does this in the pass of step 3 where the text is wanted at once.

A frequent word is one row per chunk at most, so no word makes a hot task.

Defined results: NULL text is empty and has no ids; repeated rows keep one row
each; a special token's string inside a text is that special token, as the
tokenizer does by default; an empty table gives no rows. Extra columns are
returned where asked for (``keep``).
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from .bpe import load_tokenizer, pieces, split_words
from .common import release_memory

CHUNK_BYTES = 16 << 20
WORD_BUCKETS = 1024           # at least; else 4 for each shuffle partition
CACHED_WORDS = 1_000_000      # of one bucket; beyond it a word may be encoded again
WORDS_AT_ONCE = 100_000
MAX_VOCABULARY = 2_000_000    # of the broadcast id-to-piece table


def pack(a: np.ndarray) -> bytes:
    """Unsigned integers below 2**32, byte plane by byte plane, compressed."""
    return zlib.compress(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[str]) -> bytes:
    """Words one after the other, compressed, behind their packed sizes."""
    raw = [w.encode() for w in words]
    sizes = pack(np.fromiter(map(len, raw), np.uint32, len(raw)))
    return len(sizes).to_bytes(4, "little") + sizes + zlib.compress(b"".join(raw), 6)


def unpack_words(b: bytes) -> list[str]:
    cut = 4 + int.from_bytes(b[:4], "little")
    ends = np.cumsum(unpack(b[4:cut])).tolist()
    raw = zlib.decompress(b[cut:])
    return [raw[a:e].decode() for a, e in zip([0, *ends], ends)]


def word_bucket(word: str, n: int) -> int:
    return zlib.crc32(word.encode()) % n


class _Chunk:
    """Documents gathered so far, as places in a list of distinct words."""

    def __init__(self):
        self.rows: list[pa.Array] = []
        self.words: dict[str, int] = {}
        self.codes, self.sizes, self.bytes = [], [], 0

    def add(self, text: str) -> None:
        words = split_words(text) if text else []
        known = self.words
        head = words[:1]
        codes = [known.setdefault(w, len(known)) for w in head]
        codes += [known.setdefault(" " + w, len(known)) for w in words[1:]]
        self.codes.append(np.array(codes, np.uint32))
        self.sizes.append(len(codes))
        self.bytes += len(text)

    def places(self):
        """(codes, words): the commonest word has code 0, so that codes pack well."""
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.uint32)
        order = np.argsort(-np.bincount(codes, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.words)
        return rank[codes], [words[i] for i in order]


def _split(n_buckets: int, chunk_bytes: int, row_type: pa.DataType):
    """Rows of two kinds: the places of a chunk, and its words per bucket."""

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        chunk, serial = None, 0

        def close():
            name = f"{pid}-{serial}"
            codes, words = chunk.places()
            of = np.array([word_bucket(w, n_buckets) for w in words], np.uint32)
            rows = pa.concat_arrays(chunk.rows) if chunk.rows else pa.array([], row_type)
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([None], pa.int32()), pa.array([None], pa.binary()),
                pa.array([pack(codes)]), pa.array([pack(of)]), pa.array([chunk.sizes], pa.list_(pa.int32())),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=names)
            by = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[by])) + 1
            groups = [g for g in np.split(by, cuts) if len(g)]
            for a in range(0, len(groups), 64):
                part = groups[a:a + 64]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(part)), pa.array([int(of[g[0]]) for g in part], pa.int32()),
                    pa.array([pack_words([words[i] for i in g]) for g in part], pa.binary()),
                    *[pa.nulls(len(part), t) for t in (pa.binary(), pa.binary(), pa.list_(pa.int32()),
                                                       pa.list_(row_type))]], names=names)

        names = ["chunk", "bucket", "words", "codes", "buckets", "sizes", "rows"]
        for b in batches:
            row, text = b.column(0), b.column(1)
            done = 0
            for i, t in enumerate(text):
                if chunk is None:
                    chunk = _Chunk()
                chunk.add(t.as_py() or "")
                if chunk.bytes >= chunk_bytes:
                    chunk.rows.append(row.slice(done, i + 1 - done))
                    yield from close()
                    chunk, serial, done = None, serial + 1, i + 1
            if chunk is not None and done < len(text):
                chunk.rows.append(row.slice(done))
        if chunk is not None:
            yield from close()
        chunk = None
        release_memory()

    return run


def _encode(path: str, cached_words: int):
    """Rows (chunk, bucket, words), sorted by bucket, to (chunk, bucket, ids):
    each distinct word of a bucket is encoded once."""

    def run(batches):
        tok = load_tokenizer(path)
        known, current = {}, None
        for b in batches:
            out = []
            for bucket, words in zip(b.column(1).to_pylist(), b.column(2)):
                if bucket != current or len(known) > cached_words:
                    known, current = {}, bucket
                words = unpack_words(words.as_py())
                new = [w for w in words if w not in known]
                for w, e in zip(new, tok.encode_batch(new, add_special_tokens=False)):
                    known[w] = np.array(e.ids, np.uint32)
                ids = [known[w] for w in words]
                size = np.fromiter(map(len, ids), np.uint32, len(ids))
                out.append(pack(np.concatenate([[len(ids)], size, *ids])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.binary())], names=["chunk", "bucket", "ids"])
        # the next stage of this worker needs no tokenizer
        tok, known = None, {}
        load_tokenizer.cache_clear()
        release_memory()

    return run


def _gather(table):
    """Chunks with their word lists' ids to one row per document; with the text
    back from the ids where there is a broadcast id-to-piece ``table``."""

    def run(batches):
        piece = table and table.value
        for b in batches:
            for k in range(b.num_rows):
                codes, of = unpack(b.column(0)[k].as_py()), unpack(b.column(1)[k].as_py())
                sizes = np.array(b.column(2)[k].as_py(), np.int64)
                rows = b.column(3)[k].values
                lists = b.column(4)[k].as_py() or []
                got = [unpack(x["ids"]) for x in sorted(lists, key=lambda x: x["bucket"])]
                n = [int(x[0]) for x in got]
                length = np.concatenate([x[1:1 + m] for x, m in zip(got, n)]) if got else np.empty(0, np.int64)
                ids = np.concatenate([x[1 + m:] for x, m in zip(got, n)]) if got else np.empty(0, np.uint32)
                length = length.astype(np.int64)
                # word lists stand by bucket; codes name words by their rank
                place = np.empty(len(of), np.int64)
                place[np.argsort(of, kind="stable")] = np.arange(len(of))
                begin = np.cumsum(length) - length
                ends = np.cumsum(sizes)
                # documents in turn, so that only some words are expanded at a time
                a = 0
                while a < len(sizes):
                    lo = int(ends[a] - sizes[a])
                    docs = slice(a, max(a + 1, int(np.searchsorted(ends, lo + WORDS_AT_ONCE))))
                    hi = int(ends[docs][-1])
                    w = place[codes[lo:hi]]
                    n_ids = length[w]
                    total = np.cumsum(n_ids)
                    at = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(begin[w] - total + n_ids, n_ids)
                    flat = ids[at].astype("<u4")
                    bounds = np.concatenate([[0], total])[ends[docs] - lo]
                    offsets = np.concatenate([[0], bounds])
                    out = [rows.slice(a, len(bounds)), pa.Array.from_buffers(pa.binary(), len(bounds), [
                        None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(flat)])]
                    if piece is not None:
                        out.append(pa.array([decode_ids(piece, flat[x:y]) for x, y in
                                             zip(offsets.tolist(), offsets[1:].tolist())], pa.string()))
                    yield pa.RecordBatch.from_arrays(out, names=["row", "ids", "decoded"][:len(out)])
                    a = docs.stop
                codes = of = rows = lists = got = length = ids = place = begin = None
                release_memory()

    return run


def encode(docs: DataFrame, tokenizer: str, *, text: str = "text", keep: list[str],
           piece_rows: DataFrame | None = None, chunk_bytes: int = CHUNK_BYTES,
           n_buckets: int | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids`` (little-endian unsigned 32-bit integers)
    of every row of ``docs``, and with ``piece_rows`` also ``decoded``, as
    ``decode`` gives it. ``tokenizer``: a file all executors can read."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    source = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    row_type = source.schema["row"].dataType
    arrow_row = to_arrow_type(row_type)
    schema = T.StructType([
        T.StructField("chunk", T.StringType()), T.StructField("bucket", T.IntegerType()),
        T.StructField("words", T.BinaryType()), T.StructField("codes", T.BinaryType()),
        T.StructField("buckets", T.BinaryType()), T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("rows", T.ArrayType(row_type))])
    # one pass over the text writes both kinds, bucketed by chunk
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = n_buckets or max(WORD_BUCKETS, 4 * parts)
    (source.mapInArrow(_split(n_buckets, chunk_bytes, arrow_row), schema)
     .write.bucketBy(parts, "chunk").option("compression", "zstd")
     .option("path", work_path(spark, "tables", name)).saveAsTable(name))
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay, the name need not
    words = chunks.filter("bucket is not null").select("chunk", "bucket", "words")
    encoded = (words.repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(_encode(tokenizer, CACHED_WORDS), "chunk string, bucket int, ids binary"))
    lists = encoded.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "ids")).alias("lists"))
    joined = chunks.filter("bucket is null").select("chunk", "codes", "buckets", "sizes", "rows").join(
        lists, "chunk", "left").select("codes", "buckets", "sizes", "rows", "lists")
    table = None if piece_rows is None else _broadcast_pieces(piece_rows)
    out = [T.StructField("row", row_type), T.StructField("ids", T.BinaryType())]
    out += [T.StructField("decoded", T.StringType())] if table else []
    return joined.mapInArrow(_gather(table), T.StructType(out)).select("row.*", *[f.name for f in out[1:]])


def piece_table(spark: SparkSession, tokenizer: str) -> DataFrame:
    """``id, piece`` (bytes) of the vocabulary."""
    return spark.createDataFrame(pieces(tokenizer), "id int, piece binary")


def _broadcast_pieces(piece_rows: DataFrame):
    rows = piece_rows.limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"the id-to-piece table has over {MAX_VOCABULARY} rows")
    return piece_rows.sparkSession.sparkContext.broadcast({r["id"]: bytes(r["piece"]) for r in rows})


def decode_ids(pieces_by_id: dict[int, bytes], ids: np.ndarray) -> str:
    return b"".join(map(pieces_by_id.__getitem__, ids.tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, piece_rows: DataFrame, *, ids: str = "ids") -> DataFrame:
    """``encoded`` plus ``decoded``: the pieces of the ids in order, as UTF-8
    (bytes that are no UTF-8 become U+FFFD). An unknown id is an error."""
    table = _broadcast_pieces(piece_rows)
    at = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        for b in batches:
            texts = [decode_ids(table.value, np.frombuffer(x.as_buffer() or b"", "<u4"))
                     for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
