"""Target-distribution importance resampling (op 12).

Every text is a bag of word and word-pair features, hashed to buckets. The log
ratio of the target's and the corpus's bucket shares, averaged over a document's
features, is its weight; with Gumbel noise drawn from the id, the highest scores
are a sample without replacement that follows the target.

Weights are scored on arrays: the words of a slice of texts become one array of
places in the distinct words, pair hashes follow from word hashes by table
look-ups, buckets are counted and gains summed by numpy.

The order is found by parallel sorting by regular sampling: each task's rows are
a sorted run (written, so a lost executor re-reads it); regularly spaced rows of
the runs give the splitters; each row goes to its splitters' segment, which is
merged by a local sort; counts of the segments before give exact ranks. The
place in its run is the last part of a row's key, so a row repeated any number
of times is split like all others.

Bounds: 10,000 buckets reach the driver and are broadcast; ``MAX_SAMPLES`` rows
of samples, or one a run if the runs are more, reach the driver.

Defined results: NULL and word-free texts have weight 0 and are never drawn (as
all documents below ``min_words``); a NULL id counts as an empty string in the
draw and as the smallest id in ties; repeated rows are drawn one by one, rows
with one id and different texts follow a hash of the text; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release_memory, write_and_reread
from .crc_arrays import Pairs
from .word_arrays import Words, byte_classes, slices, words_of

#: Words are runs of digits, letters and bytes beyond ASCII.
CLASSES = byte_classes(gaps=bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 25
SEED = 7
MAX_SAMPLES = 1 << 17


def _features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text (its place in the slice) of every feature."""
    crc = Pairs(words.spellings())
    left = np.flatnonzero(words.joined)
    hashes = np.concatenate([crc.alone[words.ids], crc.crc32(words.ids[left], words.ids[left + 1])])
    text = words.texts
    return hashes % np.uint32(buckets), np.concatenate([text, text[left]])


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts`` per bucket."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in slices(b, 0):
                words = words_of(part.column(0), CLASSES)
                if len(words.ids):
                    total += np.bincount(_features(words, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])
        release_memory()

    rows = texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: 1000 times the log ratio of the smoothed shares, floored."""
    total, wanted = float(corpus.sum()), float(target.sum())
    k = len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (total + k) / ((s + 1) * (wanted + k))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """1000 times a Gumbel draw from the id, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain, *, keep: list[str], doc_id: str = "doc_id", text: str = "text",
             seed: int = SEED) -> DataFrame:
    """``row`` (the columns ``keep``), ``id``, ``tie``, ``n_words``,
    ``n_features``, ``weight`` and ``score`` of every document; ``gain`` is a
    broadcast of ``gains``."""
    out = docs.select(F.struct(*keep).alias("row"), F.col(doc_id).alias("id"),
                      F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"), F.col(text).alias("text"))
    schema = T.StructType([*out.schema.fields[:3], *[T.StructField(c, T.LongType()) for c in (
        "n_words", "n_features", "weight", "score")]])

    def run(batches):
        gain_of = gain.value
        for b in batches:
            for part in slices(b, 3):
                words = words_of(part.column(3), CLASSES)
                n = np.zeros(part.num_rows, np.int64)
                total = np.zeros(part.num_rows, np.int64)
                if len(words.ids):
                    bucket, at = _features(words, len(gain_of))
                    n = np.bincount(at, minlength=len(n))
                    np.add.at(total, at, gain_of[bucket])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                drawn = np.fromiter((noise(x, seed) for x in part.column(1).to_pylist()), np.int64, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(words.counts), pa.array(n), pa.array(weight), pa.array(weight + drawn)],
                    names=schema.names)
        release_memory()

    return out.mapInArrow(run, schema)


# sorting -----------------------------------------------------------------

def _key(score: str = "score") -> list[Column]:
    return [F.desc(score), F.asc_nulls_first("id"), F.asc("tie"), F.asc("place")]


def _key_arrays(score, ident: pa.Array, tie, place) -> list[np.ndarray]:
    """The order of ``_key`` as ascending int64 arrays."""
    def ints(x: pa.Array) -> np.ndarray:
        return x.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)

    return [-ints(score), ident.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), ints(ident), ints(tie), ints(place)]


def segments_of(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """For each key the number of splitters not above it; splitters ascend."""
    n, k = len(keys[0]), len(splitters[0])
    order = np.lexsort([*[np.concatenate([s, x]) for s, x in zip(splitters, keys)]][::-1])
    below = np.cumsum(order < k)
    out = np.empty(n + k, np.int64)
    out[order] = below
    return out[k:]


def _splitters(runs: DataFrame, sizes: DataFrame, n_runs: int, n_segments: int) -> list[np.ndarray]:
    """Regularly spaced rows of the regularly spaced rows of all runs."""
    each = max(1, min(2 * n_segments, MAX_SAMPLES // max(n_runs, 1)))
    step = F.ceil(F.col("n") / F.lit(each))
    samples = (runs.join(F.broadcast(sizes), F.shiftright("place", 33) == F.col("run"))
               .filter(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) % step == F.floor(step / 2))
               .select("score", "id", "tie", "place").toArrow().combine_chunks())
    keys = _key_arrays(*[c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in samples.columns])
    order = np.lexsort(keys[::-1])
    cut = order[[len(order) * i // n_segments for i in range(1, n_segments)]] if len(order) else order
    return [k[cut] for k in keys]


def ranked(scored: DataFrame, n_segments: int | None = None) -> DataFrame:
    """``scored`` (``score``, ``id``, ``tie`` and more) plus ``rank`` from 1 in
    the order of score descending, id, tie."""
    spark = scored.sparkSession
    n_segments = n_segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    runs = write_and_reread(scored.sortWithinPartitions(*_key()[:3]).withColumn("place", place), "runs")
    sizes = write_and_reread(runs.groupBy(F.shiftright("place", 33).alias("run")).agg(F.count(F.lit(1)).alias("n")), "run-sizes")
    cuts = spark.sparkContext.broadcast(_splitters(runs, sizes, sizes.count(), n_segments))
    schema = T.StructType([*runs.schema.fields, T.StructField("segment", T.IntegerType())])
    names = runs.columns
    at = [names.index(c) for c in ("score", "id", "tie", "place")]

    def route(batches):
        for b in batches:
            segment = segments_of(_key_arrays(*[b.column(i) for i in at]), cuts.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(segment.astype(np.int32))], names=[*names, "segment"])

    routed = runs.mapInArrow(route, schema)
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_and_reread(
        routed.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))  # one row a segment
        .select("segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "segments")
    merged = routed.repartitionById(n_segments, F.col("segment"))
    local = F.row_number().over(Window.partitionBy("segment").orderBy(*_key()))
    return (merged.withColumn("local", local).join(F.broadcast(offsets), "segment")
            .withColumn("rank", (F.col("before") + F.col("local")).cast("bigint")).drop("segment", "local", "before", "place"))


def importance_resample(docs: DataFrame, target: DataFrame, *, keep: list[str], doc_id: str = "doc_id",
                        text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
                        min_words: int = MIN_WORDS, draw_percent: int = DRAW_PERCENT, seed: int = SEED,
                        n_segments: int | None = None) -> DataFrame:
    """Every document as ``row`` (the columns ``keep``) with n_words,
    n_features, weight, score and, if it is drawn, its rank."""
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs, text, buckets),
                                              bucket_counts(target, target_text, buckets)))
    scored = write_and_reread(weighted(docs, gain, keep=keep, doc_id=doc_id, text=text, seed=seed), "scored")
    able = scored.filter(F.col("n_words") >= min_words)
    n_drawn = able.count() * draw_percent // 100
    cols = ["row", "n_words", "n_features", "weight", "score"]
    drawn = F.when(F.col("rank") <= n_drawn, F.col("rank"))
    rest = scored.filter(F.col("n_words") < min_words).select(*cols, F.lit(None).cast("bigint").alias("rank"))
    return ranked(able, n_segments).select(*cols, drawn.alias("rank")).unionByName(rest)
