"""SimHash near-dedup with pigeonhole blocks (op 10).

A 64-bit fingerprint is cut into ``blocks`` parts; two fingerprints at most
``max_bits`` bits apart share at least ``blocks - max_bits`` whole parts, so
joining on every choice of that many parts finds all pairs, and the Hamming
distance decides. The work is on distinct fingerprints. A bucket larger than
``PAIR_BUCKET`` would give quadratically many pairs; there, and only there, the
links are found through the bit flips of the bucket's free parts: fingerprints
that meet at a common point ``max_bits // 2`` flips away are linked exactly,
and need no pairs. Both ways find every link.

Defined results: NULL text has no words; a text without words has fingerprint
zero, linked like any other; repeated rows share their fingerprint and
component; the component id is the smallest non-NULL doc_id (NULL if there is
none); an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release_memory, row_key, write_and_reread
from .components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
BLOCKS = 4
PAIR_BUCKET = 64


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: ASCII lower case, words between ASCII white space,
    XXH64 of each word shingle, majority per bit."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start = (end - size).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(start, end[shingle_words - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without ``text`` plus ``fp`` (bigint)."""
    rest = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py() or "", shingle_words) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=[*b.schema.names[:-1], "fp"])
        release_memory()

    return docs.select(*rest, text).mapInArrow(run, schema)


def _parts(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each part; widths differ by one at most."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(parts) -> int:
    return sum(((1 << w) - 1) << s for s, w in parts)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fps: DataFrame, *, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
               pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints (``fp``) such that two of
    them are connected exactly if a chain of pairs at most ``max_bits`` apart
    connects them."""
    if not 0 < max_bits < blocks:
        raise ValueError("blocks must exceed max_bits, and max_bits be positive")
    parts = _parts(blocks)
    choices = list(combinations(range(blocks), blocks - max_bits))
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(
        F.lit(_signed(_mask([parts[p] for p in c])))).alias("part")) for i, c in enumerate(choices)])
    rows = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.choice", "key.part")
    sizes = rows.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = write_and_reread(rows.join(sizes, ["choice", "part"]), "buckets")

    def apart(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b))

    small = shared.filter(F.col("n") <= pair_bucket)
    other = small.select("choice", "part", F.col("fp").alias("v"))
    pairs = (small.join(other, (small["choice"] == other["choice"]) & (small["part"] == other["part"])
                        & (F.col("v") < F.col("fp")) & (apart(F.col("fp"), F.col("v")) <= max_bits))
             .select(F.col("fp").alias("u"), "v"))
    return pairs.unionByName(_meeting_links(shared.filter(F.col("n") > pair_bucket), parts, choices, max_bits))


def _meeting_links(crowded: DataFrame, parts, choices, max_bits: int) -> DataFrame:
    """Links in large buckets. With r = max_bits // 2, every member visits all
    points at most r flips away in its bucket's free bits; members that visit
    the same point are at most 2r apart and hang on the smallest of them. For
    odd ``max_bits`` every flip of one more bit is tested against the points
    of the others, which finds distance 2r + 1 too."""
    r, odd = divmod(max_bits, 2)
    flips = []
    for c in choices:
        free = [s + k for i, (s, w) in enumerate(parts) if i not in c for k in range(w)]
        flips.append([_signed(sum(1 << b for b in f)) for n in range(r + 1) for f in combinations(free, n)])
    by_choice = F.array(*[F.array(*[F.lit(x) for x in f]) for f in flips])
    visits = crowded.select("choice", "part", "fp", F.explode(F.get(by_choice, F.col("choice"))).alias("flip"))
    visits = visits.select("choice", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    low = visits.groupBy("choice", "point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
    met = low.filter("n > 1").select("choice", "point", "v")
    links = visits.join(met, ["choice", "point"]).select(F.col("fp").alias("u"), "v").filter("u != v")
    if odd:
        steps = []
        for c in choices:
            free = [s + k for i, (s, w) in enumerate(parts) if i not in c for k in range(w)]
            steps.append([_signed(1 << b) for b in free])
        one = F.array(*[F.array(*[F.lit(x) for x in f]) for f in steps])
        onward = visits.select("choice", "fp", "point", F.explode(F.get(one, F.col("choice"))).alias("flip"))
        onward = onward.select("choice", F.col("fp").alias("u"),
                               F.col("point").bitwiseXOR(F.col("flip")).alias("point"))
        # all visitors of a point are joined by its smallest one already, if r > 0
        # or the point is a fingerprint itself
        links = links.unionByName(onward.join(low.select("choice", "point", "v"), ["choice", "point"])
                                  .select("u", "v").filter("u != v"))
    return links


def simhash_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, k1, k2, fp, fingerprint, group, component_id, head`` for every
    row; ``group`` is the component's smallest fingerprint, ``head`` (k1, k2) the
    row key of its smallest non-NULL doc_id (then the smallest key)."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), *row_key(F.col(doc_id), F.col(text)),
                        F.col(text).alias("text"))
    marked = write_and_reread(fingerprints(keyed, shingle_words=shingle_words), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    distinct = write_and_reread(marked.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fp")
    comp = connected_components(near_links(distinct.select("fp"), max_bits=max_bits, blocks=blocks))
    grouped = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group"))
    least = grouped.groupBy("group").agg(F.min("first").alias("head"))
    of_fp = write_and_reread(grouped.join(least, "group").select("fp", "group", "head"), "fp-components")
    return marked.join(of_fp, "fp").select(
        "doc_id", "k1", "k2", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "group", F.col("head.doc_id").alias("component_id"), F.struct("head.k1", "head.k2").alias("head"))


#: Keys to drop are broadcast up to this many (16 bytes each); more of them meet
#: the documents in a shuffled join with the same result.
BROADCAST_MAX_KEYS = 500_000


def keep_one_per_group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest
    non-NULL doc_id (then the smallest row key), one of repeated rows.

    Only the keys of rows that go, or are repeated, meet the documents, so the
    texts are not shuffled while there are few of them."""
    groups = simhash_groups(docs, doc_id=doc_id, text=text, **options)
    stays = (F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2"))
    special = write_and_reread(
        groups.select("k1", "k2", stays.alias("_stays")).groupBy("k1", "k2", "_stays")
        .agg(F.count(F.lit(1)).alias("_n")).filter("not _stays or _n > 1").drop("_n"), "dropped-keys")
    if special.count() <= BROADCAST_MAX_KEYS:
        special = F.broadcast(special)
    keyed = docs.select(F.struct("*").alias("row"), *row_key(F.col(doc_id), F.col(text)))
    marked = keyed.join(special, ["k1", "k2"], "left")
    plain = marked.filter("_stays is null").select("row.*")
    repeated = marked.filter("_stays").dropDuplicates(["k1", "k2"]).select("row.*")
    return plain.unionByName(repeated).select(*docs.columns)
