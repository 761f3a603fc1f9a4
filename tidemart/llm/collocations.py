"""Phrase collocation mining (op 11).

Every candidate phrase is counted exactly by tries: the candidates are dealt out
by their first two words to blocks of bounded size, each of which becomes a
double-array trie in a task of its own; the text positions at which a phrase may
begin are dealt out alike, in one pass over the texts whatever the number of
blocks, and the task advances their states together, level by level.

The candidates are Apriori-safe. Words are counted first. A pair of words is
counted (by 64 bits of the words' keys, so never too low) where both words are frequent,
a longer phrase where both phrases one word shorter are. "Frequent" is asked of
a bit set of bounded size that never misses a frequent phrase. So no phrase with
``min_count`` occurrences is left out, and what is wrongly let in is counted
exactly by the tries and goes then.

Groups (``lang``) may be of any size: counts are pre-aggregated in the tasks and
keyed by word, the ranking is one global order cut by offsets.

Defined results: a NULL text is empty; a NULL language is ``und`` and joins the
documents that say so; repeated rows all count; ties follow the phrase's bytes;
an empty table gives no rows; further columns are ignored. Inside the tries words
are known by 128-bit keys of language and spelling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_positions
from . import bit_filter, phrase_trie
from .common import release_memory, write_and_reread
from .word_arrays import byte_classes, in_groups, keys_in_groups, slices, word_keys, words_of

CLASSES = byte_classes(gaps=b" \t", breaks=b".,;:!?\n\x0b\x0c\r")
UNKNOWN_LANG = "und"
MIN_COUNT = 10
LONGEST = 3
KEEP_INSIDE_PERCENT = 50
TOP = 2000
#: Text that a task turns into arrays at once.
SLICE_BYTES = 4 << 20
#: Phrases of one trie, on average: its size bounds what a task holds.
BLOCK_PHRASES = 1 << 17


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash of two that stand in a row (the right one turned by 21 bits)."""
    r = right.view(np.uint64)
    return left ^ ((r << np.uint64(21)) | (r >> np.uint64(43))).view(np.int64)


def _mix_column(left: Column, right: Column) -> Column:
    turned = F.shiftleft(right, 21).bitwiseOR(F.shiftrightunsigned(right, 43))
    return left.bitwiseXOR(turned)


def _sliced(batches, work):
    """``work(words, ids, langs, group, word)`` for every slice: word ids are
    told apart by language; ``group`` (a place in ``langs``) and ``word`` (a
    place in the spellings) are those of each id."""
    for b in batches:
        for part in slices(b, 1, SLICE_BYTES):
            words = words_of(part.column(1), CLASSES)
            if len(words.ids):
                named = part.column(0).dictionary_encode()
                ids, group, word = in_groups(words, named.indices.to_numpy(zero_copy_only=False))
                yield from work(words, ids, named.dictionary, group, word)
    release_memory()


def _keys(words, langs, group, word) -> np.ndarray:
    return keys_in_groups(word_keys(words.spelt), langs.to_pylist(), group, word)


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.col(text).alias("text")).filter(F.col("text") != "")


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, n: all words of ``texts`` (lang, text)."""
    def run(batches):
        def work(words, ids, langs, group, word):
            n = np.bincount(ids, minlength=len(word))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(group)).cast(pa.string()),
                 words.spelt.take(pa.array(word)).cast(pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "word", "n"])
        yield from _sliced(batches, work)

    part = texts.mapInArrow(run, "lang string, word string, n long")
    return part.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def keyed_words(words: DataFrame) -> DataFrame:
    """``words`` (lang, word, n) with their 128-bit key as k1 and k2."""
    def run(batches):
        for b in batches:
            named = b.column(0).dictionary_encode()
            keys = keys_in_groups(word_keys(b.column(1)), named.dictionary.to_pylist(),
                                  named.indices.to_numpy(zero_copy_only=False), np.arange(b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])],
                                             names=["lang", "word", "n", "k1", "k2"])

    return words.select("lang", "word", "n").mapInArrow(run, "lang string, word string, n long, k1 long, k2 long")


def _gram_counts(texts: DataFrame, words: int, frequent, min_count: int) -> DataFrame:
    """h1, h2, ...: word hashes of the phrases of ``words`` words that may have
    ``min_count`` occurrences: both phrases one word shorter are in the bit set
    ``frequent`` (a broadcast)."""
    names = [f"h{k}" for k in range(1, words + 1)]

    def run(batches):
        def work(found, ids, langs, group, word):
            h = np.ascontiguousarray(_keys(found, langs, group, word)[:, 0])
            size = np.int64(len(word))
            place = np.flatnonzero(found.joined)
            if words == 2:
                good = bit_filter.contains(frequent.value, h)[ids]
                place = place[good[place] & good[place + 1]]
                same = ids[place] * size + ids[place + 1]
            else:
                pair = np.zeros(len(ids), bool)
                mixed = _mix(h[ids[place]], h[ids[place + 1]])
                pair[place] = bit_filter.contains(frequent.value, mixed)
                place = place[pair[place] & pair[np.minimum(place + 1, len(ids) - 1)]]
                _, head = np.unique(ids[place] * size + ids[place + 1], return_inverse=True)
                same = head * size + ids[place + 2]
            _, at, n = np.unique(same, return_index=True, return_counts=True)
            cols = [pa.array(h[ids[place[at] + k]]) for k in range(words)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n)], names=[*names, "n"])
        yield from _sliced(batches, work)

    part = texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))
    return part.groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).select(*names)


def candidates(texts: DataFrame, words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, w1, w2, w3 (NULL in pairs) and the words' keys (k11, k12, k21, ...):
    a superset of the phrases of two and three words that occur ``min_count``
    times. ``words``: lang, word, n."""
    spark = texts.sparkSession
    common = write_and_reread(keyed_words(words.filter(F.col("n") >= min_count)), "common-words")
    frequent = spark.sparkContext.broadcast(bit_filter.build(common, "k1"))
    pairs = write_and_reread(_gram_counts(texts, 2, frequent, min_count), "pairs")
    frequent.unpersist()
    mixed = pairs.select(_mix_column(F.col("h1"), F.col("h2")).alias("h"))
    twos = spark.sparkContext.broadcast(bit_filter.build(mixed, "h"))
    triples = _gram_counts(texts, 3, twos, min_count)

    def named(k: int) -> DataFrame:
        return common.select(F.col("lang").alias(f"lang{k}"), F.col("word").alias(f"w{k}"), F.col("k1").alias(f"h{k}"),
                             F.col("k1").alias(f"k{k}1"), F.col("k2").alias(f"k{k}2"))

    def spelt(grams: DataFrame, words: int) -> DataFrame:
        for k in range(1, words + 1):
            grams = grams.join(named(k), f"h{k}")
        same = " and ".join(f"lang{k} = lang1" for k in range(2, words + 1))
        return grams.filter(same).withColumnRenamed("lang1", "lang")

    three = spelt(triples, 3).select("lang", "w1", "w2", "w3", *_PATH)
    two = spelt(pairs, 2).select("lang", "w1", "w2", *[c for c in _PATH if c[1] != "3"])
    return two.unionByName(three, allowMissingColumns=True).select("lang", "w1", "w2", "w3", *_PATH)


#: Columns of a phrase's word keys, two a word.
_PATH = [f"k{k}{i}" for k in range(1, LONGEST + 1) for i in (1, 2)]


def _as_bytes(keys: np.ndarray) -> np.ndarray:
    """Rows of int64 pairs as rows of 16-byte keys."""
    return np.ascontiguousarray(keys).view("S16")


def phrase_counts(texts: DataFrame, phrases: DataFrame, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """``phrases`` (as ``candidates`` gives them) plus ``f``: all their
    occurrences in ``texts``; phrases that do not occur are left out.

    Phrases are dealt out to blocks by their first two words, and so are, in one
    pass over the texts, the places at which one may begin. Each block is one
    task, which builds the trie of its phrases and runs its places through it."""
    spark = texts.sparkSession
    spelt = [f"w{k}" for k in range(1, LONGEST + 1)]
    phrases = write_and_reread(phrases, "candidates")
    total = phrases.count()
    if not total:
        return phrases.drop(*_PATH).withColumn("f", F.lit(None).cast("long")).limit(0)
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // block_phrases))
    pair = _mix_column(F.col("k11"), F.col("k21"))
    triple = _mix_column(F.col("k11"), _mix_column(F.col("k21"), F.col("k31")))
    known = phrases.select(F.when(F.col("w3").isNull(), pair).otherwise(triple).alias("h"))
    wanted = spark.sparkContext.broadcast(bit_filter.build(known, "h"))
    both = phrases.withColumn("block", F.pmod(pair, F.lit(blocks)).cast("int")).unionByName(
        _places(texts, wanted, blocks), allowMissingColumns=True)
    dealt = both.repartitionById(blocks, F.col("block")).sortWithinPartitions(F.col("paths").isNotNull())
    columns = ["lang", *spelt, *_PATH, "keys", "paths", "times"]
    schema = ", ".join(f"{c} string" for c in ["lang", *spelt]) + ", f long"
    counted = write_and_reread(dealt.select(*columns).mapInArrow(_counted, schema), "phrase-counts")
    wanted.unpersist()
    return counted


def _places(texts: DataFrame, wanted, blocks: int) -> DataFrame:
    """block, keys, paths, times: for each slice of text and block, the distinct
    runs of words that may begin with one of the block's phrases (those whose hash
    is in the bit set ``wanted``, a broadcast). ``keys``: 16 bytes a word;
    ``paths``: first, second and third words as places among the keys, from 1 (0:
    the run has two words); ``times``: how often each run occurs."""
    def packed(keys: np.ndarray, path: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes, bytes]:
        used = np.unique(path[path >= 0])
        local = np.where(path >= 0, np.searchsorted(used, path) + 1, 0)
        size = np.uint16 if len(used) < 1 << 16 else np.uint32
        return keys[used].tobytes(), local.astype(size).tobytes(), times.astype(np.uint32).tobytes()

    def run(batches):
        def work(found, ids, langs, group, word):
            keys = _keys(found, langs, group, word)
            h = np.ascontiguousarray(keys[:, 0])
            at = np.flatnonzero(found.joined)
            second, third = ids[at + 1], ids[np.minimum(at + 2, len(ids) - 1)]
            pair = _mix(h[ids[at]], h[second])
            triple = _mix(h[ids[at]], _mix(h[second], h[third]))
            three = found.joined[at + 1] & bit_filter.contains(wanted.value, triple)
            some = np.flatnonzero(three | bit_filter.contains(wanted.value, pair))
            if not len(some):
                return
            path = np.stack([ids[at], second, np.where(three, third, -1)])[:, some]
            _, head = np.unique(path[0] * np.int64(len(word)) + path[1], return_inverse=True)
            _, once, times = np.unique(head * np.int64(len(word) + 1) + path[2] + 1, return_index=True, return_counts=True)
            block = pair[some[once]] % blocks
            order = np.argsort(block, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(block[order])) + 1)
            rows = [packed(keys, path[:, once[p]], times[p]) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array([block[p[0]] for p in parts], np.int32)), *map(pa.array, zip(*rows))],
                names=["block", "keys", "paths", "times"])
        yield from _sliced(batches, work)

    return texts.mapInArrow(run, "block int, keys binary, paths binary, times binary")


def _counted(batches):
    """The counts of one block: its phrases come first, then its places."""
    phrases, trie, total = [], None, None
    for b in batches:
        ours = pc.is_null(b.column("paths"))
        phrases.append(b.filter(ours).select(range(1 + LONGEST + len(_PATH))))
        places = b.filter(pc.invert(ours))
        if not places.num_rows:
            continue
        if trie is None:
            known = pa.Table.from_batches(phrases).combine_chunks()
            trie, total = _trie_of(known), np.zeros(known.num_rows, np.int64)
        for keys, paths, times in zip(*(places.column(c) for c in ("keys", "paths", "times"))):
            times = np.frombuffer(times.as_buffer(), np.uint32)
            size = np.uint16 if paths.as_buffer().size == 2 * LONGEST * len(times) else np.uint32
            path = np.frombuffer(paths.as_buffer(), size).reshape(LONGEST, -1)
            symbols = np.append(-1, trie.symbols_of(np.frombuffer(keys.as_buffer(), "S16")))[path.T]
            joined = np.ones(path.T.shape, bool)
            joined[:, -1] = False
            trie.add_phrases(total, symbols.ravel(), joined.ravel(), LONGEST, np.arange(0, path.size, LONGEST), times)
    if trie is not None:
        there = np.flatnonzero(total)
        out = known.take(pa.array(there)).combine_chunks()
        for part in out.select(range(1 + LONGEST)).append_column("f", pa.array(total[there])).to_batches():
            yield part
    del phrases, trie
    release_memory()


def _trie_of(phrases: pa.Table) -> phrase_trie.Trie:
    """The trie of a block of phrases with their word keys; rows by their place."""
    paths = np.empty((phrases.num_rows, len(_PATH)), np.int64)
    for i, c in enumerate(_PATH):
        paths[:, i] = phrases.column(c).fill_null(0).to_numpy()
    words = LONGEST - phrases.column(f"w{LONGEST}").is_null().to_numpy().astype(int)
    return phrase_trie.build(_as_bytes(paths), words)


def _phrase(first: int, last: int) -> Column:
    return F.concat_ws(" ", *[F.col(f"w{k}") for k in range(first, last + 1)])


def scored_phrases(counted: DataFrame, words: DataFrame) -> DataFrame:
    """``counted`` (lang, w1, w2, w3, f) with phrase, a, l, r and score of the
    weakest cut; scores are exact: floor(10^6 a^2 / (l r)) in 38 digits."""
    parts = (words.select("lang", F.col("word").alias("part"), "n")
             .unionByName(counted.filter("w3 is null").select("lang", _phrase(1, 2).alias("part"), F.col("f").alias("n"))))

    def side(name: str, n: str) -> DataFrame:
        return parts.select("lang", F.col("part").alias(name), F.col("n").alias(n))

    def cut(k: int, left: Column, right: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), left.alias("head"), right.alias("tail"))

    cuts = F.when(F.col("w3").isNull(), F.array(cut(1, F.col("w1"), F.col("w2")))).otherwise(
        F.array(cut(1, F.col("w1"), _phrase(2, 3)), cut(2, _phrase(1, 2), F.col("w3"))))
    rows = (counted.select("lang", "w1", "w2", "w3", F.col("f").alias("a"), F.explode(cuts).alias("cut"))
            .select("lang", "w1", "w2", "w3", "a", "cut.*")
            .join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]))
    big = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")}
    rows = rows.select("*", (F.lit(1000000).cast("decimal(38,0)") * big["a"] * big["a"]).alias("top"),
                       (big["l"] * big["r"]).alias("bottom")).withColumn("score", F.expr("top div bottom"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    return (rows.groupBy("lang", "w1", "w2", "w3", "a").agg(least)
            .select("lang", "w1", "w2", "w3", _phrase(1, 3).alias("phrase"), "a", "least.l", "least.r", "least.score"))


def collocations(docs: DataFrame, *, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                 keep_inside_percent: int = KEEP_INSIDE_PERCENT, top: int = TOP,
                 block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    texts = _texts(docs, lang, text)
    words = write_and_reread(word_counts(texts), "words")
    counted = phrase_counts(texts, candidates(texts, words, min_count), block_phrases)
    counted = write_and_reread(counted.filter(F.col("f") >= min_count), "counted")
    inside = F.explode(F.array(F.struct(F.col("w1").alias("a"), F.col("w2").alias("b")),
                               F.struct(F.col("w2").alias("a"), F.col("w3").alias("b"))))
    longer = (counted.filter("w3 is not null").select("lang", "f", inside.alias("p"))
              .groupBy("lang", F.col("p.a").alias("w1"), F.col("p.b").alias("w2")).agg(F.max("f").alias("most")))
    kept = (scored_phrases(counted, words).join(longer, ["lang", "w1", "w2"], "left")
            .filter(F.col("w3").isNotNull() | F.col("most").isNull()
                    | (100 * F.col("most") < keep_inside_percent * F.col("a")))
            .select("lang", "phrase", "a", "l", "r", "score"))
    placed = with_positions(kept, ["lang", F.desc("score"), F.desc("a"), "phrase"])
    first = placed.groupBy("lang").agg(F.min("position").alias("first"))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = (placed.join(first, "lang").withColumn("rank", F.col("position") - F.col("first") + 1)
              .filter(F.col("rank") <= top).join(sizes, "lang"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
