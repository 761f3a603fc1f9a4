"""Language ID by a linear-chain conditional random field (op 13).

Each word of a text gets a language by forward-backward over the whole text:
word scores come from hashed affixes and letter n-grams and from a lexicon, and
learned transitions say how readily neighbouring words change language, so text
that switches its language is labelled span by span. A document's language is
the one with the largest mean probability over its words, which is its score.

The lexicon counts all words of all learning documents, per hashed word and
language, and is summed by Spark. The weights are fitted on the driver on a
bounded sample: ``SAMPLE_DOCS`` documents a language (those with the smallest
hashes), up to ``SAMPLE_WINDOWS`` runs of ``WINDOW_WORDS`` words from places
spread over the whole text. Sequences are spliced from runs of several
languages, from which the transitions learn what a switch costs. The sample
bounds the fit alone: every document is predicted from its whole text.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0;
so is every text if there is nothing to learn from. A NULL language is not
learned. Repeated rows each get their (equal) result; ties go to the language
that sorts first; an empty table gives no rows. More than ``MAX_LANGUAGES``
learned values are an error, as the lexicon must stay small enough to broadcast.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import chain_crf
from .chain_crf import Sparse, Weights
from .common import release_memory
from .word_arrays import byte_classes, slices, words_of

#: Words are runs of ASCII letters and bytes beyond ASCII.
CLASSES = byte_classes(gaps=bytes([*range(0x00, 0x61), *range(0x7B, 0x80)]))
LETTER = r"\p{L}"
NO_LANG = "und"
FEATURE_BUCKETS = 1 << 15
#: Values of the lexicon: buckets times languages.
LEXICON_VALUES = 1 << 20
MAX_LANGUAGES = 256
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
WINDOW_WORDS = 24
#: Positions of the fit in all: with many languages each has fewer documents.
SAMPLE_POSITIONS = 400_000
_AFFIX = 4


class Model(NamedTuple):
    langs: list[str]
    weights: Weights
    lexicon: np.ndarray  # (buckets, langs)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Never learned from: a fixed fold of the ids (a NULL id is learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


# features ------------------------------------------------------------------

def _hashed(kind: int, *values: np.ndarray) -> np.ndarray:
    h = np.full(len(values[0]), kind + 1, np.uint64)
    for v in values:
        h = (h ^ v.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(FEATURE_BUCKETS)).astype(np.int64)


def features(words: list[bytes]) -> Sparse:
    """Prefixes and suffixes of 1 to 4 bytes, and all runs of 2 and 3 bytes of
    the word with its ends marked (each worth 1 / their number)."""
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    marked = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.int64)
    start = np.cumsum(sizes + 2) - (sizes + 2)
    at, bucket, value = [], [], []

    def add(word, places, worth):
        at.append(word)
        bucket.append(places)
        value.append(worth)

    every = np.arange(n)
    for k in range(1, _AFFIX + 1):
        some = every[sizes >= k]
        head = [marked[start[some] + 1 + i] for i in range(k)]
        tail = [marked[start[some] + 1 + sizes[some] - k + i] for i in range(k)]
        add(some, _hashed(k, *head), np.ones(len(some)))
        add(some, _hashed(8 + k, *tail), np.ones(len(some)))
    owner = np.repeat(every, sizes + 2)
    for k in (2, 3):
        first = np.arange(len(marked) - k + 1) if len(marked) >= k else np.zeros(0, np.int64)
        first = first[owner[first] == owner[first + k - 1]] if len(first) else first
        word = owner[first]
        add(word, _hashed(16 + k, *[marked[first + i] for i in range(k)]), 2.0 / (sizes[word] + 3 - k))
    return Sparse(np.concatenate(at), np.concatenate(bucket), np.concatenate(value), n)


def _buckets(n_langs: int) -> int:
    size = 1 << 18
    while size * n_langs > LEXICON_VALUES and size > 1 << 12:
        size //= 2
    return size


def _lexicon_place(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (buckets - 1)


def _lexicon_values(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Log of a word's rate in each language over its mean rate, both smoothed
    by one occurrence in the smallest language; an unknown word is worth 0."""
    rate = counts / np.maximum(totals, 1)
    floor = 1.0 / max(totals.min(), 1)
    return np.clip(np.log((rate + floor) / (rate.mean(axis=-1, keepdims=True) + floor)), -5, 5)


# learning ------------------------------------------------------------------

def _lexicon_counts(learn: DataFrame, langs: list[str]) -> np.ndarray:
    """(buckets, langs): words of all learning documents."""
    n, buckets = len(langs), _buckets(len(langs))
    number = {x: i for i, x in enumerate(langs)}

    def run(batches):
        total = np.zeros(buckets * n, np.int64)
        for b in batches:
            for part in slices(b, 1):
                words = words_of(part.column(1), CLASSES)
                if len(words.ids):
                    lang = np.array([number[x] for x in part.column(0).to_pylist()])
                    place = _lexicon_place(words.spellings(), buckets)[words.ids]
                    total += np.bincount(place * n + np.repeat(lang, words.counts), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])
        release_memory()

    rows = learn.select("lang", "text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toArrow()
    out = np.zeros(buckets * n, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(buckets, n)


def _windows(learn: DataFrame) -> DataFrame:
    """lang, h, part, run: runs of words, spread evenly over each text."""
    def run(batches):
        for b in batches:
            lang, h, text = b.columns
            for row in range(b.num_rows):
                words = words_of(text.slice(row, 1), CLASSES)
                n = len(words.ids)
                if not n:
                    continue
                spelt = words.spellings()
                pieces = min(SAMPLE_WINDOWS, -(-n // WINDOW_WORDS))
                starts = [(n - WINDOW_WORDS) * i // max(pieces - 1, 1) if n > WINDOW_WORDS else 0 for i in range(pieces)]
                runs = [b" ".join(spelt[i] for i in words.ids[a:a + WINDOW_WORDS]) for a in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang[row].as_py()] * pieces), pa.array([h[row].as_py()] * pieces),
                     pa.array(range(pieces), pa.int32()), pa.array(runs, pa.binary())], names=["lang", "h", "part", "run"])

    return learn.select("lang", "h", "text").mapInArrow(run, "lang string, h long, part int, run binary")


def _sample(learn: DataFrame, docs_each: int) -> list[tuple[str, bytes]]:
    """(lang, run of words) of the ``docs_each`` documents of each language with
    the smallest hashes. Only about twice as many rows are cut and ranked."""
    sizes = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    span = F.lit(float(1 << 64))
    share = F.least(F.lit(1.0), F.lit(2.0 * docs_each + 50) / F.col("docs"))
    near = (learn.join(F.broadcast(sizes), "lang")  # one row a language
            .filter(F.col("h").cast("double") + float(1 << 63) <= span * share))
    last = F.dense_rank().over(Window.partitionBy("lang").orderBy("h"))
    rows = _windows(near).withColumn("nth", last).filter(F.col("nth") <= docs_each)
    # documents of one hash are repeated rows: one of them is enough
    rows = rows.groupBy("lang", "h", "part").agg(F.min("run").alias("run"))
    return [(r["lang"], bytes(r["run"])) for r in rows.orderBy("lang", "h", "part").collect()]


def splice(runs: list[tuple[str, bytes]], langs: list[str], seed: int = 11) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, labels and sequence sizes: every run once, three to a sequence,
    cut to random lengths, so that languages change inside sequences."""
    rng = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(langs)}
    order = rng.permutation(len(runs))
    words, labels, sizes = [], [], []
    for i in range(0, len(order), 3):
        n = 0
        for j in order[i:i + 3]:
            lang, run = runs[j]
            piece = run.split(b" ")
            piece = piece[:int(rng.integers(1, len(piece) + 1))] if len(piece) > 1 and rng.random() < 0.5 else piece
            words += piece
            labels += [number[lang]] * len(piece)
            n += len(piece)
        sizes.append(n)
    return words, np.array(labels, np.int64), np.array(sizes, np.int64)


def learn_model(docs: DataFrame, *, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fit on the rows of ``docs`` with a language; None if there are none."""
    learn = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(
        "lang is not null and text is not null").withColumn("h", F.xxhash64("text"))
    langs = sorted(r["lang"] for r in learn.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn; give labels that are languages")
    if not langs:
        return None
    counts = _lexicon_counts(learn, langs)
    totals = counts.sum(axis=0).astype(float)
    each = max(8, min(sample_docs, SAMPLE_POSITIONS // (len(langs) * SAMPLE_WINDOWS * WINDOW_WORDS)))
    words, labels, sizes = splice(_sample(learn, each), langs)
    k = len(langs)
    weights = Weights(np.zeros((FEATURE_BUCKETS, k)), 1.0, np.zeros((k, k)))
    if words:
        distinct, ids = np.unique(np.array(words, object), return_inverse=True)
        distinct = distinct.tolist()
        # a learning word's own occurrence does not vouch for it
        seen = counts[_lexicon_place(distinct, len(counts))][ids].astype(float)
        seen[np.arange(len(ids)), labels] = np.maximum(seen[np.arange(len(ids)), labels] - 1, 0)
        weights = chain_crf.fit(FEATURE_BUCKETS, features(distinct), _lexicon_values(seen, totals), ids, labels, sizes)
    return Model(langs, weights, _lexicon_values(counts.astype(float), totals).astype(np.float32))


# prediction ----------------------------------------------------------------

def _word_marginals(model: Model, spelt: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    lexicon = model.lexicon[_lexicon_place(spelt, len(model.lexicon))].astype(float)
    scores = chain_crf.word_scores(model.weights, features(spelt), lexicon)
    return chain_crf.marginals(scores[ids], sizes, model.weights.transitions)[0]


def _spans(best: np.ndarray, first: int, size: int, langs: list[str]) -> list[dict]:
    labels = best[first:first + size]
    cut = np.flatnonzero(np.diff(labels)) + 1
    edges = [0, *cut.tolist(), size]
    return [{"lang": langs[labels[a]], "from_word": a, "to_word": b} for a, b in zip(edges, edges[1:])] if size else []


def predict(docs: DataFrame, model, *, keep: list[str], text: str = "text") -> DataFrame:
    """``row`` (the columns ``keep``), ``lang_pred``, ``score`` and ``spans``:
    the stretches of words (from, up to) in one language. ``model``: a broadcast
    of ``learn_model``'s result. Only ``text`` is looked at."""
    out = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    span = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("from_word", T.LongType()),
                                     T.StructField("to_word", T.LongType())]))
    schema = T.StructType([out.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("spans", span)])
    arrow_span = pa.list_(pa.struct([("lang", pa.string()), ("from_word", pa.int64()), ("to_word", pa.int64())]))

    def run(batches):
        known = model.value
        for b in batches:
            for part in slices(b, 1):
                n = part.num_rows
                named, score, spans = [NO_LANG] * n, np.zeros(n), [[] for _ in range(n)]
                words = words_of(part.column(1), CLASSES)
                if known is not None and len(words.ids):
                    probability = _word_marginals(known, words.spellings(), words.ids, words.counts)
                    first = np.cumsum(words.counts) - words.counts
                    best = probability.argmax(axis=1)
                    lettered = pc.match_substring_regex(part.column(1), LETTER).fill_null(False).to_pylist()
                    for i in np.flatnonzero(words.counts):
                        if lettered[i]:
                            size = int(words.counts[i])
                            mean = probability[first[i]:first[i] + size].mean(axis=0)
                            named[i] = known.langs[int(mean.argmax())]
                            score[i] = min(float(mean.max()), 1.0)
                            spans[i] = _spans(best, int(first[i]), size, known.langs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(named, pa.string()), pa.array(score), pa.array(spans, arrow_span)],
                    names=schema.names)
        release_memory()

    return out.mapInArrow(run, schema)


def identify(docs: DataFrame, *, keep: list[str], doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """``predict`` for all ``docs``, learned from those not held out."""
    model = learn_model(docs.filter(~held_out(F.col(doc_id))), lang=lang, text=text)
    return predict(docs, docs.sparkSession.sparkContext.broadcast(model), keep=keep, text=text)
