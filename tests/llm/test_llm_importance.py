"""Importance resampling against brute force over the whole tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs

from tidemart.llm import importance
from tidemart.llm.crc_arrays import Pairs

SF = "/root/testdata/sf0.001"


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(x.encode()) % 10000 for x in [*words, *map(" ".join, zip(words, words[1:]))]]


def brute(docs, target):
    """docs: (id, text); gives one (id, n_features, weight, score, rank) a row, in the same order."""
    found = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (big_s + 10000) / ((s[i] + 1) * (big_t + 10000)))) for i in range(10000)]
    rows = []
    for (i, _), (n, f) in zip(docs, found):
        w = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append([i, len(f), w, w + importance.noise(i), None])
    able = [k for k, (n, _) in enumerate(found) if n >= 20]
    able.sort(key=lambda k: (-rows[k][3], rows[k][0] is not None, rows[k][0]))
    for rank, k in enumerate(able[:25 * len(able) // 100], 1):
        rows[k][4] = rank
    return [tuple(r) for r in rows]


def got(df):
    return [(r.row.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()]


def test_query_equals_brute_force(spark):
    from tidemart.llm import queries
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    df = queries.op12_resampling(spark, SF).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(brute(docs, target), key=repr)


@pytest.mark.parametrize("segments", [1, 7])
def test_awkward_rows_in_any_number_of_segments(spark, segments):
    docs = awkward_docs(spark).repartition(3)
    done = importance.importance_resample(docs, docs.limit(0), keep=["doc_id", "text", "k1", "row"],
                                          draw_percent=100, n_segments=segments)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # without a target all gains are those of the corpus; rows with one id tie in any order of their texts
    want = brute(rows, [])
    assert sorted(map(repr, (x[:4] for x in got(done)))) == sorted(map(repr, (x[:4] for x in want)))
    drawn = sorted((x for x in got(done) if x[4]), key=lambda x: x[4])
    assert [x[4] for x in drawn] == list(range(1, len(drawn) + 1))
    assert [(-x[3], x[0] is not None, x[0]) for x in drawn] == sorted((-x[3], x[0] is not None, x[0]) for x in drawn)
    assert len(drawn) == sum(features(t)[0] >= 20 for _, t in rows)


def test_empty_table(spark):
    assert got(importance.importance_resample(empty_docs(spark), empty_docs(spark), keep=["doc_id"])) == []


def test_a_row_that_fills_the_table_is_split(spark):
    """Ranks are exact and segments even where one row is all rows."""
    from pyspark.sql import functions as F
    rows = spark.range(0, 4000, 1, 8).select(F.lit(5).alias("score"), F.lit(1).alias("id"), F.lit(2).alias("tie"))
    done = importance.ranked(rows.withColumns({c: F.col(c).cast("bigint") for c in rows.columns}), n_segments=10)
    sizes = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(r["rank"] for r in done.collect()) == list(range(1, 4001))
    assert len(sizes) >= 9 and max(sizes) <= 2 * 400


def test_segments_follow_the_splitters():
    r = np.random.default_rng(0)
    keys = [r.integers(0, 3, 500) for _ in range(5)]
    splitters = [np.sort(r.integers(0, 3, 9)) if i == 0 else np.zeros(9, np.int64) for i in range(5)]
    cut = [tuple(int(s[i]) for s in splitters) for i in range(9)]
    want = [sum(c <= tuple(int(k[i]) for k in keys) for c in cut) for i in range(500)]
    assert importance.segments_of(keys, splitters).tolist() == want


def test_pair_crcs():
    r = random.Random(2)
    words = [bytes(r.randrange(256) for _ in range(n)) for n in [0, 1, 2, 3, 7, 64, 255, 256, 1000, 70000]]
    pairs = Pairs(words)
    left, right = (a.ravel() for a in np.indices((10, 10)))
    assert pairs.crc32(left, right).tolist() == [zlib.crc32(words[a] + b" " + words[b]) for a, b in zip(left, right)]
