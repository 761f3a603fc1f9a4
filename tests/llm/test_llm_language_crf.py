"""The chain against enumeration of all label paths, and held-out accuracy."""

import itertools

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tidemart.llm import chain_crf, language_crf

SF = "/root/testdata/sf0.01"


def enumerate_marginals(scores, transitions):
    n, k = scores.shape
    out, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        p = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        total += p
        for i, y in enumerate(path):
            out[i, y] += p
        for a, b in zip(path, path[1:]):
            pairs[a, b] += p
    return out / total, pairs / total, np.log(total)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_marginals_equal_enumeration(monkeypatch, block):
    monkeypatch.setattr(chain_crf, "BLOCK", block)
    r = np.random.default_rng(block)
    sizes = np.array([3, 0, 1, 7, 5])
    scores, transitions = r.normal(size=(16, 3)) * 2, r.normal(size=(3, 3)) * 2
    got, pairs = chain_crf.marginals(scores, sizes, transitions, pairs=True)
    want, both, at = [], np.zeros((3, 3)), 0
    for n in sizes[sizes > 0]:
        m, p, _ = enumerate_marginals(scores[at:at + n], transitions)
        want.append(m)
        both += p
        at += n
    assert np.allclose(got, np.concatenate(want)) and np.allclose(pairs, both)


def test_long_chain_stays_finite():
    r = np.random.default_rng(0)
    got, _ = chain_crf.marginals(r.normal(size=(20000, 4)) * 30, np.array([20000]), r.normal(size=(4, 4)) * 10)
    assert np.isfinite(got).all() and np.allclose(got.sum(axis=1), 1)


def test_gradient_equals_differences():
    r = np.random.default_rng(4)
    sparse = language_crf.features([b"ab", b"the", b"\xc3\xa9"])._replace(
        bucket=r.integers(0, 5, len(language_crf.features([b"ab", b"the", b"\xc3\xa9"]).word)))
    ids, labels, sizes = r.integers(0, 3, 6), r.integers(0, 2, 6), np.array([4, 2])
    lexicon = r.normal(size=(6, 2))
    w = chain_crf.Weights(r.normal(size=(5, 2)), 0.7, r.normal(size=(2, 2)))

    def likelihood(w):
        scores = chain_crf.word_scores(w._replace(lexicon=0.0), sparse, np.zeros((3, 2)))[ids] + w.lexicon * lexicon
        out, at = -6 * 0.01 * np.square(w.features).sum(), 0
        for n in sizes:
            s, y = scores[at:at + n], labels[at:at + n]
            out += s[np.arange(n), y].sum() + w.transitions[y[:-1], y[1:]].sum() - enumerate_marginals(s, w.transitions)[2]
            at += n
        return out / 6

    g, d = chain_crf.gradient(w, sparse, lexicon, ids, labels, sizes, 0.01), 1e-5
    for name in ("features", "transitions"):
        for cell in np.ndindex(getattr(w, name).shape):
            up, down = (getattr(w, name).copy() for _ in range(2))
            up[cell] += d
            down[cell] -= d
            assert np.isclose((likelihood(w._replace(**{name: up})) - likelihood(w._replace(**{name: down}))) / (2 * d),
                              getattr(g, name)[cell], atol=1e-6)
    assert np.isclose((likelihood(w._replace(lexicon=0.7 + d)) - likelihood(w._replace(lexicon=0.7 - d))) / (2 * d),
                      g.lexicon, atol=1e-6)


def test_held_out_accuracy_of_the_query(spark):
    from tidemart.llm import queries
    got = queries.op13_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert len(got) == 1000
    out = [r for r in got if r.held_out]
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_switches_inside_a_text_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = docs.filter(~language_crf.held_out(F.col("doc_id")))
    model = language_crf.learn_model(known)
    rows = [r for r in docs.filter(language_crf.held_out(F.col("doc_id"))).orderBy("doc_id").collect()]
    by = {x: [r.text for r in rows if r.lang == x] for x in model.langs}
    mixed, truth = [], []
    for i in range(12):
        a, b, c = (model.langs[(i + j) % 4] for j in (0, 1, 3))
        cut = [(x, " ".join(by[x][i % len(by[x])].split(" ")[:n])) for x, n in ((a, 40), (b, 25), (c, 60))]
        mixed.append((i, "\n".join(t for _, t in cut)))
        import re
        truth.append([x for x, t in cut for _ in re.findall(r"[A-Za-z\x80-\U0010ffff]+", t)])
    got = language_crf.predict(spark.createDataFrame(mixed, "doc_id long, text string"),
                               spark.sparkContext.broadcast(model), keep=["doc_id"]).collect()
    right = total = 0
    for r in got:
        want = truth[r.row.doc_id]
        labels = [s.lang for s in r.spans for _ in range(s.to_word - s.from_word)]
        assert len(labels) == len(want)
        right += sum(x == y for x, y in zip(labels, want))
        total += len(want)
    assert right / total > 0.93


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("lang", F.when(F.col("text").like("%the%"), "en").when(F.col("text").like("%é%"), "fr"))
    got = language_crf.identify(docs, keep=docs.columns).collect()
    assert len(got) == docs.count()
    for r in got:
        lettered = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred in ("en", "fr")) == lettered and (lettered or (r.lang_pred, r.score) == ("und", 0.0))


def test_nothing_to_learn_from_and_one_language(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.row.doc_id, r.lang_pred, r.score) for r in language_crf.identify(docs, keep=["doc_id"]).collect()} == {
        (1, "und", 0.0), (2, "und", 0.0)}
    assert language_crf.identify(empty_docs(spark), keep=["doc_id"]).collect() == []
    one = spark.createDataFrame([(i, "words of one language", "xx") for i in range(8)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_crf.identify(one, keep=["doc_id"]).collect()} == {("xx", 1.0)}
