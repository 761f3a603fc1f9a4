"""Collocations against brute force over all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs

from tidemart.llm import bit_filter, collocations, phrase_trie
from tidemart.llm.word_arrays import byte_classes, slices, words_of


def brute(rows, min_count, top, inside=50):
    """rows: (lang, text)."""
    words, grams = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            words.update((lang, x) for x in w)
            grams.update((lang, tuple(w[i:i + k])) for k in (2, 3) for i in range(len(w) - k + 1))
    f = Counter({(lang, (x,)): n for (lang, x), n in words.items()}) + grams
    out = {}
    good = {g: n for g, n in grams.items() if n >= min_count}
    for (lang, p), a in good.items():
        if len(p) == 2 and any(100 * n >= inside * a for (other, q), n in good.items()
                               if other == lang and len(q) == 3 and p in (q[:2], q[1:])):
            continue
        score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    n = Counter()
    for (lang, _), c in words.items():
        n[lang] += c
    return sorted((lang, i, p.decode(), -a, left, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, r) in enumerate(sorted(found)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("block", [7, 1000])
def test_equals_brute_force_in_any_blocks(spark, block):
    r = random.Random(3)
    vocab = ["the", "The", "of", "é", "new", "york", "a", "state", "x" * 40, "日本", "-", "'s"]
    rows = [(r.choice(["en", "de", None, "und", ""]), " ".join(
        r.choice(vocab) + r.choice(["", "", "", ",", ".\n", " \t"]) for _ in range(60))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = brute(rows, 10, 25)
    assert want and got(collocations.collocations(docs, top=25, block_phrases=block)) == want


def test_passes_do_not_grow_with_the_blocks(spark):
    """Every block read all texts again, so time grew with the square of the input."""
    r = random.Random(4)
    rows = [("en", " ".join(f"w{r.randrange(12)}" for _ in range(200))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    sc, jobs, found = spark.sparkContext, [], []
    for block in (10_000, 10):
        sc.setJobGroup(f"block {block}", "collocations")
        try:
            found.append(got(collocations.collocations(docs, block_phrases=block)))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"block {block}")))
    assert found[0] == found[1] == brute(rows, 10, 2000) and len(found[0]) > 100
    assert jobs[1] <= jobs[0] + 5


def test_awkward_rows_and_hot_row(spark):
    docs = awkward_docs(spark)
    assert got(collocations.collocations(docs, min_count=2, top=50)) == brute(
        [(r.lang, r.text) for r in docs.collect()], 2, 50)
    many = docs.limit(0).unionByName(docs)
    for _ in range(3):
        many = many.unionByName(many)
    assert got(collocations.collocations(many, top=50)) == brute([(r.lang, r.text) for r in many.collect()], 10, 50)


def test_empty_table_and_texts_without_phrases(spark):
    assert got(collocations.collocations(empty_docs(spark))) == []
    few = spark.createDataFrame([(None, None), ("en", "one two"), ("en", "")], "lang string, text string")
    assert got(collocations.collocations(few)) == []


def test_scores_stay_exact_beyond_64_bits(spark):
    big = 9_007_199_254_740_993
    counted = spark.createDataFrame([("en", "p", "q", None, big)], "lang string, w1 string, w2 string, w3 string, f long")
    words = spark.createDataFrame([("en", "p", big + 10), ("en", "q", 4 * big)], "lang string, word string, n long")
    (row,) = collocations.scored_phrases(counted, words).collect()
    assert row.score == 10**6 * big * big // ((big + 10) * 4 * big)


def test_trie_counts_random_phrases():
    rng = np.random.default_rng(5)
    keys = np.array([rng.bytes(16) for _ in range(300)], "S16")
    shapes = list({tuple(map(int, rng.integers(0, 300, rng.integers(2, 4)) // rng.integers(1, 40))) for _ in range(4000)})
    phrases = np.array([[keys[x] for x in s] + [b""] * (3 - len(s)) for s in shapes], "S16")
    trie = phrase_trie.build(phrases, np.array([len(s) for s in shapes]))
    text, joined = rng.integers(0, 300, 50000) // rng.integers(1, 40, 50000), rng.random(50000) < 0.9
    joined[-1] = False
    counts = trie.count(trie.symbols_of(keys)[text], joined, 3)
    want = Counter()
    for i in np.flatnonzero(joined):
        want[tuple(map(int, text[i:i + 2]))] += 1
        if joined[i + 1]:
            want[tuple(map(int, text[i:i + 3]))] += 1
    assert {shapes[e]: int(counts[s]) for s, e in enumerate(trie.entry) if e >= 0} == {s: want[s] for s in shapes}


def test_trie_counts_only_phrases_that_begin_at_given_places():
    keys = np.array([bytes([65 + i]) * 16 for i in range(4)], "S16")
    phrases = np.array([[keys[0], keys[1], b""], [keys[0], keys[1], keys[2]], [keys[1], keys[2], b""]], "S16")
    trie = phrase_trie.build(phrases, np.array([2, 3, 2]))
    paths = np.array([[0, 1, 2], [0, 1, -1], [1, 2, 0], [3, 1, 2]])  # places among the keys
    symbols = np.append(trie.symbols_of(keys), -1)[paths]
    joined = np.tile([True, True, False], len(paths))
    total = np.zeros(3, np.int64)
    trie.add_phrases(total, symbols.ravel(), joined, 3, np.arange(0, 12, 3), np.array([5, 7, 11, 13], np.uint32))
    assert total.tolist() == [12, 5, 11]


def test_counting_phrases_takes_no_memory_per_slot():
    """A task held several counters per slot, of which there are many times more than phrases."""
    import tracemalloc

    rng = np.random.default_rng(6)
    keys = np.array([rng.bytes(16) for _ in range(20000)], "S16")
    shapes = np.unique(rng.integers(0, 20000, (30000, 3)), axis=0)
    phrases, words = keys[shapes], rng.integers(2, 4, len(shapes))
    phrases[words == 2, 2] = b""
    _, once = np.unique(np.where(words == 2, 0, shapes[:, 2]) + 20000 * (shapes[:, 1] + 20000 * shapes[:, 0]),
                        return_index=True)
    trie = phrase_trie.build(phrases[once], words[once])
    text, joined = shapes[rng.integers(0, len(shapes), 5000)].ravel(), np.ones(15000, bool)
    joined[-1] = False
    symbols = trie.symbols_of(keys)[text]
    total = np.zeros(len(once), np.int64)
    tracemalloc.start()
    for _ in range(3):
        trie.add_phrases(total, symbols, joined, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    slots = trie.count(symbols, joined, 3)
    assert total.sum() > 0 and (total[trie.entry[trie.entry >= 0]] == 3 * slots[trie.entry >= 0]).all()
    assert peak < 8 * len(trie.base)


def test_bit_filter_misses_nothing(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**63, 2**63 - 1, 5000)
    bits = bit_filter.build(spark.createDataFrame([(int(k),) for k in keys], "h long"), "h")
    assert bit_filter.contains(bits, keys).all()
    assert bit_filter.contains(bits, rng.integers(-2**63, 2**63 - 1, 5000)).mean() < 0.1


def test_words_of_slices():
    import pyarrow as pa

    texts = ["Ab c", None, "", "c.d e", " é\tab ", "x" * 100]
    b = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(0)
    classes = byte_classes(gaps=b" \t", breaks=b".")
    seen = []
    for part in slices(b, 0, size=8):
        w = words_of(part.column(0), classes)
        spelt = w.spellings()
        seen += [(int(t), spelt[i].decode(), bool(j)) for t, i, j in zip(w.texts, w.ids, w.joined)]
    assert [(s, j) for _, s, j in seen] == [("ab", True), ("c", False), ("c", False), ("d", True), ("e", False),
                                            ("é", True), ("ab", False), ("x" * 100, False)]


def test_word_keys_tell_words_and_languages_apart():
    import pyarrow as pa
    from tidemart.llm.word_arrays import keys_in_groups, word_keys

    r = random.Random(7)
    words = list({bytes(r.randrange(256) for _ in range(r.choice([1, 2, 3, 8, 63, 64, 65, 300]))) for _ in range(5000)})
    words += [b"\0" * n for n in (5, 6, 64, 65, 66)]
    keys = word_keys(pa.array(words, pa.binary()))
    assert len(set(map(tuple, keys.tolist()))) == len(set(words))
    assert (word_keys(pa.array(words, pa.binary()).slice(7, 50)) == keys[7:57]).all()
    group = np.repeat([0, 1], len(words))
    both = keys_in_groups(keys, ["en", ""], group, np.tile(np.arange(len(words)), 2))
    assert len(set(map(tuple, both.tolist()))) == 2 * len(set(words))
    flipped = keys_in_groups(keys, ["", "en"], 1 - group, np.tile(np.arange(len(words)), 2))
    assert (both == flipped).all()
    assert len({k for pair in both.tolist() for k in pair}) == 4 * len(set(words))
