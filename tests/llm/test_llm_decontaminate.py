import random

import numpy as np
from llm_cases import awkward_docs, empty_docs

from tidemart.llm import decontaminate as dc


def edit_distance_in(pattern, text):
    """Least edits of the pattern to any passage (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def edited(rng, words, k, vocab):
    w = list(words)
    for _ in range(k):
        p = rng.randrange(len(w))
        op = rng.choice("sid")
        if op == "s":
            w[p] = rng.choice(vocab)
        elif op == "i":
            w.insert(p, rng.choice(vocab))
        else:
            del w[p]
    return w


def test_best_passage_is_the_edit_distance():
    rng = random.Random(0)
    for _ in range(200):
        pattern = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 12))], np.int32)
        text = np.array([[rng.randrange(5) for _ in range(15)]], np.int32)
        (e,), (b,), (t,) = dc.best_passages(pattern, text)
        assert e == edit_distance_in(pattern.tolist(), text[0].tolist())
        part = text[0][b:t].tolist()
        assert e == min(len(pattern), edit_distance_in(pattern.tolist(), part)) or len(part) == 0


def test_recall_and_no_false_hits(spark):
    rng = random.Random(2)
    vocab = ["the", "of", "and"] * 30 + [f"w{i}" for i in range(400)]
    items = [(i, [rng.choice(vocab) for _ in range(rng.randrange(8, 70))]) for i in range(80)]
    docs, want = [], set()
    for d in range(600):
        pre = [rng.choice(vocab) for _ in range(rng.randrange(60))]
        post = [rng.choice(vocab) for _ in range(rng.randrange(60))]
        i, w = rng.choice(items)
        if d % 3 == 0:
            mid = w if d % 2 else edited(rng, w, int(dc.MAX_EDIT_SHARE * len(w)), vocab)
        elif d % 3 == 1:
            mid = w[:len(w) // 2]   # half an item is no passage
        else:
            mid = []
        text = pre + mid + post
        docs.append((d, ", ".join(x.upper() if rng.random() < .2 else x for x in text)))
        for j, u in items:
            if edit_distance_in(u, text) <= int(dc.MAX_EDIT_SHARE * len(u)):
                want.add((d, j))
    got = dc.contaminated_passages(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"),
        block_items=30).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found) == len(got) and found <= want
    exact = {(d, j) for d, j in want if d % 6 == 3}
    assert exact <= found
    assert len(found) >= dc.TARGET_RECALL * len(want)
    words, text = dict(items), dict(docs)
    for r in got:
        part = dc.words_of(text[r["doc_id"]])[r["from_word"]:r["to_word"]]
        assert r["edits"] <= int(dc.MAX_EDIT_SHARE * len(words[r["item_id"]]))
        assert edit_distance_in([x.encode() for x in words[r["item_id"]]], part) <= r["edits"]


def test_awkward_and_empty(spark):
    items = spark.createDataFrame([(None, None), (1, ""), (2, "too short"), (3, "a b c a b c a b c a b c"),
                                   (3, "a b c a b c a b c a b c")], "item_id long, text string")
    docs = awkward_docs(spark)
    got = dc.contaminated_passages(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set()
    hit = spark.createDataFrame([(None, "x A b C a b c a, b c a b c y", 1), (9, None, 1)],
                                "doc_id long, text string, edits int")
    got = dc.contaminated_passages(hit, items).collect()
    assert [(r["doc_id"], r["item_id"], r["edits"]) for r in got] == [(None, 3, 0)]
    assert dc.contaminated_passages(empty_docs(spark), items).count() == 0
    assert dc.contaminated_passages(docs, items.limit(0)).count() == 0


def test_copies_after_a_run_of_one_word():
    rng = random.Random(5)
    missed = 0
    for seed in range(40):
        run = (16, 20, 24, 30)[seed % 4]
        words = ["0"] * run + [f"w{rng.randrange(400)}" for _ in range(40 - run)]
        index = dc.ItemIndex([(1, " ".join(words))], max_edit_share=dc.MAX_EDIT_SHARE, min_item_words=8,
                             target_recall=dc.TARGET_RECALL, samples=dc.SAMPLES, seed=seed)
        text = ["x"] * 7 + ["0"] * 80 + words + ["y"] * 30
        codes = np.array([index.vocab.get(w.encode(), 0) for w in text], np.int32)
        at, size = np.array([0]), np.array([len(codes)])
        found = index.verify(codes, at, size, index.candidates(codes, at, size))
        missed += found != [(0, 0, 0, 87, 127)]
    assert missed == 0


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "seven words of an item stand here"), (2, "今日は良い天気ですね、散歩に行きましょう。本当に気持ちがいい"),
             (3, "four words are enough"), (4, "three are not"), (5, "ภาษาไทยเขียนไม่มีช่องว่างระหว่างคำเลย")]
    docs = [(1, "before SEVEN words, of an item stand here; after"), (2, "seven words of an item stand there"),
            (3, f"x {items[1][1]} y"), (4, items[1][1].replace("良", "悪")), (5, "so four words are\nenough. four words are enough"),
            (6, "three are not"), (7, "four words are"), (8, "enough"), (9, "ก" + items[4][1] + "ข"), (10, "今日は")]
    got = dc.contaminated_passages(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == {
        (1, 1, 0), (3, 2, 0), (4, 2, 1), (5, 3, 0), (9, 5, 0)}
    (r,) = [r for r in got if r["doc_id"] == 5]
    assert (r["from_word"], r["to_word"]) == (1, 5)


def test_a_very_long_item_beside_many_short_ones_stays_small():
    """The index keeps no table of steps times words."""
    import pickle
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(20_000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(40))) for i in range(2000)]
    items.append((-1, " ".join(rng.choice(vocab) for _ in range(50_000))))
    index = dc.ItemIndex(items, max_edit_share=dc.MAX_EDIT_SHARE, min_item_words=8,
                         target_recall=dc.TARGET_RECALL, samples=dc.SAMPLES)
    assert len(pickle.dumps(index)) < 30 << 20
    codes = np.concatenate([np.zeros(11, np.int32), index.items[-1], np.zeros(5, np.int32)])
    at, size = np.array([0]), np.array([len(codes)])
    cand = index.candidates(codes, at, size)
    assert ((cand[:, 1] == len(items) - 1) & (cand[:, 2] == 11)).any()


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 12, 30])))) for i in range(40)]
    docs = spark.createDataFrame([(i, f"a {t} b") for i, t in items], "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, dc.contaminated_passages(docs, frame).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 1000)
    assert sorted(map(tuple, dc.contaminated_passages(docs, frame).collect())) == one
    assert {(d, i) for d, i, *_ in one} >= {(i, i) for i, _ in items}
