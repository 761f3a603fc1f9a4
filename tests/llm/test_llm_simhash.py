import random

import pytest
import xxhash
from llm_cases import awkward_docs, empty_docs

from tidemart.llm import components, simhash


def slow_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, linked):
    of = {n: n for n in nodes}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                of[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for t in ["", " \n", "one", "one TWO", "a b c", "a b c d a b c É", "x y " * 500]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("max_bits,blocks,bucket", [(2, 4, 64), (2, 4, 2), (2, 3, 3), (3, 5, 2), (1, 3, 2), (1, 2, 64)])
def test_links_match_all_pairs(spark, max_bits, blocks, bucket):
    rng = random.Random(bucket + max_bits)
    fps = [0, -1]
    for _ in range(12):
        x = rng.getrandbits(64) - (1 << 63)
        for _ in range(25):  # drifting copies: chains
            fps.append(x)
            for _ in range(rng.randrange(1, 4)):
                x ^= -(1 << 63) if (b := rng.randrange(64)) == 63 else 1 << b
    fps = sorted(set(fps))
    want = classes(fps, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = simhash.near_links(df, max_bits=max_bits, blocks=blocks, pair_bucket=bucket)
    for r in links.collect():
        assert want[r["u"]] == want[r["v"]]
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert {x: got.get(x, x) for x in fps} == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v").union(
        spark.range(1000, 3000).selectExpr("id AS u", "999L AS v")).union(
        spark.createDataFrame([(7, 7), (5000, 5001), (5001, 5000)], "u long, v long"))
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(400)}, **{i: 999 for i in range(999, 3000)}, 5000: 5000, 5001: 5000}
    assert components.connected_components(links.limit(0)).count() == 0


def test_groups_match_brute_force_on_awkward_rows(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    docs = awkward_docs(spark).select("doc_id", "text", "fp").union(spark.createDataFrame(
        [(100 + i, " ".join(base[:400 - i] + ["z"] * i), "k") for i in range(30)]
        + [(90, " ".join(base).upper(), "k"), (None, " ".join(base), "k")], "doc_id long, text string, fp string"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = sorted({slow_fingerprint(t) for _, t in rows})
    of = classes(fps, lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for d, t in rows:
        c = of[slow_fingerprint(t)]
        if d is not None:
            least[c] = min(least.get(c, d), d)
    want = sorted(((d, "%016x" % slow_fingerprint(t), least.get(of[slow_fingerprint(t)])) for d, t in rows), key=repr)
    got = simhash.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want
    assert simhash.simhash_groups(empty_docs(spark)).count() == 0
