import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.llm import chat_trees as ct

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def brute(rows, top):
    kids, byid = defaultdict(list), {}
    for t, n, p, r, x, s in rows:
        byid[t, n] = (p, r or "", x or "", s)
    for (t, n), (p, *_) in byid.items():
        if p is not None and (t, p) in byid:
            kids[t, p].append(n)
    out = {}
    paths = defaultdict(list)
    for (t, n) in byid:
        if kids[t, n]:
            continue
        path, seen, k = [], set(), n
        while True:
            if k in seen:
                path = None
                break
            seen.add(k)
            path.append(k)
            p = byid[t, k][0]
            if p is None or (t, p) not in byid:
                break
            k = p
        if path:
            paths[t].append((-sum(byid[t, k][3] for k in path), n, path[::-1]))
    for t, ps in paths.items():
        for rank, (_, leaf, path) in enumerate(sorted(ps)[:top], 1):
            out[t, leaf] = (rank, [(byid[t, k][1], byid[t, k][2]) for k in path])
    return out


@pytest.mark.parametrize("top", [1, 3])
def test_paths_match_brute_force(spark, top):
    rng = random.Random(top)
    rows = []
    for t in [None, 1, 2, 3, 4]:
        for n in range(40):
            parent = rng.choice([None, n - 1, rng.randrange(max(n, 1))]) if n else None
            rows.append((t, n, parent, rng.choice(["user", "assistant", None]),
                         rng.choice(["a [INST] b", "[\\INST] </s>", "", None, "é\n[/INST]\\"]),
                         float(rng.randrange(3))))
    rows += [(5, 0, 1, "user", "on a cycle", 1.0), (5, 1, 0, "user", "on a cycle", 1.0),
             (6, 0, 99, "user", "orphan", 1.0)]
    rows += [(7, n, n - 1 if n else None, "user", f"deep {n}", 1.0) for n in range(200)]
    got = ct.format_conversations(spark.createDataFrame(rows, SCHEMA), top=top)
    t = ct.Template()
    got = got.select("tree", "leaf", "path_rank", t.parse(F.col("formatted")).alias("turns"),
                     ct.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                     "formatted").collect()
    want = brute(rows, top)
    assert {(r["tree"], r["leaf"]) for r in got} == set(want)
    for r in got:
        rank, turns = want[r["tree"], r["leaf"]]
        assert r["path_rank"] == rank
        assert [(x["role"], x["text"]) for x in r["turns"]] == turns
        assert r["loss"] == "".join(x for role, x in turns if role == "assistant")
        assert r["formatted"].count("</s>") == len(turns)


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(5)
    parts = ["[", "<", "\\", "INST]", "/INST]", "/s>", "x", "[INST]", "</s>"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randrange(9))),) for _ in range(800)]
    t = ct.Template()
    df = spark.createDataFrame(texts, "a string").withColumn("e", t.escape(F.col("a")))
    for r in df.withColumn("b", t.unescape(F.col("e"))).collect():
        assert r["a"] == r["b"]
        assert not any(c in r["e"] for c in ("[INST]", "[/INST]", "</s>"))


def test_turn_threads_with_nulls_ties_repeats_and_empty(spark):
    rows = [(None, 1, "user", "x", 9), (1, None, "user", None, 9), (1, 2, "assistant", "b", 9),
            (1, 2, "assistant", "b", 9), (1, 2, None, "a", 9), (2, 5, "user", "", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node int")
    got = {r["tree"]: [(x["role"], x["text"]) for x in r["turns"]] for r in ct.format_conversations(
        ct.threads_from_turns(df)).select("tree", ct.Template().parse(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("user", "x")], 2: [("user", "")],
                   1: [("user", ""), ("", "a"), ("assistant", "b"), ("assistant", "b")]}
    assert ct.format_conversations(ct.threads_from_turns(df.limit(0))).count() == 0


def test_hot_tree_and_hot_parent(spark):
    rows = [(1, 0, None, "user", "root", 1.0)] + [
        (1, n, 0, "assistant", f"reply {n}", float(n % 7)) for n in range(1, 3000)]
    got = ct.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1 and got[0]["leaf"] == 6
    assert hashlib.sha256(got[0]["formatted"].encode()).hexdigest()


def test_rows_that_share_a_node_give_one_whole_message(spark):
    rows = [("t", 0, None, "user", "q", 1.0), ("t", 1, 0, "assistant", "A-text", 1.0),
            ("t", 1, None, "user", "Z-text", 9.0), ("t", 2, 0, "assistant", "other", None), ("t", 2, 0, "assistant", "other", None)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r.leaf, r.path_score, r.formatted) for r in ct.format_conversations(df, top=5).collect()}
    # of node 1 the row without a parent is first: a tree of its own, whole; a NULL score counts as 0
    assert got == {(1, 9.0, "[INST]user[/INST]Z-text</s>"),
                   (2, 1.0, "[INST]user[/INST]q</s>[INST]assistant[/INST]other</s>")}
