import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs

from tidemart.llm import line_dedup as ld


def brute(rows, min_docs, min_key, mode):
    """rows: (doc_id, text), distinct; {row: kept text}."""
    key = lambda x: x.encode().strip(ld.WHITE).lower().decode()
    docs = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            docs[key(x)].add((d, t or ""))
    out, seen = {}, set()
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        keep = []
        for x in (t or "").split("\n"):
            k = key(x)
            drop = len(k) >= min_key and len(docs[k]) >= min_docs
            if drop and mode == "first" and k not in seen:
                drop = False
            seen.add(k)
            if not drop:
                keep.append(x)
        out[d, t] = "\n".join(keep)
    return out


@pytest.mark.parametrize("mode,min_docs,min_key", [("all", 3, 1), ("all", 10, 1), ("first", 2, 1),
                                                   ("first", 4, 3), ("all", 2, 0)])
def test_matches_brute_force(spark, mode, min_docs, min_key):
    rng = random.Random(min_docs)
    pool = [" Same line", "same LINE\t", "b", "éÉ", "", "  ", "c d", "É"] + [f"u{i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(150)]
    rows += [(1000 + i, "hot\n" * 3 + f"own {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ld.line_dedup(df, min_docs=min_docs, min_key_chars=min_key, mode=mode).collect()
    want = brute(rows, min_docs, min_key, mode)
    assert len(got) == len(rows)
    for r in got:
        t = r["row"]["text"]
        assert r["kept_text"] == want[r["row"]["doc_id"], t]
        assert r["n_lines"] == t.count("\n") + 1
    assert sum(r["n_dropped"] for r in got) > 0


@pytest.mark.parametrize("first", [False, True])
def test_stream_is_independent_of_batches_and_partitions(first, monkeypatch):
    import pyarrow as pa
    import pyspark

    rng = random.Random(3)
    rows = sorted((h, 0, d, 0, p) for h in range(20) for d in range(rng.randrange(1, 12))
                  for p in range(rng.randrange(1, 3)))

    class Here:
        pid = 0

        def partitionId(self):
            return self.pid

    here = Here()
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: here))
    n = len({(h, d) for h, _, d, _, _ in rows})
    assert n
    docs = defaultdict(set)
    for h, _, d, _, _ in rows:
        docs[h].add(d)
    want = set()
    for i, r in enumerate(rows):
        if len(docs[r[0]]) >= 5 and not (first and (i == 0 or rows[i - 1][0] != r[0])):
            want.add((r[0], r[2], r[4]))
    for trial in range(60):
        cuts = sorted(rng.sample(range(1, len(rows)), rng.randrange(0, 6)))
        cuts = [c for c in cuts if rows[c][:3] != rows[c - 1][:3]]  # a document's lines stay together
        events = []
        for pid, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            here.pid = pid
            part, batches = rows[a:b], []
            while part:
                k = rng.randrange(1, 9)
                cols = list(zip(*part[:k]))
                batches.append(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                          names=["h1", "h2", "k1", "k2", "pos"]))
                part = part[k:]
            for out in ld._stream(5, first)(iter(batches)):
                events += out.to_pylist()
        drop = {(e["h1"], e["k1"], e["pos"]) for e in events if e["kind"] == ld.DROP}
        total, head = defaultdict(int), {}
        for e in events:
            if e["kind"] == ld.EDGE:
                total[e["h1"]] += e["n_docs"]
                if e["h1"] not in head or e["pid"] < head[e["h1"]][0]:
                    head[e["h1"]] = (e["pid"], (e["h1"], e["k1"], e["pos"]))
        for e in events:
            at = (e["h1"], e["k1"], e["pos"])
            if e["kind"] == ld.OPEN and total[e["h1"]] >= 5 and not (first and head[e["h1"]][1] == at):
                drop.add(at)
        assert drop == want, (trial, cuts)


def test_bitmaps_are_compressed_and_awkward_rows(spark):
    got = ld.line_dedup(awkward_docs(spark), min_docs=2).collect()
    rows = [(r["row"]["doc_id"], r["row"]["text"]) for r in got]
    want = brute(rows, 2, 1, "all")
    assert len(got) == awkward_docs(spark).count()
    assert all(r["kept_text"] == want[x] for r, x in zip(got, rows))
    assert got[0]["row"].asDict().keys() >= {"fp", "k1", "row", "_t"}
    assert ld.line_dedup(empty_docs(spark)).count() == 0
    maps = ld.keep_bitmaps(spark.createDataFrame(
        [(i, i, 0, "x\ny\nz %d" % i) for i in range(12)], "doc long, k1 long, k2 long, text string")).collect()
    assert len(maps) == 12
    for m in maps:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(m["dropped"]), np.uint8), bitorder="little")
        assert list(bits[:3]) == [1, 1, 0]
