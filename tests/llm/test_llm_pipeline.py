import hashlib
import random

import corpus_pipeline as cp
import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs
from test_llm_bpe import whole
from test_llm_line_dedup import brute as brute_lines
from test_llm_simhash import classes, slow_fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k", range(5))
def test_stage_takes_awkward_and_empty_tables(spark, k):
    stage = cp.STAGES[k][1]
    docs = awkward_docs(spark)
    out = stage(spark, docs, SF)
    if k < 4:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        empty = stage(spark, empty_docs(spark), SF)
        assert empty.columns == docs.columns
    else:
        empty = stage(spark, empty_docs(spark), SF)
    assert empty.count() == 0
    ids = {r["doc_id"] for r in out.collect()}
    assert ids <= {r["doc_id"] for r in docs.collect()}


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = cp.quality_stage(spark, docs, SF).cache()
    before = {r["doc_id"]: r["text"] for r in kept.collect()}
    lined = cp.line_stage(spark, kept, SF).cache()
    want = {d: t for (d, _), t in brute_lines(list(before.items()), 10, 1, "all").items()}
    got = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())
    single = cp.near_duplicate_stage(spark, lined, SF).cache()
    fps = {d: slow_fingerprint(t) for d, t in got.items()}
    of = classes(sorted(set(fps.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    heads = {}
    for d in sorted(got):
        heads.setdefault(of[fps[d]], d)
    assert {r["doc_id"] for r in single.collect()} == set(heads.values())
    clean = cp.decontamination_stage(spark, single, SF).cache()
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    for r in single.collect():
        if any(t in r["text"] for t in items):
            assert r["doc_id"] not in left
    tokens = cp.token_stage(spark, clean, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert {r["doc_id"] for r in tokens} == left
    for r in tokens:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == whole(texts[r["doc_id"]]) and len(ids) == r["n_tokens"]
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert rows_of(cp.run(spark, SF)) == rows_of(cp.token_stage(spark, clean, SF))


def test_repeated_rows_leave_one_of_a_group(spark):
    rng = random.Random(0)
    text = " ".join(f"w{rng.randrange(99)}" for _ in range(200))
    docs = spark.createDataFrame([(3, text)] * 4 + [(2, text), (None, text), (9, "other words here")],
                                 "doc_id long, text string")
    assert sorted(r["doc_id"] for r in cp.near_duplicate_stage(spark, docs, SF).collect()) == [2, 9]


def test_columns_named_like_internal_ones_pass_through(spark):
    """Every name that a stage uses inside, as a further column of documents."""
    from pyspark.sql import functions as F
    names = ["_kept_text", "kept_text", "row", "k1", "k2", "profile", "kept", "fp", "u", "v", "component_id", "n_lines",
             "n_dropped", "_lang", "_body", "_w", "_t", "_rest", "_ref_lang", "item_id", "edits", "decoded", "ids", "position"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = docs.withColumns({n: F.lit(i) for i, n in enumerate(names)})
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select(*names).distinct().collect()} <= {tuple(range(len(names)))}
    assert cp.token_stage(spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_only_the_result_stays_in_the_work_folder(spark):
    import re
    from pathlib import Path

    from tidemart.session import work_path
    root = Path(re.sub("^file:", "", work_path(spark)))

    def tables():
        return {p for d in ("tables", "pipeline") if (root / d).exists() for p in (root / d).iterdir()}
    before = tables()
    got = cp.run(spark, "/root/testdata/sf0.001")
    new = tables() - before
    assert {p.parent.name for p in new} == {"pipeline"} and len(new) == 1
    assert got.count() > 0
