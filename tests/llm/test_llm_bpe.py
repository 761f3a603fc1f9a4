import random
import zlib

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs
from pyspark.sql import functions as F

from tidemart.llm import bpe, bpe_words, shared_files, token_pack

PATH = bpe.default_tokenizer_path()
PIECES = [" "] * 5 + list("\n\t\r\x0b\x0c\x1c\x85\xa0") + [
    "a", "bc", "É", "'s", "'ll", "12", "_", ".", "<|endoftext|>", "中文", "😀", "́", "\x00", "²"]


def whole(text):
    return bpe.load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_words_encode_alone_as_in_the_text():
    for t in random_texts(20000):
        words = bpe.split_words(t)
        assert " ".join(words) == t
        ids = [i for k, w in enumerate(words) for i in whole(w if not k else " " + w)]
        assert ids == whole(t), t


def test_word_parts_encode_alone_as_in_the_word():
    assert bpe.cuts_at_classes(PATH)
    rng = random.Random(4)
    some = ["a", "Bc", "é", "ß", "12", "_", ".", "...", "$$", "\n", "|>", "'s", "<|endoftext|>", "\t", "×", "中"]
    cut = 0
    for _ in range(20000):
        w = rng.choice(some[:9]) + "".join(rng.choice(some) for _ in range(rng.randrange(0, 5)))
        parts = bpe.word_parts(w)
        if parts is not None:
            cut += 1
            assert "".join(parts) == w
            assert [i for k, p in enumerate(parts) for i in whole(p if k else " " + p)] == whole(" " + w), w
    assert cut > 2000


def test_words_met_before_are_not_encoded_again_with_signs_behind_them(monkeypatch):
    """Token files: a word with a stop, a line or another sign behind it needs no new encoding."""
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeorst") for _ in range(9)) for _ in range(300)]
    ends = ["", ".", ",", "!", "$$$", ".\nSo", ",\nSo", "12"]
    text = "x " + " ".join(s + e for e in ends for s in stems)
    cache, sent = token_pack.WordCache(PATH, 1 << 10 | 3), []

    class Counting:
        def encode(self, x, **k):
            sent.append(x)
            return bpe.load_tokenizer(PATH).encode(x, **k)

        def encode_batch_fast(self, xs, **k):
            sent.extend(w for x in xs for w in x.split())
            return bpe.load_tokenizer(PATH).encode_batch_fast(xs, **k)

    monkeypatch.setattr(cache.words, "tok", Counting())
    assert cache.encode(text).tolist() == whole(text)
    assert 300 <= len(sent) < 330
    for t in random_texts(3000, 6):
        assert cache.encode(t).tolist() == whole(t), t


@pytest.mark.parametrize("chunk_bytes,buckets", [(32 << 20, 1024), (200, 7)])
def test_word_table_round_trip(spark, chunk_bytes, buckets):
    rows = list(enumerate(random_texts(300))) + [(500, None), (501, ""), (501, ""), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ids = bpe_words.encode(df, PATH, keep=["doc_id", "text"], chunk_bytes=chunk_bytes, n_buckets=buckets)
    got = bpe_words.decode(ids, bpe_words.piece_table(spark, PATH)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == whole(r["text"])
        assert r["decoded"] == (r["text"] or "")
    both = bpe_words.encode(df, PATH, keep=["doc_id", "text"], chunk_bytes=chunk_bytes, n_buckets=buckets,
                            piece_rows=bpe_words.piece_table(spark, PATH))
    assert sorted(map(repr, both.collect())) == sorted(map(repr, got))


def test_word_table_awkward_and_empty(spark):
    docs = awkward_docs(spark)
    ids = bpe_words.encode(docs, PATH, keep=docs.columns)
    got = ids.collect()
    assert len(got) == docs.count() and ids.columns == [*docs.columns, "ids"]
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == whole(r["text"]) for r in got)
    assert bpe_words.encode(empty_docs(spark), PATH, keep=["doc_id"]).count() == 0


def test_decode_unknown_bytes_and_ids(spark):
    piece = spark.createDataFrame([(0, bytearray(b"a")), (1, bytearray(b"\xc3")), (2, bytearray(b"\xa9"))],
                                  "id int, piece binary")
    ids = spark.createDataFrame([(bytearray(np.array(x, "<u4").tobytes()),) for x in ([0, 1, 2], [1, 0], [])],
                                "ids binary")
    assert [r["decoded"] for r in bpe_words.decode(ids, piece).collect()] == ["aé", "�a", ""]


@pytest.mark.parametrize("width", [1, 5, 8, 11, 16, 17, 31])
def test_bits_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1000).astype(np.uint32)
    data = token_pack.pack_bits(ids, width)
    assert len(data) == -(-1000 * width // 8)
    assert (token_pack.unpack_bits(data, 1000, width) == ids).all()


def test_file_random_access(tmp_path):
    import pyarrow.fs  # noqa: F401

    rng = np.random.default_rng(0)
    docs = [(None if k == 0 else k * 3, rng.integers(0, 1 << 11, int(n)).astype(np.uint32))
            for k, n in enumerate(rng.integers(0, 400, 60))]
    path = str(tmp_path / "x.tpk")
    w = token_pack.Writer(shared_files.create(path), 11, block_ids=64)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    with shared_files.read(path) as f:
        r = token_pack.Reader(f)
        assert r.doc_ids == [d for d, _ in docs]
        for k in rng.permutation(60):
            assert (r.document(k) == docs[k][1]).all()
        flat = np.concatenate([x for _, x in docs])
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(flat) + 1, 2).tolist())
            assert (r.ids(a, b) == flat[a:b]).all()
    with pytest.raises(ValueError):
        token_pack.Writer(shared_files.create(str(tmp_path / "y")), 4).add(1, np.array([16], np.uint32))


def test_token_files_in_order(spark):
    texts = random_texts(120, 7)
    rows = [(i * 7 % 121, t) for i, t in enumerate(texts)] + [(None, "n"), (5, "tie"), (5, "tie"), (300, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    man = token_pack.write_token_files(df, PATH, shared_files.new_folder(spark, "t"), file_ids=300)
    assert man.count() > 3
    got = sorted(token_pack.read_token_files(man).withColumn("crc", F.crc32("ids")).collect(),
                 key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    by = {}
    for d, t in rows:
        by.setdefault(d, []).append(whole(t) + [0])
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == at and ids in by[r["doc_id"]]
        assert r["crc"] == zlib.crc32(r["ids"])
        by[r["doc_id"]].remove(ids)
        at += len(ids)
    man = token_pack.write_token_files(awkward_docs(spark), PATH, shared_files.new_folder(spark, "t"))
    assert token_pack.read_token_files(man).count() == awkward_docs(spark).count()
    man = token_pack.write_token_files(empty_docs(spark), PATH, shared_files.new_folder(spark, "t"))
    assert token_pack.read_token_files(man).count() == 0


def test_no_table_is_left_in_the_catalog(spark):
    from tidemart.llm import queries
    before = {t.name for t in spark.catalog.listTables()}
    got = queries.op3_bpe_words(spark, "/root/testdata/sf0.001")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert got.count() == 200


def test_registered_token_queries_equal_whole_text_encoding(spark):
    """ids, their digests, starts and checksums of the given tables."""
    import hashlib
    import zlib

    import numpy as np
    from tidemart.llm import queries
    from tidemart.llm.bpe import default_tokenizer_path, load_tokenizer
    sf, tok = "/root/testdata/sf0.001", load_tokenizer(default_tokenizer_path())
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    three, six, at = {}, {}, 0
    for i, t in docs:
        ids = tok.encode(t, add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        back = tok.decode(ids, skip_special_tokens=False)
        three[i] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        six[i] = (at, len(ids) + 1, zlib.crc32(raw + bytes(4)))
        at += len(ids) + 1
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
            for r in queries.op3_bpe_words(spark, sf).collect()} == three
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op6_token_files(spark, sf).collect()} == six


def test_new_words_are_encoded_in_runs():
    """A tokenizer call for each new word took more time than the limit allows."""
    class Counted:
        calls = 0

        def __init__(self, tok):
            self.tok = tok

        def __getattr__(self, name):
            Counted.calls += 1
            return getattr(self.tok, name)

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéñ#\n$12中") for _ in range(rng.randrange(4, 12))).strip() for _ in range(2000)]
    cache = token_pack.WordCache(PATH, 1 << 20)
    cache.tok = cache.words.tok = Counted(cache.words.tok)
    text = " ".join(words)
    assert cache.encode(text).tolist() == whole(text)
    assert Counted.calls < 100
    assert cache.encode(text).tolist() == whole(text) and Counted.calls < 101
    # runs of words that end in white space, take spaces away or hold pieces of a space
    for t in random_texts(3000, 6) + ["a <|endoftext|> b", "\na b\n", "Ġ Ġa aĠ", "a ", " a", " "]:
        fresh = token_pack.WordCache(PATH, 1 << 20)
        fresh.words.clear()
        assert fresh.encode(t).tolist() == whole(t), t
