import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemart.llm import shared_files, warc


def rec(i, payload=None, gz=True):
    payload = f"page {i} ".encode() * (20 + i) if payload is None else payload
    data = warc.record_bytes(i, f"http://a/{i}", payload, hashlib.sha1(payload).hexdigest(), None, False)
    return warc.member(data) if gz else data


def read(data):
    got = list(warc.salvage(io.BytesIO(data), len(data)))
    return ([x[2]["warc-record-id"] for x in got if x[0] == "record"], [x[1:] for x in got if x[0] == "gap"])


def ids(*pages):
    return [f"<urn:x-page:{p}>" for p in pages]


@pytest.mark.parametrize("gz", [True, False])
def test_sound_archive_has_no_gap(gz):
    assert read(b"".join(rec(i, gz=gz) for i in range(6))) == (ids(*range(6)), [])
    assert read(b"") == ([], [])


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "length"])
def test_salvage_goes_on_after_damage(gz, damage):
    parts = [rec(i, gz=gz) for i in range(6)]
    at = len(parts[0]) + len(parts[1])
    if damage == "flip":
        p = bytearray(parts[2])
        p[len(p) // 2 if gz else -20] ^= 0x55  # no check covers a plain header
        parts[2] = bytes(p)
    elif damage == "cut":
        parts[2] = parts[2][:-len(parts[2]) // 3]
    elif damage == "junk":
        parts[2] = b"\x1f\x8b\x08 no member WARC/1.0\r\nnor record " * 3
    else:
        plain = rec(2, gz=False).replace(b"Content-Length: ", b"Content-Length: 9", 2)
        parts[2] = warc.member(plain) if gz else plain
    got, gaps = read(b"".join(parts))
    assert got == ids(0, 1, 3, 4, 5)
    assert [(a, b) for a, b, _ in gaps] == [(at, at + len(parts[2]))]


def test_mixed_and_random_damage_never_yields_wrong_records():
    rng = random.Random(1)
    truth = {f"<urn:x-page:{i}>": rec(i, gz=False).split(b"\r\n\r\n", 1)[1][:-4] for i in range(8)}
    for _ in range(60):
        data = bytearray(b"".join(rec(i, gz=rng.random() < .5) for i in range(8)))
        for _ in range(rng.randrange(4)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        end = 0
        for kind, begin, x, y in warc.salvage(io.BytesIO(bytes(data)), len(data)):
            assert begin >= end
            end = x if kind == "gap" else begin
            if kind == "record":
                assert y in truth.values() or "warc-block-digest" not in x


def test_digests_in_base32_and_of_unknown_kind():
    import base64
    plain = rec(1, gz=False)
    block = plain.split(b"\r\n\r\n", 1)[1][:-4]
    hexed = hashlib.sha1(block).hexdigest().encode()
    coded = base64.b32encode(hashlib.sha1(block).digest())
    assert read(warc.member(plain.replace(hexed, coded)))[0] == ids(1)
    assert read(plain.replace(b"Block-Digest: sha1", b"Block-Digest: shx1"))[0] == []


def test_revisits_and_awkward_rows(spark):
    big = "<p>é</p>" * 300
    rows = [(1, "http://a", big, 1), (7, "http://b", big, 1), (3, None, big, 1), (4, "bad\nurl", "small", 1),
            (5, "u", "small", 1), (6, "u", None, 1), (None, "u", big, 1), (8, "u", "z" * 5_000_000, 1),
            (7, "http://b", big, 1), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    man = warc.write_warc(warc.with_revisits(pages), shared_files.new_folder(spark, "w"), file_bytes=2000)
    assert man.count() > 1
    out = warc.read_warc(man)
    assert warc.gaps_of(out).count() == 0
    got = warc.records_of(out).collect()
    assert len(got) == len(rows)
    want = {i: (h or "").encode() for i, _, h, _ in rows}
    for r in got:
        if r["page_id"] is not None:
            body = want[r["page_id"]]
            assert r["payload_bytes"] == len(body) and r["payload_digest"] == hashlib.sha1(body).hexdigest()
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
        assert (r["record_type"] == "revisit") == (r["refers_to"] is not None)
    assert {r["page_id"] for r in got if r["refers_to"] == 7} == {1, 3, None}
    assert warc.write_warc(warc.with_revisits(pages.limit(0)), shared_files.new_folder(spark, "w")).count() == 0


def test_damaged_file_is_logged_as_a_gap(spark, tmp_path):
    bad = bytearray(b"".join(rec(i) for i in range(5)))
    bad[len(rec(0)) + 30] ^= 1
    (tmp_path / "x.warc.gz").write_bytes(bytes(bad))
    out = warc.read_warc(spark.createDataFrame([(str(tmp_path / "x.warc.gz"),)], "path string"))
    assert sorted(r["page_id"] for r in warc.records_of(out).collect()) == [0, 2, 3, 4]
    (gap,) = warc.gaps_of(out).collect()
    assert (gap["begin"], gap["end"]) == (len(rec(0)), len(rec(0)) + len(rec(1)))
    assert warc.records_of(out).filter(F.col("record_type") != "response").count() == 0


def test_a_page_with_a_very_long_url_is_read_back(spark):
    from tidemart.llm import shared_files
    url = "http://h/" + "long/" * 420_000
    pages = spark.createDataFrame([(1, url, "body"), (2, "http://h/x", "y" * 2000), (3, url, "y" * 2000)],
                                  "page_id long, url string, html string")
    manifest = warc.write_warc(warc.with_revisits(pages), shared_files.new_folder(spark, "warc"))
    read = warc.read_warc(manifest)
    assert warc.gaps_of(read).count() == 0
    assert {(r.page_id, r.url == url, r.record_type) for r in warc.whole_records_of(read).collect()} == {
        (1, True, "response"), (2, False, "revisit"), (3, True, "response")}


def test_a_gap_in_an_archive_that_must_be_sound_is_an_error(spark):
    import pytest
    broken = spark.createDataFrame([("f", 7, None, None, None, None, None, None, None, 9, "torn")], warc._RECORD)
    with pytest.raises(Exception, match="torn"):
        warc.whole_records_of(broken).collect()
