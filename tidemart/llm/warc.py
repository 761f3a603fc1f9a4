"""WARC archives with a salvage reader (op 4).

Pages are written as WARC 1.1 records, one gzip member each. Of pages with
equal payloads of at least ``min_revisit_bytes`` one is stored in full and the
others are revisit records that refer to it. The reader checks every record
(member checksum, version line, length, block and payload digests). After a
failed check it searches for the next gzip member or version line that begins a
record passing all checks, goes on from there, and logs the skipped bytes as a
gap with the reason. Compressed and plain records may be mixed. The format has
no check over a plain record's header fields, only over its block; a gzip
member's checksum covers both.

Defined results: NULL html is an empty payload; a NULL page_id is written as
``null`` and read back as NULL, and never chosen while another has an id;
repeated rows keep a record each, and rows that share the chosen page_id and
payload are all responses; a NULL url gives no target header, control
characters in a url are percent-encoded; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_files
from .common import write_and_reread

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
PLAIN_END = b"\r\n\r\n"
MANDATORY = {"warc-record-id", "warc-date", "warc-type", "content-length"}  # fixed values


def _id(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
    return int(m[1]) if m else None


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool,
                 date: str = DATE) -> bytes:
    """One plain WARC record. A revisit holds the HTTP head alone, whose length
    line still tells the full payload's size."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}",
              f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + PLAIN_END


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Damaged(Exception):
    pass


def check_digest(said: str | None, data: bytes, what: str) -> None:
    """``said`` is ``algorithm:value`` in hex or base 32, or absent."""
    if said is None:
        return
    algorithm, _, value = said.partition(":")
    if algorithm not in hashlib.algorithms_available:
        raise Damaged(f"{what} digest of an unknown kind")
    h = hashlib.new(algorithm, data)
    if value.lower() != h.hexdigest() and value != base64.b32encode(h.digest()).decode():
        raise Damaged(f"{what} digest differs")


def parse_record(f, pos: int):
    """The plain record at ``pos`` of the seekable ``f``: (headers, block, end)."""
    f.seek(pos)
    head, step = bytearray(), 4096
    while (end := head.find(PLAIN_END, max(0, len(head) - step // 2 - len(PLAIN_END)))) < 0:
        more = f.read(step)
        if not more:
            raise Damaged("header without end")
        head += more
        step *= 2  # a header is as long as its url
    head = bytes(head[:end])
    lines = head.split(b"\r\n")
    if not lines[0].startswith(VERSION):
        raise Damaged("no version line")
    fields = {}
    for x in lines[1:]:
        name, colon, value = x.partition(b":")
        if not colon:
            raise Damaged("broken header")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not size.isdigit() or not MANDATORY <= fields.keys():
        raise Damaged("header without a mandatory field")
    begin = pos + len(head) + len(PLAIN_END)
    f.seek(begin)
    block = f.read(int(size))
    if len(block) < int(size):
        raise Damaged("record cut short")
    if f.read(len(PLAIN_END)) != PLAIN_END:
        raise Damaged("record does not end where it says")
    check_digest(fields.get("warc-block-digest"), block, "block")
    return fields, block, begin + int(size) + len(PLAIN_END)


def read_member(f, pos: int):
    """The gzip member at ``pos``: (content, end)."""
    f.seek(pos)
    d, out, fed = zlib.decompressobj(31), [], 0
    try:
        while not d.eof:
            data = f.read(1 << 14)
            if not data:
                raise Damaged("member cut short")
            fed += len(data)
            out.append(d.decompress(data))
            if fed <= 1 << 14 and not (out[0][:7] or VERSION).startswith(VERSION[:len(out[0][:7])]):
                raise Damaged("member holds no record")
    except zlib.error as e:
        raise Damaged("member check failed") from e
    return b"".join(out), pos + fed - len(d.unused_data)


def record_at(f, pos: int):
    """The record at ``pos``, plain or compressed: (headers, block, end)."""
    f.seek(pos)
    if f.read(3) == GZIP:
        data, end = read_member(f, pos)
        fields, block, used = parse_record(io.BytesIO(data), 0)
        if used != len(data):
            raise Damaged("member holds more than a record")
        return fields, block, end
    return parse_record(f, pos)


def _next_start(f, pos: int, size: int) -> int:
    """The first place from ``pos`` on where a member or version line may begin."""
    step = 1 << 20
    while pos < size:
        f.seek(pos)
        data = f.read(step + len(VERSION) - 1)
        hits = [i for i in (data.find(GZIP), data.find(VERSION)) if 0 <= i < step]
        if hits:
            return pos + min(hits)
        pos += step
    return size


def salvage(f, size: int):
    """Yields ("record", begin, headers, block) for every sound record and
    ("gap", begin, end, reason) for every skipped stretch, in file order."""
    pos, bad_from, reason = 0, None, ""
    while pos < size:
        try:
            fields, block, end = record_at(f, pos)
        except Damaged as e:
            if bad_from is None:
                bad_from, reason = pos, str(e)
            pos = _next_start(f, pos + 1, size)
            continue
        if bad_from is not None:
            yield "gap", bad_from, pos, reason
            bad_from = None
        yield "record", pos, fields, block
        pos = end
    if bad_from is not None:
        yield "gap", bad_from, size, reason


def with_revisits(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, keeper`` (the page stored in full for
    this payload; NULL where the payload stands once or is small)."""
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    shared = (rows.filter(F.col("size") >= min_revisit_bytes).groupBy("digest", "size")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1").drop("_n"))
    return rows.join(shared, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", "keeper")


def write_warc(records: DataFrame, folder: str, *, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``records`` (see ``with_revisits``); returns the manifest of files."""

    def run(batches):
        out, serial, path, n, size = None, 0, "", 0, 0
        names = ["path", "n_records", "n_bytes"]

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size])], names=names)

        for b in batches:
            for row in zip(*[c if i == 2 else c.to_pylist() for i, c in enumerate(b.columns)]):
                page, url, payload, digest, keeper = row
                if out is None:
                    path = f"{folder}/{shared_files.attempt_name(serial)}.warc.gz"
                    out, n, size = shared_files.create(path), 0, 0
                revisit = keeper is not None and keeper != page
                data = member(record_bytes(page, url, payload.as_py(), digest, keeper, revisit))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    yield close()
                    out, serial = None, serial + 1
        if out is not None:
            yield close()

    return write_and_reread(
        records.mapInArrow(run, "path string, n_records bigint, n_bytes bigint"), "warc-manifest")


MAX_READ_TASKS = 20_000
_RECORD = ("path string, offset bigint, page_id bigint, url string, record_type string, "
           "refers_to bigint, payload_digest string, payload_bytes bigint, payload binary, "
           "gap_end bigint, gap_reason string")


def _payload(fields: dict, block: bytes):
    """(payload, its size) of an HTTP response or revisit; the digest is checked."""
    head, _, payload = block.partition(PLAIN_END)
    if fields["warc-type"] == "revisit":
        m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return None, int(m[1]) if m else None
    check_digest(fields.get("warc-payload-digest"), payload, "payload")
    return payload, len(payload)


def read_warc(manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Rows of all records and gaps of the files in ``manifest`` (path): a gap
    has ``gap_end`` and ``gap_reason``, a record has the other columns
    (``payload`` only if asked for)."""
    n = manifest.count()
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def run(batches):
        def flush(rows):
            cols = list(zip(*rows))
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                     pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        rows, held = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                with shared_files.read(path) as raw:
                    size = raw.size()
                    f = io.BufferedReader(raw, 1 << 20)
                    for kind, begin, x, y in salvage(f, size):
                        if kind == "gap":
                            rows.append((path, begin, *[None] * 7, x, y))
                        else:
                            try:
                                data, n_bytes = _payload(x, y)
                            except Damaged as e:
                                rows.append((path, begin, *[None] * 7, None, str(e)))
                                continue
                            rows.append((path, begin, _page_of(x.get("warc-record-id")),
                                         x.get("warc-target-uri"), x["warc-type"],
                                         _page_of(x.get("warc-refers-to")),
                                         x.get("warc-payload-digest", "").removeprefix("sha1:"),
                                         n_bytes, data if payloads else None, None, None))
                            held += len(y)
                        if len(rows) >= 1000 or held > 16 << 20:
                            yield flush(rows)
                            rows, held = [], 0
        if rows:
            yield flush(rows)

    return (manifest.select("path").repartition(max(1, min(n, MAX_READ_TASKS)))
            .mapInArrow(run, _RECORD))


def records_of(read: DataFrame) -> DataFrame:
    return read.filter("gap_reason is null").drop("gap_end", "gap_reason")


def whole_records_of(read: DataFrame) -> DataFrame:
    """The records of archives that must be sound: a gap is an error."""
    broken = F.raise_error(F.concat_ws(" ", F.col("path"), F.lit("is damaged at"), F.col("offset"), F.col("gap_reason")))
    whole = F.when(F.col("gap_reason").isNotNull(), broken).otherwise(F.col("path"))
    return read.withColumn("path", whole).filter("path is not null").drop("gap_end", "gap_reason")


def gaps_of(read: DataFrame) -> DataFrame:
    """The log of quarantined stretches: path, begin, end, reason."""
    return read.filter("gap_reason is not null").select(
        "path", F.col("offset").alias("begin"), F.col("gap_end").alias("end"), F.col("gap_reason").alias("reason"))
