"""Legacy archive converter: ARC files (version 1 and 2) to WARC files, with revisit records.

A scan of ARC files parses the header line of each record by the fields of the file's version, takes as many
bytes as the line declares, and splits the HTTP head from the payload.  Conversion makes the WARC fields: an
identifier (name-based, so a repeated task writes the same), an ISO 8601 date from the 14 (or 12) digits, the record
type, and SHA-1 digests of block and payload.  Of records with equal payloads of at least ``MIN_REVISIT`` bytes the
one with the largest page id is a response and the others revisit it.

Payloads are never shuffled: a first pass over the ARC files takes digests, page ids and places; what is found to be
a revisit goes back to its file as a list of places, and a second pass over the files writes the WARC records.

Archives are real files of bytes, one gzip member a record, about ``ARCHIVE_BYTES`` each, written through Spark's own
committer to any file system it knows; a lost executor's task is run again without traces.

Defined cases: a null page is an empty payload; a null or empty URL becomes ``urn:page:<id>``; spaces and controls in
URLs are percent-encoded; HTTP heads may end lines with LF alone; payloads may hold any bytes; a record whose header or
declared length does not fit raises an error; rows that share page id and payload are all responses if that id is the
largest; a null page id never is the response that others revisit unless all ids are null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .storage import shared_dir, small_batches, stored, temporary

MIN_REVISIT = 1000
ARCHIVE_BYTES = 8 << 20
#: Bytes given to the decompressor at once.
PIECE = 16 << 10
#: Effort of compression.
LEVEL = 1
DATE = "20200101000000"

# The field lines of the two versions of the ARC format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space for URLs of RFC 9562
_ARC_DDL = "page_id long,url string,ip string,date string,mime string,status int,version int,head binary,payload binary"
_WARC_DDL = "page_id long,record_type string,record_id string,date string,url string,payload_bytes long,payload_digest string,refers_to long,payload binary"


def _clean(url: str | None, page_id) -> str:
    url = url or f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" if ord(c) < 256 else c for c in url)


def _member(data: bytes) -> bytes:
    """One gzip member, fast rather than small, without a time stamp."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _archives(records, first, limit: int):
    """Gzip files of about ``limit`` bytes of records, each begun by the record that ``first`` makes for its number."""
    parts, size, serial = [], 0, 0
    for r in records:
        if not parts:
            parts = [_member(first(serial))]
            serial += 1
        parts.append(_member(r))
        size += len(r)
        if size >= limit:
            yield b"".join(parts)
            parts, size = [], 0
    if parts:
        yield b"".join(parts)


#: The text sink ends each row, here one file, with a zero byte.  The empty member that closes a file ends with one anyway.
_CLOSE = _member(b"")[:-1]


def _files(archives):
    schema = K.arrow_schema("value binary")
    for a in archives:
        yield K.table(schema, value=[a + _CLOSE])


def _save(rows: DataFrame, write, path: str) -> None:
    files = rows.mapInArrow(write, "value binary").select(F.col("value").cast("string").alias("value"))  # the bytes as they are
    files.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path)


def arc_record(version: int, page_id, url, html, offset: int = 0) -> bytes:
    payload = html if isinstance(html, bytes) else (html or "").encode()
    ident = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{ident}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    fields = [_clean(url, page_id), "0.0.0.0", DATE, "text/html"]
    if version == 2:
        fields += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), "pages.arc"]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def write_arc(pages: DataFrame, path: str, version: int) -> None:
    """Write ``pages`` (page_id, url, html) as ARC files of one version."""
    small_batches(pages.sparkSession)
    about = f"{version} 0 blockloom\n{ARC_FIELDS[version]}\n"
    tail = " 200 - - 0 pages.arc" if version == 2 else ""
    first = f"filedesc://pages.arc 0.0.0.0 {DATE} text/plain{tail} {len(about)}\n{about}\n".encode()

    def write(batches):
        def records():
            for rb in batches:
                for r in rb.to_pylist():
                    yield arc_record(version, r["page_id"], r["url"], r["html"])

        yield from _files(_archives(records(), lambda serial: first, ARCHIVE_BYTES))

    _save(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary")), write, path)


def _inflate(raw: bytes) -> bytes:
    """All members of a gzip file, or the bytes themselves.

    Fed by small pieces: what a member leaves over is copied, and that must not be the rest of the file."""
    out, at, view = [], 0, memoryview(raw)
    while view[at : at + 2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        while not d.eof and at < len(raw):
            piece = view[at : at + PIECE]
            out.append(d.decompress(piece))
            at += len(piece) - len(d.unused_data)
        out.append(d.flush())
    return b"".join(out) if out else raw


def parse_arc(data: bytes):
    """Records of an ARC file as ``(version, fields, block)``; the file description gives the version."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)]
        n_fields = 5 if version == 1 else 10
        if not version:
            if not line.startswith(b"filedesc://"):
                raise ValueError("an ARC file must begin with a file description")
            n_fields = len(line.split(b" "))
        fields = line.rsplit(b" ", n_fields - 1)
        if end < 0 or len(fields) != n_fields or not fields[-1].strip().isdigit():
            raise ValueError(f"malformed ARC header at byte {at}: {line[:100]!r}")
        length = int(fields[-1])
        block = data[end + 1 : end + 1 + length]
        if len(block) != length:
            raise ValueError(f"ARC record at byte {at} declares {length} bytes, {len(block)} are there")
        if not version:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            yield version, [x.decode("utf-8", "replace") for x in fields], block
        at = end + 1 + length


_BLANK = re.compile(rb"\r?\n\r?\n")


def _http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, head and payload; a block without an HTTP head is all payload.  Lines end with CR LF or LF."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    end = _BLANK.search(block)
    at = end.end() if end else len(block)
    lines = block[:at].decode("latin-1").splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, block[:at], block[at:]


def arc_rows(data: bytes) -> Iterator[dict]:
    """Records of an ARC file's bytes (gzip or plain), as they are converted."""
    for version, f, block in parse_arc(_inflate(data)):
        http, head, payload = _http(block)
        page = http.get("x-page-id")
        yield {
            "page_id": int(page) if page else None, "url": f[0], "ip": f[1], "date": f[2], "mime": f[3], "status": int(f[4]) if version == 2 and f[4].isdigit() else None,
            "version": version, "head": head, "payload": payload,
        }


def arc_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, content`` of archive files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").option("recursiveFileLookup", "true").load(list(paths)).select("path", "content")


def read_arc(spark: SparkSession, *paths: str) -> DataFrame:
    """Records of ARC files."""
    small_batches(spark)

    def read(batches):
        schema = K.arrow_schema(_ARC_DDL)
        for rb in batches:
            for raw in rb.column(0).to_pylist():
                rows, size = [], 0
                for r in arc_rows(raw):
                    rows.append(r)
                    size += len(r["payload"])
                    if size >= ARCHIVE_BYTES // 4:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return arc_files(spark, *paths).select("content").mapInArrow(read, _ARC_DDL)


_PLACES = "path string,at int,page_id long,digest binary,size long"


def places(files: DataFrame) -> DataFrame:
    """Where each record stands, with the SHA-1 of its payload and its size: ``_PLACES``."""

    def read(batches):
        schema = K.arrow_schema(_PLACES)
        for rb in batches:
            for path, raw in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                rows = [(at, r["page_id"], hashlib.sha1(r["payload"]).digest(), len(r["payload"])) for at, r in enumerate(arc_rows(raw))]
                if rows:
                    at, page, digest, size = zip(*rows)
                    yield K.table(schema, path=[path] * len(rows), at=at, page_id=page, digest=digest, size=size)

    return files.mapInArrow(read, _PLACES)


def revisits(found: DataFrame) -> DataFrame:
    """``path, revisits``: the places in each file that are revisits, with the page id they refer to."""
    large = found.where(F.col("size") >= MIN_REVISIT)
    # counts and maxima meet after partial aggregation: a payload held by many pages sends one row a task
    best = large.groupBy("digest").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1 and best is not null").select("digest", "best")
    to = large.join(best, "digest").where(~F.col("page_id").eqNullSafe(F.col("best")))
    return to.groupBy("path").agg(F.collect_list(F.struct("at", "best")).alias("revisits"))  # within the records of one file


def _record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"


def _page_name(url: str, page_id, digest: bytes) -> str:
    """What a record is named after; ids that repeat are told apart by their payloads."""
    return f"page:{page_id}:{digest.hex()}" if page_id is not None else f"{url}:{digest.hex()}"


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _sha1(block: bytes) -> str:
    return _digest(hashlib.sha1(block).digest())


def _iso(date: str) -> str:
    d = (date + "00000000000000")[:14] if date.isdigit() else DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: dict, refers_to: int | None = None) -> bytes:
    """One WARC record from an ARC record; a revisit keeps the HTTP head only."""
    revisit = refers_to is not None
    sha1 = hashlib.sha1(r["payload"]).digest()
    block = r["head"] if revisit else r["head"] + r["payload"]
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _record_id(_page_name(r["url"], r["page_id"], sha1)),
        "WARC-Date": _iso(r["date"]), "WARC-Target-URI": r["url"], "WARC-IP-Address": r["ip"],
        "Content-Type": "application/http;msgtype=response" if r["head"] else r["mime"],
        "WARC-Payload-Digest": _digest(sha1), "WARC-Block-Digest": _sha1(block),
    }
    if revisit:
        head |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _record_id(_page_name("", refers_to, sha1)),
            "X-Refers-To-Page-Id": str(refers_to), "X-Payload-Bytes": str(len(r["payload"])), **({"X-Page-Id": str(r["page_id"])} if r["page_id"] is not None else {}),
        }
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(files: DataFrame, revisits: DataFrame, path: str) -> None:
    """Convert ARC files ``(path, content)`` to WARC files; one row for each file says which of its records are revisits."""
    info = b"software: blockloom\r\n"

    def write(batches):
        for rb in batches:
            for name, raw, to in zip(*(rb.column(i).to_pylist() for i in range(3))):
                best = {x["at"]: x["best"] for x in to or ()}

                def first(serial: int) -> bytes:
                    ident = _record_id(f"warcinfo:{name.rsplit('/arc/', 1)[-1]}:{serial}").encode()
                    head = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + ident + b"\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: "
                    return head + str(len(info)).encode() + b"\r\n\r\n" + info + b"\r\n\r\n"

                yield from _files(_archives((warc_record(r, best.get(at)) for at, r in enumerate(arc_rows(raw))), first, ARCHIVE_BYTES))

    _save(files.join(revisits, "path", "left").select("path", "content", "revisits"), write, path)


def parse_warc(data: bytes):
    """Records of a WARC file as ``(header fields, block)``."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"malformed WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:end].decode().split("\r\n")[1:])}
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError(f"WARC record at byte {at} declares {length} bytes, {len(block)} are there")
        yield fields, block
        at = end + 4 + length


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of WARC files; digests of responses are verified."""

    def read(batches):
        schema = K.arrow_schema(_WARC_DDL)
        for rb in batches:
            for raw in rb.column(0).to_pylist():
                rows, size = [], 0
                for f, block in parse_warc(_inflate(raw)):
                    if f["warc-type"] not in ("response", "revisit"):
                        continue
                    http, _, payload = _http(block)
                    revisit = f["warc-type"] == "revisit"
                    if not revisit and _sha1(payload) != f["warc-payload-digest"]:
                        raise ValueError(f"payload digest of {f['warc-record-id']} does not fit")
                    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                    page, to = http.get("x-page-id") or f.get("x-page-id"), f.get("x-refers-to-page-id")
                    n = int(f["x-payload-bytes"]) if revisit and "x-payload-bytes" in f else int(http["content-length"]) if revisit else len(payload)
                    rows.append((int(page) if page else None, f["warc-type"], f["warc-record-id"], f["warc-date"], f["warc-target-uri"], n, digest, int(to) if to else None, payload if payloads else None))
                    size += len(block)
                    if size >= ARCHIVE_BYTES // 4:
                        yield K.table(schema, **dict(zip(schema.names, zip(*rows))))
                        rows, size = [], 0
                if rows:
                    yield K.table(schema, **dict(zip(schema.names, zip(*rows))))

    return arc_files(spark, path).select("content").mapInArrow(read, _WARC_DDL)


def convert(pages: DataFrame) -> DataFrame:
    """Pages through both ARC versions and WARC files, read back."""
    spark = pages.sparkSession
    small_batches(spark)
    path = temporary(spark, f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}")
    odd = F.pmod(F.coalesce(F.xxhash64("page_id"), F.lit(0)), F.lit(2)) == 1
    write_arc(pages.where(~odd), f"{path}/arc/1", 1)
    write_arc(pages.where(odd), f"{path}/arc/2", 2)
    files = arc_files(spark, f"{path}/arc")
    write_warc(files, revisits(stored(places(files), "archive-places")), f"{path}/warc")
    return read_warc(spark, f"{path}/warc", payloads=False)
