"""WARC archives: a writer of gzip members, and a reader that salvages damaged files.

**Writing.** Each record is one gzip member. Spark's text writer puts the members into
files through the session's own file system: members are written as raw bytes, and the
separator between them is an empty gzip member, so that a file is a valid series of
members throughout. A payload that several records share is stored once; the others
are revisit records that name the one they refer to.

**Reading.** A reader goes from member to member (or from version line to version line in
files that aren't compressed). A record must decompress, parse, have its stated length,
and match its block digest. If it doesn't, the reader looks for the next place at which
a record passes these checks, goes on there, and logs the bytes between as a gap. Places
of marks, and compressed data that failed, are remembered, so that the time grows with
the length of a file, however many records or false marks it has.

Null payloads are empty ones. A null id is kept as null. Rows that repeat the largest id
of a payload are responses all.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import common

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
#: Records per archive file; a reader holds one file at a time.
RECORDS_PER_FILE = 2000
LEVEL = 6
#: A header line may have this many bytes; what has more is no record.
MAX_LINE = 1 << 20
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
#: Names records by their page; from the payload's page, not from chance, so that a repeated task writes the same bytes.
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = b"2025-01-01T00:00:00Z"


def _member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


EMPTY_MEMBER = _member(b"")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> bytes:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>".encode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record's bytes: a resource-like response, or a revisit without the payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    head = [
        VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + record_id(page_id), b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + " ".join((url or "").split()).encode(), b"Content-Type: text/html", b"WARC-Payload-Digest: sha1:" + digest32(payload).encode(),
        b"WARC-Block-Digest: sha1:" + digest32(block).encode(), b"X-Payload-Length: %d" % len(payload)]
    if page_id is not None:
        head.append(b"X-Page-Id: %d" % page_id)
    if revisit:
        head += [b"WARC-Refers-To: " + record_id(refers_to), b"X-Refers-To-Page-Id: %d" % refers_to, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block), b"", b""]) + block + b"\r\n\r\n"


class Found(NamedTuple):
    """A record, or a gap (without headers) of bytes in which there is none."""

    offset: int
    length: int
    headers: dict[str, str] | None
    block: bytes


class _File:
    """A file's bytes, with what is already known of them, so that no stretch is searched or inflated twice."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        self._known: dict[tuple[bytes, int], tuple[int, int]] = {}
        self.failed: set[int] = set()  # where compressed data begin that are no sound member's

    def next(self, mark: bytes, at: int, asker: int = 0) -> int:
        """The next place of a mark at or after ``at``; the file's length if there is none. Each asker goes forward on the whole."""
        since, place = self._known.get((mark, asker), (0, -1))
        if at > place:
            found = self.data.find(mark, at)
        elif at >= since:
            return place
        else:
            found = self.data.find(mark, at, since + len(mark) - 1)
            found = place if found < 0 else found
        place = len(self.data) if found < 0 else found
        self._known[mark, asker] = (at, place)
        return place

    def body(self, at: int) -> int | None:
        """Where the compressed data of the member at a place begin, or None if its header is not sound."""
        data, begin = self.data, at + 10
        if len(data) < begin or data[at + 3] & 0xE0:
            return None
        flags = data[at + 3]
        if flags & 4:
            begin += 2 + int.from_bytes(data[begin:begin + 2], "little")
        for named in (8, 16):
            if flags & named:
                begin = self.next(b"\0", begin, named) + 1
        begin += flags & 2
        return begin if begin < len(data) else None


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Headers of the record at a place and where its block begins; read line by line, up to the first that is no header."""
    version = _VERSION_LINE.match(data, at)
    if version is None:
        return None
    headers, name, begin = {}, None, version.end()
    while (end := data.find(b"\r\n", begin, begin + MAX_LINE)) > begin:
        try:
            line = data[begin:end].decode("utf-8")
        except UnicodeDecodeError:
            return None
        if line[0] in " \t" and name is not None:
            headers[name] += " " + line.strip()
        else:
            name, colon, value = line.partition(":")
            if not colon:
                return None
            name = name.strip().lower()
            headers[name] = value.strip()
        begin = end + 2
    return (headers, begin + 2) if end == begin else None


def _parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record at a place, or None if a check fails."""
    found = _headers(data, at)
    if found is None:
        return None
    headers, begin = found
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return None
    stop = begin + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        return None
    block = data[begin:stop]
    want = headers.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != digest32(block):
        return None
    return headers, block, stop + 4


def _inflate(file: _File, body: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member whose compressed data begin at a place, or None if its own checks fail.

    Windows of the file are inflated, each twice the last, so that a member costs its own length only.
    """
    data, inflate, out, end, window = file.data, zlib.decompressobj(-zlib.MAX_WBITS), [], body, 4096
    try:
        while not inflate.eof and end < len(data):
            out.append(inflate.decompress(data[end:end + window]))
            end, window = min(len(data), end + window), 2 * window
    except zlib.error:
        return None
    end -= len(inflate.unused_data)
    content = b"".join(out)
    sums = struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    return (content, end + 8) if inflate.eof and data[end:end + 8] == sums else None


def _member_at(file: _File, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int] | None:
    """All records of the gzip member at a place (none in an empty one) and its end, or None if a check fails."""
    body = file.body(at)
    if body is None or body in file.failed:
        return None
    member = _inflate(file, body)
    records, inner = [], 0
    while member is not None and inner < len(member[0]):
        one = _parse(member[0], inner)
        if one is None:
            member = None
        else:
            records.append(one[:2])
            inner = one[2]
    if member is None:
        file.failed.add(body)
        return None
    return records, member[1]


def _record_at(file: _File, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int] | None:
    """The records of the member, or the plain record, at a place, and its end."""
    if file.data.startswith(MAGIC, at):
        return _member_at(file, at)
    one = _parse(file.data, at)
    return one and ([one[:2]], one[2])


def salvage(data: bytes) -> Iterator[Found]:
    """All records of a file in order, and the gaps between them."""
    file, at, gap = _File(data), 0, None
    while at < len(data):
        found = _record_at(file, at)
        if found is None:
            if gap is None:
                gap = at
            at = min(file.next(MAGIC, at + 1), file.next(b"WARC/", at + 1))
            continue
        if gap is not None and found[0]:
            yield Found(gap, at - gap, None, b"")
            gap = None
        records, end = found
        for headers, block in records:
            yield Found(at, end - at, headers, block)
        at = end
    if gap is not None:
        yield Found(gap, len(data) - gap, None, b"")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Archives of all pages in ``folder``; of equal payloads, that with the largest id is kept."""
    spark = pages.sparkSession
    common.small_batches(spark)
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html"))
    # Only ids and digests are shuffled; a page that many share is combined before it is.
    ids = own.select("page_id", F.unhex(F.sha1(F.col("html").cast("binary"))).alias("digest"))
    kept = ids.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = common.written(ids.join(kept, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct(), common.scratch(spark))
    # Ids may repeat with other payloads, so the digest is compared, too.
    marked = own.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary")))).join(revisits, ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "html"):
                rows = zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")))
                yield pa.RecordBatch.from_arrays([pa.array([_member(record(p, u, h.encode(), r)) for p, u, h, r in rows], pa.binary())], ["value"])

    members = marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "value binary")
    (members.select(F.col("value").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records and gaps of the archives under ``folder``.

    (path, at, length, gap, page_id, record_type, target_uri, payload_bytes, payload_digest, refers_to, payload).
    """
    schema = "path string, at long, length long, gap boolean, page_id long, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(functools.partial(_read, ROWS=200), schema)


_READ = pa.schema([("path", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("gap", pa.bool_()), ("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch], ROWS: int) -> Iterator[pa.RecordBatch]:
    number = lambda x: None if x is None else int(x)
    rows: list[tuple] = []
    pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)
    for batch in batches:
        for i in range(batch.num_rows):
            path = batch.column("path")[i].as_py()
            for r in salvage(batch.column("content")[i].as_py()):
                h = r.headers
                rows.append((path, r.offset, r.length, h is None, *([None] * 6 if h is None else (
                    number(h.get("x-page-id")), h.get("warc-type"), h.get("warc-target-uri"), number(h.get("x-payload-length", len(r.block))),
                    h.get("warc-payload-digest", "").removeprefix("sha1:") or None, number(h.get("x-refers-to-page-id")))), r.block))
                if len(rows) >= ROWS:
                    yield pack()
                    rows.clear()
    if rows:
        yield pack()


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write the pages' archives, read them back, and give each record's digest row. A gap fails: nothing may be lost on the way."""
    spark = pages.sparkSession
    folder = common.scratch(spark)
    write(pages, folder, **columns)
    found = read(spark, folder)
    sound = F.when(F.col("gap"), F.raise_error(F.concat(F.lit("damaged archive "), "path"))).otherwise(F.col("page_id"))
    return found.select(sound.cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
