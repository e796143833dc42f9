"""WARC archives written by Spark, and a reader that salvages what damage has left.

Writing: one record per row, each a gzip member of its own.  Records with equal payloads are
kept once: the row with the smallest id is the response, the others are revisits that name it.  Records
are shaped where the rows are; Spark's own writer puts them on whatever file system the path
names, and its commit protocol leaves no half-written file behind a lost executor.  It ends
every row with a separator, and the last byte of a gzip member, the highest of its
length, is always zero below 16 MiB: that byte is the separator.  A longer record is followed by an empty member.

Reading: every archive is read front to back.  A member or plain record that fails a check (checksum,
version line, headers, length, payload digest) is skipped up to the next place where a valid
one begins; the bytes between are logged as a quarantined gap with the reason.

Defined results: a null payload is empty; a null id is written as ``null`` and read as null; a null URL
gives no header; control characters in a URL are percent-encoded.  Rows that repeat the smallest id of a
payload are responses too.  Null ids revisit the smallest id there is, or are responses where there is none.
Payloads shorter than ``least`` bytes are always responses.  An empty table gives an empty archive and no records.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

VERSION = b"WARC/1.1"
#: Records in one file at most; an archive is read as a whole.
FILE_RECORDS = 5000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Written in place of the time of a fetch, which the rows do not have.
DATE = datetime(1970, 1, 1, tzinfo=timezone.utc)

_URN = "urn:x-page:"
_CHUNK = 1 << 16
_NAMES = ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-refers-to", "warc-payload-digest", "x-payload-length")
_GZIP = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
#: A blank line ends headers of any length; the next record's version line says that they were torn off.
_HEAD_END = re.compile(rb"\r\n(?:\r\n|WARC/1\.[0-9]\r\n)")

RECORDS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("problem", T.StringType()),  # set for a quarantined gap, which has no record
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_length", T.LongType()),  # of the full payload, also where it is not repeated
        T.StructField("payload", T.BinaryType()),
    ]
)


# -- records -------------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(record_id: str, url: str | None, payload: bytes, refers_to: str | None = None, date: datetime = DATE) -> bytes:
    """One record, uncompressed.  A revisit keeps digest and length of the payload and not the payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_URN}{record_id}>",
        f"WARC-Date: {date.strftime('%Y-%m-%dT%H:%M:%SZ')}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member whose last byte is zero: an empty member follows where the record is too long for that."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    if out[-1:] != b"\0":
        empty = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += empty.compress(b"") + empty.flush()
    return out


# -- writing -------------------------------------------------------------------------


def with_first(pages: DataFrame, least: int = 0) -> DataFrame:
    """Rows ``id, url, payload`` get ``refers_to``: the smallest id with the same payload, null for a response.

    Only payloads that occur more than once are joined back; their list is aggregated before the
    shuffle and stored, so a payload that most rows share is split like any skewed join.
    """
    digest = F.sha1("payload")
    keyed = pages.select("id", "url", "payload", F.when(F.octet_length("payload") >= least, digest).alias("__sha1"))
    shared = pages.where(F.octet_length("payload") >= least).groupBy(digest.alias("__same")).agg(
        F.min("id").alias("__first"), F.count(F.lit(1)).alias("n")
    )
    shared = stored(shared.where("n > 1 and __first is not null").drop("n"), "shared")
    joined = keyed.join(shared, keyed["__sha1"] == shared["__same"], "left")
    other = ~F.col("__first").eqNullSafe(F.col("id"))
    return joined.select("id", "url", "payload", F.when(F.col("__first").isNotNull() & other, F.col("__first")).alias("refers_to"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        # One byte less each: the writer's separator is the last one.
        out = [member(record_bytes(i if i is not None else "null", u, p, r))[:-1] for i, u, p, r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> None:
    """Write one record per row below ``path``."""
    rows = pages.select(
        F.col(key).alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    linked = with_first(rows, least).select(F.col("id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    members = linked.mapInArrow(_members, "value binary").select(F.col("value").cast("string"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", FILE_RECORDS).text(path)


# -- reading -------------------------------------------------------------------------


class Damaged(ValueError):
    """A failed check."""


@dataclass
class Found:
    """A record and the place after it."""

    headers: dict[str, str]
    block: bytes
    end: int


def _plain_record(data: bytes | memoryview, at: int, whole: bool) -> Found:
    """The record whose version line begins at ``at``; with ``whole`` nothing may follow it."""
    stop = _HEAD_END.search(data, at)
    if not stop or stop[0] != b"\r\n\r\n":
        raise Damaged("headers do not end")
    first, *lines = bytes(data[at : stop.start()]).split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[0-9]", first):
        raise Damaged("no version line")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("malformed header")
        known = name.decode("utf-8", "replace").strip().lower()
        if known in headers and known != "warc-concurrent-to":
            raise Damaged("repeated header")  # a record torn off in its headers, and another after it
        headers[known] = value.decode("utf-8", "replace").strip()
    if not re.fullmatch("[0-9]+", headers.get("content-length", "")):
        raise Damaged("no content length")
    start = stop.end()
    end = start + int(headers["content-length"])
    if bytes(data[end : end + 4]) != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    block = bytes(data[start:end])
    wanted = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") == "response" and wanted.startswith("sha1:") and wanted[5:] != digest_of(block):
        raise Damaged("payload digest differs")
    if whole and end + 4 != len(data):
        raise Damaged("bytes after the record in its member")
    return Found(headers, block, end + 4)


def _inflate(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content of the gzip member at ``at`` and the place after it; fed in pieces, so nothing after it is copied."""
    unpacker, parts, place = zlib.decompressobj(31), [], at
    while not unpacker.eof:
        if place >= len(data):
            raise Damaged("member is cut off")
        try:
            parts.append(unpacker.decompress(data[place : place + _CHUNK]))
        except zlib.error as e:
            raise Damaged(f"member does not inflate: {e}") from None
        place += _CHUNK
    return b"".join(parts), min(place, len(data)) - len(unpacker.unused_data)


def _record_at(data: memoryview, at: int) -> Found | None:
    """The record or member at a place; None for an empty member."""
    if bytes(data[at : at + 3]) != _GZIP:
        return _plain_record(data, at, False)
    content, end = _inflate(data, at)
    if not content:
        return Found({}, b"", end)
    found = _plain_record(content, 0, True)
    return Found(found.headers, found.block, end)


def salvage(content: bytes) -> Iterator[tuple[int, int, str | None, Found | None]]:
    """Offset, length, problem and record of everything in an archive, front to back, without a byte left out."""
    data, at, size = memoryview(content), 0, len(content)
    gap: int | None = None
    problem = ""
    while at < size:
        try:
            found = _record_at(data, at)
        except Damaged as e:
            if gap is None:
                gap, problem = at, str(e)
            after = _START.search(content, at + 1)
            at = after.start() if after else size
            continue
        if gap is not None:
            yield gap, at - gap, problem, None
            gap = None
        if found.headers:
            yield at, found.end - at, None, found
        at = found.end
    if gap is not None:
        yield gap, size - gap, problem, None


def _rows(path: str, content: bytes) -> Iterator[tuple]:
    for offset, length, problem, found in salvage(content):
        if found is None:
            yield (path, offset, length, problem, *[None] * 8)
            continue
        kind, record_id, uri, date, refers, digest, size = (found.headers.get(n) for n in _NAMES)
        bare = [v[1:-1].removeprefix(_URN) if v and v[0] == "<" else v for v in (record_id, refers)]
        length_of = int(size) if size and size.isdigit() else len(found.block)
        if kind != "revisit":
            length_of = len(found.block)
        yield (path, offset, length, None, kind, bare[0], uri, date, bare[1], (digest or "").removeprefix("sha1:") or None, length_of, found.block)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 7, pa.int64(), pa.binary()]
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows: list[tuple] = []
            held = 0
            for row in _rows(path.as_py(), content.as_py()):
                rows.append(row)
                held += len(row[-1] or b"")
                if held > 8 << 20:
                    yield _batch(rows, types)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, types)


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=RECORDS.names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Everything in the archives below ``path``: records, and gaps with their ``problem``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_parse, RECORDS)


def records(everything: DataFrame) -> DataFrame:
    """The records only."""
    return everything.where(F.col("problem").isNull())


def gaps(everything: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return everything.where(F.col("problem").isNotNull()).select("path", "offset", "length", "problem")
