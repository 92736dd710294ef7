"""WARC archives: a writer, and a reader that salvages what damaged archives still hold."""

from __future__ import annotations

import base64
import hashlib
import logging
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, new_path, stage

#: A new archive begins beyond so many bytes; one record is never cut.
ARCHIVE_BYTES = 16 << 20
#: Bytes of an archive that are held at once, and that are unpacked at once.
WINDOW, CHUNK = 1 << 20, 1 << 14
#: The longest header.
HEADER_BYTES = 1 << 20
MEMBER = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
DATE = "2024-01-01T00:00:00Z"

log = logging.getLogger(__name__)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """A record as a gzip member. With an original it is a revisit, whose block has the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {uri}"] if uri else []), f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        *([
            f"WARC-Refers-To: <urn:page:{original}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ] if original is not None else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class Record(NamedTuple):
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


class Source:
    """Bytes of an archive, of which one window is held at a time. The file is anything with pyarrow's read_at and size."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.size = file, file.size()
        self.start, self.window = 0, b""

    def get(self, at: int, n: int) -> bytes:
        """n bytes from a place, fewer at the end."""
        n = max(0, min(n, self.size - at))
        if not self.start <= at <= at + n <= self.start + len(self.window):
            self.start, self.window = at, self.file.read_at(min(max(n, WINDOW), self.size - at), at)
        return self.window[at - self.start : at - self.start + n]

    def find(self, at: int, *marks: bytes) -> int:
        """Where the next of the marks begins; the size, if none does."""
        longest = max(map(len, marks))
        while at < self.size:
            part = self.get(at, WINDOW)
            if places := [p for m in marks if (p := part.find(m)) >= 0]:
                return at + min(places)
            at += max(1, len(part) - longest + 1)
        return self.size


def _header(plain: bytes) -> tuple[dict[str, str], int] | None:
    """A record's headers and where its block begins; None if more bytes are needed. ValueError says what is wrong."""
    if not plain.startswith(VERSION[: len(plain)]):
        raise ValueError("no version line")
    end = plain.find(b"\r\n\r\n")
    if end < 0:
        if len(plain) > HEADER_BYTES:
            raise ValueError("header without an end")
        return None
    headers = {}
    for line in plain[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without a colon")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdigit():
        raise ValueError("no content length")
    return headers, end + 4


def _checked(headers: dict[str, str], block: bytes) -> bytes:
    want = headers.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != sha1_base32(block):
        raise ValueError("block digest differs")
    return block


def _plain(source: Source, at: int) -> Record:
    """The record at a place, not compressed. Its block is read once all else is right."""
    n = 4096
    while (got := _header(source.get(at, n))) is None:
        if at + n >= source.size:
            raise ValueError("header without an end")
        n *= 2
    headers, start = got
    length = int(headers["content-length"])
    if source.get(at + start + length, 4) != b"\r\n\r\n":
        raise ValueError("block is cut short or overlong")
    return Record(at, start + length + 4, headers, _checked(headers, source.get(at + start, length)))


def _member(source: Source, at: int) -> Record:
    """The record in the gzip member at a place. Unpacking ends as soon as the member can't be one record."""
    unpack, plain, got, fed = zlib.decompressobj(31), bytearray(), None, 0
    while not unpack.eof:
        part = source.get(at + fed, CHUNK)
        if not part:
            raise ValueError("gzip: member is cut short")
        fed += len(part)
        try:
            plain += unpack.decompress(part, CHUNK * 16)
            while unpack.unconsumed_tail and not unpack.eof and (got is None or len(plain) <= got[1] + int(got[0]["content-length"]) + 4):
                got = got or _header(bytes(plain))
                plain += unpack.decompress(unpack.unconsumed_tail, CHUNK * 16)
        except zlib.error as e:
            raise ValueError(f"gzip: {e}") from e
        got = got or _header(bytes(plain))
        if got and len(plain) > got[1] + int(got[0]["content-length"]) + 4:
            raise ValueError("member holds more than a record")
    if got is None:
        raise ValueError("header without an end")
    headers, start = got
    stop = start + int(headers["content-length"])
    if len(plain) != stop + 4 or plain[stop:] != b"\r\n\r\n":
        raise ValueError("block is cut short or overlong")
    return Record(at, fed - len(unpack.unused_data), headers, _checked(headers, bytes(plain[start:stop])))


def salvage(data: bytes | Source) -> Iterator[Record | Gap]:
    """Records of an archive, gzip members or plain, in their order, and the bytes between that hold none.

    When a check fails, the next gzip magic number or version line at which a whole valid record begins is looked for;
    everything up to it is one gap, which is reported with the first failure's reason. An empty archive gives nothing.
    The archive is read in windows, so time is in proportion to its bytes, and memory to its largest record. A header of
    more than HEADER_BYTES is no header.
    """
    source = data if isinstance(data, Source) else Source(pa.BufferReader(data))
    at, bad, reason = 0, None, ""
    while at < source.size:
        try:
            head = source.get(at, len(VERSION))
            if head.startswith(MEMBER):
                record = _member(source, at)
            elif head == VERSION:
                record = _plain(source, at)
            else:
                raise ValueError("neither a gzip member nor a version line")
        except ValueError as e:
            if bad is None:
                bad, reason = at, str(e)
            at = source.find(at + 1, MEMBER, VERSION)
            continue
        if bad is not None:
            yield Gap(bad, at - bad, reason)
            bad = None
        yield record
        at += record.length
    if bad is not None:
        yield Gap(bad, source.size - bad, reason)


def write(pages: DataFrame, path: str) -> DataFrame:
    """Write rows (page_id, url, payload binary, payload_digest, refers_to) as archives under path; returns what was written.

    A task rolls over to a new archive at ARCHIVE_BYTES. Each is written under another name first and then renamed, and
    a task that runs again makes the same names and bytes.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        context = TaskContext.get()
        name, held, size, nth, done = f"pages-{context.partitionId():06d}", [], 0, 0, []

        def close() -> None:
            target = f"{root}/{name}-{nth:05d}.warc.gz"
            own = f"{root}/_tmp-{name}-{nth}-{context.taskAttemptId()}"
            with store.open_output_stream(own) as f:
                for x in held:
                    f.write(x)
            store.move(own, target)
            done.append((target, len(held), size))

        for batch in batches:
            for row in batch.to_pylist():
                held.append(encode_record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"]))
                size += len(held[-1])
                if size > ARCHIVE_BYTES:
                    close()
                    held, size, nth = [], 0, nth + 1
        if held:
            close()
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], ["archive", "records", "bytes"])

    _mkdir(path)
    return stage(pages.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(task, "archive string, records long, bytes long"), "warc-list")


def _mkdir(path: str) -> None:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)


READ = "archive string, offset long, gap_bytes long, gap_reason string, record_type string, record_id string, payload_digest string, refers_to string, payload_bytes long, payload binary"


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives under path, and a row with gap_bytes and gap_reason for each quarantined run of bytes.

    A record's payload is what follows its HTTP header; a response whose payload differs from its digest is a gap.
    payload_bytes of a revisit is the length that its HTTP header names. Spark lists the archives; a task streams its own
    with pyarrow.fs, one at a time.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", archive))
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for x in salvage(Source(file)):
                        rows.append(_row(archive, x, payloads))
                        held += len(rows[-1].get("payload") or b"")
                        if len(rows) >= 500 or held > ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in READ.split(", "))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path).select("path")
    return files.mapInArrow(task, READ)


def quarantine(found: DataFrame, path: str) -> DataFrame:
    """The records of what read() found (staged). Gaps are written to the table path-quarantine, and their number is logged."""
    gaps = found.filter("gap_bytes is not null").select("archive", "offset", "gap_bytes", "gap_reason")
    gaps.write.mode("overwrite").parquet(f"{path}-quarantine")
    n, size = found.sparkSession.read.schema(gaps.schema).parquet(f"{path}-quarantine").agg(F.count("*"), F.sum("gap_bytes")).first()
    if n:
        log.warning("%d gaps of %d bytes in the archives under %s", n, size, path)
    return found.filter("gap_bytes is null").drop("gap_bytes", "gap_reason")


def _row(archive: str, x: Record | Gap, payloads: bool) -> dict:
    if isinstance(x, Gap):
        return {"archive": archive, "offset": x.offset, "gap_bytes": x.length, "gap_reason": x.reason}
    kind = x.headers.get("warc-type", "")
    http, _, payload = x.block.partition(b"\r\n\r\n") if x.headers.get("content-type", "").startswith("application/http") else (b"", b"", x.block)
    digest = x.headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    length = len(payload)
    if kind == "revisit":
        named = re.search(rb"(?mi)^content-length:\s*(\d+)", http)
        length = int(named[1]) if named else length
    elif digest and digest != sha1_base32(payload):
        return {"archive": archive, "offset": x.offset, "gap_bytes": x.length, "gap_reason": "payload digest differs"}
    return {
        "archive": archive, "offset": x.offset, "record_type": kind, "record_id": x.headers.get("warc-record-id"), "payload_digest": digest,
        "refers_to": x.headers.get("warc-refers-to"), "payload_bytes": length, "payload": payload if payloads else None,
    }


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest = [sha1_base32(x.as_buffer().to_pybytes()) for x in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(digest, pa.string()), batch.column(2)], ["uid", "payload_digest", "page_id"])


def archive(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Write one record for each page (page_id, url, html); equal payloads of `least` bytes or more are revisits of one.

    That with the largest page_id is the response. A null html is an empty payload; a page without an id is never an
    original unless no page of its group has one, and then each row of the group is a response. Rows that repeat the
    original's id are responses too. Only digests and ids are shuffled to find the originals.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"), F.monotonically_increasing_id().alias("uid"))
    rows = stage(rows, "warc-rows", "zstd")  # whole payloads: they are kept until their archives are written
    slim = stage(rows.select("uid", "payload", "page_id").mapInArrow(_digests, "uid long, payload_digest string, page_id long"), "warc-digests")
    group = slim.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    found = attach(slim, stage(group, "warc-groups"), "payload_digest", "n", slim.count()).select(
        "uid", "payload_digest",
        F.when(F.col("page_id") < F.col("original"), F.col("original")).when(F.col("page_id").isNull(), F.col("original")).alias("refers_to"),
    )
    full = rows.join(found, "uid").withColumn("refers_to", F.when(F.length("payload") >= least, F.col("refers_to")))
    return write(full, path)


def op10_salvage_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into archives and back; what can't be read is quarantined."""
    path = new_path(spark, "warc")
    archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    number = "try_cast(regexp_extract({}, '<urn:page:(-?[0-9]+)>', 1) as bigint)"
    back = quarantine(stage(read(spark, path, payloads=False).drop("payload"), "warc-found"), path)
    return back.select(
        F.expr(number.format("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr(number.format("refers_to")).alias("refers_to"),
    )


#: Base32 of the SHA-1, five hexadecimal digits (four characters) at a time.
OP10_SQL = r"""
WITH d AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
o AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS original FROM d)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(x, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM o
"""
