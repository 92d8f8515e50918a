"""WARC archives: a writer that stores equal payloads once, and a reader that survives damage.

Writing.  Every page becomes a record, a gzip member of its own.  Of pages with equal payloads of at least
``REVISIT_BYTES`` the one with the smallest id is a response, the others are revisits that refer to it.

Reading.  A record is checked: the member's checksum, the version line, the header lines, the length, the end mark
and the digests it states.  After a failed check the reader looks for the next place that passes, a gzip member that
unpacks or a version line with a valid record, goes on there and reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import materialize, ship_package, slices
from recordweave.llm.files import listed, make_folder, partition_number, write_file
from recordweave.operators.lookup import broadcast_if_small

#: Shortest payload that is stored once.
REVISIT_BYTES = 100
#: A file is closed when it holds so many bytes.
FILE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
RECORD_NAME = "urn:recordweave:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
#: Header lines that every record has.
_REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
_READ = 1 << 16


def record(kind: str, name: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; a revisit has the header lines of its response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record for each row of ``pages`` into ``folder``; the files written, with records and bytes.

    Null html is an empty payload, a null url is left out.  Rows with one id and payload are all responses, as none has a
    smaller id.  Among rows with a null id and a known payload, all refer to the smallest id there is; without any
    they are responses.  An empty table writes no file; other columns are not read.
    """
    spark = pages.sparkSession
    ship_package(spark)
    make_folder(folder)
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    thin = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
    copies = thin.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
    copies = materialize(copies.where("times > 1 AND first IS NOT NULL").select("digest", "first"), "payload-copies")
    marked = rows.join(broadcast_if_small(copies), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("first") < F.col("page_id")), F.col("first")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size, count, files = partition_number(), [], 0, 0, 0
        done = []

        def close() -> None:
            nonlocal held, size, count, files
            name, written = write_file(folder, f"part-{part:05d}-{files:04d}", ".warc.gz", held)
            done.append((name, count, written))
            held, size, count, files = [], 0, 0, files + 1

        for batch in slices(batches, "payload"):
            for page, url, body, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kind = "response" if first is None else "revisit"
                held.append(_member(record(kind, f"{RECORD_NAME}{page}", url, body, digest, f"{RECORD_NAME}{first}")))
                size += len(held[-1])
                count += 1
                if size >= FILE_BYTES:
                    close()
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["file", "records", "bytes"])

    return materialize(marked.mapInArrow(run, "file string, records bigint, bytes bigint"), "warc-files")


@dataclass
class Found:
    """A record (``reason`` empty) or a gap, with its bytes in the file from ``start`` to ``end``."""

    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    reason: str = ""


def _digest_fits(stated: str, data: bytes) -> bool:
    name, _, value = stated.partition(":")
    if name.lower() not in ("sha1", "sha256", "md5"):
        return True  # a digest that can't be checked
    made = hashlib.new(name.lower(), data)
    return value.lower() == made.hexdigest() or value.upper().rstrip("=") == base64.b32encode(made.digest()).decode().rstrip("=")


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the header lines of an HTTP message."""
    if headers.get("content-type", "").startswith("application/http"):
        _, mark, body = block.partition(b"\r\n\r\n")
        return body if mark else block
    return block


def _record_at(data: bytes, at: int) -> tuple[Found | None, str]:
    """The record that begins here, or why there is none."""
    version = _VERSION.match(data, at)
    if not version:
        return None, "no version line"
    end = data.find(b"\r\n\r\n", version.end() - 2)
    if end < 0:
        return None, "header without end"
    headers: dict[str, str] = {}
    for line in data[version.end() : end].split(b"\r\n") if end > version.end() else []:
        name, mark, value = line.partition(b":")
        if not mark:
            return None, "header line without colon"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not _REQUIRED <= headers.keys():
        return None, "a required header line is missing"
    length = headers["content-length"]
    if not length.isdecimal():
        return None, "no length"
    first, last = end + 4, end + 4 + int(length)
    if last > len(data):
        return None, "block is cut"
    if data[last : last + 4] != b"\r\n\r\n":
        return None, "no end mark"
    block = data[first:last]
    if not _digest_fits(headers.get("warc-block-digest", ""), block):
        return None, "block digest differs"
    if headers.get("warc-type") != "revisit" and not _digest_fits(headers.get("warc-payload-digest", ""), payload_of(headers, block)):
        return None, "payload digest differs"
    return Found(at, last + 4, headers, block), ""


def _unpack(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """What the gzip member here holds, where it ends or fails, and whether it is whole.

    Of a stride that fails, what comes before the fault is read in smaller and smaller steps.
    """
    stream, out, place, step = zlib.decompressobj(31), [], at, _READ
    while place < len(data):
        before = stream.copy()
        try:
            out.append(stream.decompress(data[place : place + step]))
        except zlib.error:
            stream = before
            if step > 1:
                step = 256 if step > 256 else 1
                continue
            out.append(_last_bytes(stream, data[place : place + 1]))
            return b"".join(out), place, False
        place = min(place + step, len(data))
        if stream.eof:
            return b"".join(out), place - len(stream.unused_data), True
    return b"".join(out), len(data), False


def _last_bytes(stream, raw: bytes) -> bytes:
    """What a stream still gives for bytes at which it fails."""
    out = []
    try:
        while made := stream.decompress(raw, 1):
            out.append(made)
            raw = stream.unconsumed_tail
    except zlib.error:
        pass
    return b"".join(out)


def _plain(data: bytes, at: int, stop: int | None = None) -> Iterator[Found]:
    """Records and gaps of bytes that are not packed."""
    stop = len(data) if stop is None else stop
    while at < stop:
        found, reason = _record_at(data, at)
        if found:
            yield found
            at = found.end
            continue
        place = at + 1
        while True:
            later = _VERSION.search(data, place)
            if not later or later.start() >= stop:
                yield Found(at, stop, reason=reason)
                return
            if _record_at(data, later.start())[0]:
                yield Found(at, later.start(), reason=reason)
                at = later.start()
                break
            place = later.start() + 1


def salvage(data: bytes) -> Iterator[Found]:
    """All records of a file that pass their checks, and the gaps between them, in the order of their bytes.

    Records of a packed member have the member's bytes as their place.  A member that breaks off still
    gives the records before the break.
    """
    at = 0
    while at < len(data):
        known, broken = [], at
        if data.startswith(_MEMBER, at):
            raw, end, whole = _unpack(data, at)
            if whole:
                for found in _plain(raw, 0):
                    yield replace(found, start=at, end=end)
                at = end
                continue
            known, broken = [found for found in _plain(raw, 0) if not found.reason], end
            for found in known:
                yield replace(found, start=at, end=at)
            reason = "member is damaged"
        elif data.startswith(b"WARC/", at):
            found, reason = _record_at(data, at)
            if found:
                yield found
                at = found.end
                continue
        else:
            reason = "no member or version line"
        follow = _next_valid(data, at + 1, known, broken)
        yield Found(at, follow, reason=reason)
        at = follow


def _next_valid(data: bytes, at: int, known: list[Found], broken: int) -> int:
    """The next place where a member unpacks or gives a record, or a record passes its checks; the end of the data if there is none.

    Before ``broken``, the place where a member has failed, its ``known`` records may stand in plain; they are not found again.
    """
    given = {(tuple(sorted(f.headers.items())), f.block) for f in known}
    member, version = data.find(_MEMBER, at), _VERSION.search(data, at)
    while member >= 0 or version:
        if member >= 0 and (not version or member < version.start()):
            raw, _, whole = _unpack(data, member)
            if whole or any(not f.reason for f in _plain(raw, 0)):
                return member
            member = data.find(_MEMBER, member + 1)
        else:
            found = _record_at(data, version.start())[0]
            if found and not (found.start < broken and (tuple(sorted(found.headers.items())), found.block) in given):
                return version.start()
            version = _VERSION.search(data, version.start() + 1)
    return len(data)


_SCHEMA = (
    "file string, start bigint, end bigint, reason string, warc_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def _row(path: str, found: Found) -> tuple:
    if found.reason:
        return path, found.start, found.end, found.reason, None, None, None, None, None, None, None
    h = found.headers
    body = payload_of(h, found.block)
    kind = h.get("warc-type")
    if kind == "revisit":  # the digest and length of the payload it stands for
        stated = re.search(rb"(?i)content-length: *(\d+)", found.block)
        digest = h.get("warc-payload-digest", "").partition(":")[2].lower() or None
        size, body = int(stated[1]) if stated else None, None
    else:
        digest, size = hashlib.sha256(body).hexdigest(), len(body)
    return path, found.start, found.end, None, kind, h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), digest, size, body


def read_warc(spark: SparkSession, folder: str, pattern: str = "*.warc*", files: DataFrame | None = None) -> DataFrame:
    """A row for every record and every gap in the files of ``folder`` (packed or plain).

    A gap has a ``reason`` and no record columns; ``start`` and ``end`` are bytes of the file.  A
    record has no reason; ``payload`` is null for revisits, whose digest and length are those stated.  An empty file gives no rows.
    Each file is read by one task, as one value of Spark's binary file source.  ``files`` is what ``write_warc`` returned: other files
    in the folder, such as those of a task that was run again, are left out.
    """
    ship_package(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    found = found if files is None else listed(found, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
        names = [part.split()[0] for part in _SCHEMA.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for i in range(len(batch)):
                path, data, rows, held = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), [], 0
                for one in salvage(data):
                    rows.append(_row(path, one))
                    held += len(rows[-1][-1] or b"")
                    if held > 4 << 20 or len(rows) >= 4096:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    return found.mapInArrow(run, _SCHEMA)
