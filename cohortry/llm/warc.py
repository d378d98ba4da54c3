"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

The writer makes one gzip member per record, so a damaged member costs only itself. The reader checks
each record (compressed member complete, version line, content length, block digest). After a failed
check it searches for the next member or version line that opens a valid record, goes on there, and
reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import local_frame, stage

from .storage import attempt_name, create, new_folder, opened, rows_in_slices, ship, spread

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
#: A file is closed and the next begun beyond this size.
ROLL_BYTES = 64 << 20
CHUNK = 1 << 18
#: A record without one of these isn't valid.
REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [*headers, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, compress: bool) -> bytes:
    if not compress:
        return data
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = base32_sha1(payload)
    name = "none" if page_id is None else str(page_id)
    # A URL with line ends or blanks would break the header line.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", target)] if target else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is None:
        return record_bytes(headers, http_head(len(payload)) + payload)
    headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return record_bytes(headers, http_head(len(payload)))


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): among equal payloads of ``least_bytes`` or more, all but the largest page_id refer to it.

    Null html is an empty payload. The largest id of each digest is aggregated before the shuffle, and the join
    back is one that adaptive execution splits where one payload is very common. Pages without an id
    refer to the largest id of their payload; without any such id they are responses. Very long html is one payload like any other; other
    columns are not read; no rows give no rows.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    largest = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("original"))
    refers = F.when(F.col("original") > F.coalesce(F.col("page_id"), F.lit(-(2**63))), F.col("original"))
    return rows.join(largest, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, least_bytes: int = 0, compress: bool = True) -> DataFrame:
    """Writes a record per page, repeated rows too; one row per file: path, n_records. No pages give no file."""
    spark = pages.sparkSession
    folder, suffix = new_folder(spark, "warc"), ".warc.gz" if compress else ".warc"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, size, count, roll = None, "", 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([[uri], [count]], ["path", "n_records"])

        for batch in rows_in_slices(batches):
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    uri, size, count = attempt_name(folder, suffix, roll), 0, 0
                    out, roll = create(uri), roll + 1
                    info = record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{uri.rpartition('/')[2]}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    size += out.write(member(info, compress))
                size += out.write(member(page_record(page_id, url, payload, refers_to), compress))
                count += 1
                if size >= ROLL_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    files = stage(with_originals(pages, least_bytes).mapInArrow(write, "path string, n_records long"))
    listed = sorted(files.collect(), key=lambda r: r.path)
    return local_frame(spark, {"path": [r.path for r in listed], "n_records": [r.n_records for r in listed]}, {"path": pa.string(), "n_records": pa.int64()})


class Bytes:
    """A file read forward in chunks, with search; only the chunks around the current place are held."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()
        self.base, self.held = 0, b""

    def at(self, start: int, count: int) -> bytes:
        end = min(start + count, self.size)
        if start < self.base or end > self.base + len(self.held):
            self.base, self.held = start, self.file.read_at(max(0, min(max(count, CHUNK), self.size - start)), start)
        return self.held[start - self.base : end - self.base]

    def find(self, what: bytes, start: int) -> int:
        """The first place of ``what`` at or behind ``start``, or the file's size."""
        while start < self.size:
            part = self.at(start, CHUNK)
            found = part.find(what)
            if found >= 0:
                return start + found
            start += max(1, len(part) - len(what) + 1)
        return self.size


class Damaged(ValueError):
    pass


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def parsed(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record that ``data`` begins with."""
    head_end = data.find(b"\r\n\r\n")
    if not re.match(rb"WARC/1\.\d\r\n", data) or head_end < 0:
        raise Damaged("no version line or headers without end")
    headers = {}
    for line in data[:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if missing := REQUIRED - headers.keys():
        raise Damaged(f"no {min(missing)}")
    if not re.fullmatch(r"[0-9]{1,15}", headers["content-length"]):
        raise Damaged("content length is no number")
    begin, length = head_end + 4, int(headers["content-length"])
    block = data[begin : begin + length]
    if len(block) < length or data[begin + length : begin + length + 4] != b"\r\n\r\n":
        raise Damaged("block cut short")
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise Damaged("block digest differs")
    return headers, block, begin + length + 4


def record_at(source: Bytes, start: int) -> Record:
    """The valid record that begins at ``start``, compressed or not."""
    if source.at(start, 3) == b"\x1f\x8b\x08":
        unpacker, parts, at = zlib.decompressobj(31), [], start
        while not unpacker.eof:
            piece = source.at(at, CHUNK)
            if not piece:
                raise Damaged("member cut short")
            try:
                parts.append(unpacker.decompress(piece))
            except zlib.error as error:
                raise Damaged(str(error)) from error
            if len(parts) == 1 and not b"WARC/1.".startswith(parts[0][:7]) and not parts[0].startswith(b"WARC/1."):
                raise Damaged("member holds no record")
            at += len(piece)
        data = b"".join(parts)
        headers, block, used = parsed(data)
        if used != len(data):
            raise Damaged("bytes behind the record")
        return Record(start, at - len(unpacker.unused_data), headers, block)
    if source.at(start, 7) != b"WARC/1.":
        raise Damaged("neither member nor version line")
    head_end = source.find(b"\r\n\r\n", start)
    length = re.search(rb"\r\ncontent-length:[ \t]*([0-9]{1,15})", source.at(start, head_end - start), re.I)
    if not length or head_end + int(length[1]) > source.size:
        raise Damaged("no content length, or block cut short")
    headers, block, used = parsed(source.at(start, head_end + 8 + int(length[1]) - start))
    return Record(start, start + used, headers, block)


def salvage(uri: str) -> Iterator[Record | tuple[int, int, str]]:
    """All valid records in order, and (start, end, reason) of each gap between them.

    A place that merely looks like the begin of a record is tried and passed over, so nothing valid
    behind it is lost.
    """
    source, at = Bytes(uri), 0
    while at < source.size:
        gap, reason = at, ""
        while True:
            try:
                record = record_at(source, at)
                break
            except Damaged as error:
                reason = reason or str(error)
            at = min(source.find(b"\x1f\x8b\x08", at + 1), source.find(b"WARC/1.", at + 1))
            if at >= source.size:
                yield gap, source.size, reason
                return
        if record.start > gap:
            yield gap, record.start, reason
        yield record
        at = record.end


READ = "path string, start long, stop long, gap string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def _row(uri: str, record: Record, payloads: bool) -> tuple:
    h = record.headers
    kind, length, payload = h.get("warc-type"), None, None
    if kind in ("response", "revisit"):
        head, _, body = record.block.partition(b"\r\n\r\n")
        if kind == "response":
            length, payload = len(body), body
        elif said := re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]+)", head):
            length = int(said[1])
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if payload is not None and digest is not None:
        digest = base32_sha1(payload)
    row = (uri, record.start, record.end, None, kind, _page(h.get("warc-record-id")), h.get("warc-target-uri"), digest, length, _page(h.get("warc-refers-to")))
    return (*row, payload if payloads else None)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record (gap null) and per gap (gap: why the check failed); ``files`` has a column path.

    The digest of a response is computed from the payload as read, that of a revisit is the stated one.
    """

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = [part.split()[0] for part in READ.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                rows, held = [], 0
                for found in salvage(uri):
                    rows.append(_row(uri, found, payloads) if isinstance(found, Record) else (uri, *found, *[None] * 7))
                    held += len(rows[-1][-1] or b"")
                    if len(rows) == 1024 or held > 1 << 24:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    ship(files.sparkSession)
    return spread(files.select("path"), files.count()).mapInArrow(read, READ)


def pages_of(read: DataFrame) -> DataFrame:
    """The page records of ``read_archives``."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.where(F.col("record_type").isin("response", "revisit")).select(*columns)
