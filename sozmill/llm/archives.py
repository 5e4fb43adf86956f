"""Legacy ARC archives to WARC: written, parsed and read back by Spark tasks.

A record is a row; Spark's text sink writes rows with their line separator, which
makes the files byte-exact archives, gzipped as a whole. ARC files are parsed by
the header line of their version and the declared lengths, and WARC headers
are made from that: identifiers, timestamps, types and digests. A file is read in
one task, as sequential formats must be, and holds what one task wrote.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, lean, shared_folder

# Header fields of the two ARC versions, and WARC names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_FIELDS = (
    "file string, offset long, url string, ip string, date string, content_type string, "
    "http binary, payload binary, page_id long, digest string, truncated boolean")
CHUNK = 1 << 20
_MISSING = "-"
# The text sink: its rows are the records, their last line feed is its separator.
_SINK = {"lineSep": "\n", "compression": "gzip"}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Reader:
    """Sequential reads from a file's bytes, unpacked on the way if gzipped, member by member."""

    def __init__(self, content: bytes):
        self.rest = memoryview(content)
        self.gzip = bytes(self.rest[:2]) == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31) if self.gzip else None
        self.buffer, self.at, self.offset = bytearray(), 0, 0

    def _more(self) -> bool:
        if not len(self.rest):
            return False
        if self.at > CHUNK:
            del self.buffer[: self.at]
            self.at = 0
        part, self.rest = self.rest[:CHUNK], self.rest[CHUNK:]
        if self.gzip:
            data = self.unpack.decompress(part)
            while self.unpack.eof and (left := self.unpack.unused_data or b""):
                self.unpack = zlib.decompressobj(31)
                data += self.unpack.decompress(left)
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            self.buffer += data
        else:
            self.buffer += part
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        start = 0
        while (end := self.buffer.find(b"\n", self.at + start)) < 0:
            start = len(self.buffer) - self.at
            if not self._more():
                if self.at == len(self.buffer):
                    return None
                end = len(self.buffer)
                break
            start = max(0, min(start, len(self.buffer) - self.at))
        out = bytes(self.buffer[self.at:end])
        self.offset += end + 1 - self.at
        self.at = min(end + 1, len(self.buffer))
        return out

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer at the end of the file."""
        while len(self.buffer) - self.at < n and self._more():
            pass
        out = bytes(self.buffer[self.at:self.at + n])
        self.at += len(out)
        self.offset += len(out)
        return out


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    content: bytes
    truncated: bool


def arc_records(content: bytes, name: str = "") -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block, by that block's version.

    A record cut off by the end of the file comes as truncated. A header line
    of another shape is an error that tells the file and the offset.
    """
    reader, names = Reader(content), None
    while (line := reader.line()) is not None:
        if not line.strip():
            continue
        offset = reader.offset - len(line) - 1
        parts = line.decode("utf-8", "replace").rstrip("\r").split(" ")
        want = ARC_FIELDS[1].split() if names is None else names
        if len(parts) != len(want) or not parts[-1].isdigit():
            raise ValueError(f"{name}: no ARC header at {offset}: {line[:80]!r}")
        length = int(parts[-1])
        body = reader.take(length)
        if names is None:
            if not parts[0].startswith("filedesc:"):
                raise ValueError(f"{name}: no version block")
            version = int(body.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: ARC version {version}")
            names = ARC_FIELDS[version].split()
            continue
        yield ArcRecord(offset, dict(zip(names, parts)), body, len(body) < length)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """An HTTP response's header, its empty line included, and its payload; no header if it is none."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = re.search(rb"\r?\n\r?\n", content)
    return (content[: end.end()], content[end.end():]) if end else (content, b"")


def http_field(header: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)[ \t]*\r?$", header)
    return found.group(1).decode("utf-8", "replace") if found and found.group(1) else None


def write_arc(pages: DataFrame, path: str, id: str, url: str, html: str, date: str = "20240101000000") -> None:
    """Pages as ARC files, versions 1 and 2 in turn by file; null html is an empty payload."""
    def run(batches):
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        version = 1 + number % 2
        block = f"{version} 0 sozmill\n{ARC_FIELDS[version]}\n"
        first = [f"filedesc://part-{number:05d}.arc 0.0.0.0 {date} text/plain {len(block)}\n{block}".encode()]
        for batch in batches:
            for page, at, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      as_bytes(batch.column(2))):
                body = body.as_py()
                http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}"
                        f"\r\nX-Page-Id: {'' if page is None else page}\r\n\r\n").encode()
                address = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", at or "") or f"urn:page:{page}"
                length = len(http) + len(body)
                more = "" if version == 1 else f"200 {base32_sha1(body)} {_MISSING} 0 part-{number:05d}.arc "
                line = f"{address} 127.0.0.1 {date} text/html {more}{length}\n".encode()
                first.append(line + http + body)
            yield _lines(first)
            first = []

    lines = pages.select(F.col(id).cast("long"), F.col(url).cast("string"), html).mapInArrow(lean(run), "value string")
    lines.write.option("zlib.compress.level", "BEST_SPEED").text(path, **_SINK)


def read_arc(spark, path: str) -> DataFrame:
    """Records of ARC files, parsed, with the digest of the payload: the fields of ``RECORD_FIELDS``."""
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for record in arc_records(content.as_py(), name):
                    http, payload = split_http(record.content)
                    page = http_field(http, "X-Page-Id")
                    rows.append((
                        name, record.offset, record.fields["URL"], record.fields["IP-address"],
                        record.fields["Archive-date"], record.fields["Content-type"], http, payload,
                        int(page) if page else None, base32_sha1(payload), record.truncated))
                    size += len(payload)
                    if size > CHUNK:
                        yield _batch(rows, _RECORD)
                        rows, size = [], 0
                yield _batch(rows, _RECORD)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(lean(run), RECORD_FIELDS)


_RECORD = [("file", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("ip", pa.string()),
           ("date", pa.string()), ("content_type", pa.string()), ("http", pa.binary()), ("payload", pa.binary()),
           ("page_id", pa.int64()), ("digest", pa.string()), ("truncated", pa.bool_())]


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], [n for n, _ in fields])


def _lines(records: list[bytes]) -> pa.RecordBatch:
    """Rows for the text sink, which writes their bytes as they are, UTF-8 or not."""
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).cast(pa.string(), safe=False)], ["value"])


def with_originals(records: DataFrame, least: int = 0) -> DataFrame:
    """``records`` with ``original``: of those of equal payload the one that is kept whole.

    It has the largest page id, then the last place. Smaller payloads than
    ``least`` bytes are each their own. Payloads meet their digest's original in
    a join, so one that many pages share can be split over tasks.
    """
    place = F.struct("page_id", "url", "date", "file", "offset")
    originals = records.filter(F.length("payload") >= least).groupBy("digest").agg(F.max(place).alias("original"))
    joined = records.join(originals, "digest", "left")
    return joined.withColumn("original", F.when(F.length("payload") >= least, F.col("original")).otherwise(place))


def record_id(url: str, date: str, file: str, offset: int) -> str:
    """The same identifier for the same ARC record, whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {file} {offset}')}>"


def warc_date(date: str) -> str:
    digits = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)):])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its last line feed, which the text sink adds."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r"


def to_warc(row: dict) -> bytes:
    """The WARC record of an ARC record that knows its original."""
    original = row["original"]
    whole = (original["file"], original["offset"]) == (row["file"], row["offset"])
    kind = ("response" if row["http"] else "resource") if whole else "revisit"
    http = row["http"] or b""
    block = http + (row["payload"] if whole else b"")
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(row["url"], row["date"], row["file"], row["offset"])),
        ("WARC-Date", warc_date(row["date"])), ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response" if http else row["content_type"]),
    ]
    if row["truncated"]:
        headers.append(("WARC-Truncated", "length"))
    if not whole:
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(*(original[k] for k in ("url", "date", "file", "offset")))),
            ("WARC-Refers-To-Target-URI", original["url"]), ("WARC-Refers-To-Date", warc_date(original["date"])),
        ]
        if original["page_id"] is not None:
            headers.append(("X-Refers-To-Page-Id", str(original["page_id"])))
    return warc_record(headers, block)


def convert(records: DataFrame, path: str, least: int = 0) -> None:
    """ARC records (``read_arc``) as WARC files: responses, and revisits of equal payloads."""
    def run(batches):
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")]
        first = [warc_record(info, b"software: sozmill\r\nformat: WARC File Format 1.0\r\n")]
        for batch in batches:
            for row in batch.to_pylist():
                first.append(to_warc(row))
            yield _lines(first)
            first = []

    with_originals(records, least).mapInArrow(lean(run), "value string").write.text(
        path, **_SINK)


def warc_records(content: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with lower-case names, and block of each record of a WARC file."""
    reader = Reader(content)
    while (line := reader.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at {reader.offset}: {line[:80]!r}")
        headers = {}
        while (line := reader.line()) is not None and line.strip():
            key, _, value = line.decode().partition(":")
            headers[key.strip().lower()] = value.strip()
        yield headers, reader.take(int(headers["content-length"]))


_READ = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
         ("target_uri", pa.string()), ("date", pa.string())]


def read_warc(spark, path: str) -> DataFrame:
    """Records of WARC files but for warcinfo; length and digest are those of the full payload.

    A response's digest is taken from its payload as read; a revisit has it, and
    the length, in its headers.
    """
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for headers, block in warc_records(content.as_py(), name):
                    kind = headers["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http, payload = split_http(block)
                    page, target = http_field(http, "X-Page-Id"), headers.get("x-refers-to-page-id")
                    if kind == "revisit":
                        length, digest = int(http_field(http, "Content-Length") or 0), headers["warc-payload-digest"]
                    else:
                        length, digest = len(payload), base32_sha1(payload)
                    rows.append((
                        int(page) if page else None, length, digest.removeprefix("sha1:"), kind,
                        int(target) if target else None, headers["warc-record-id"], headers["warc-target-uri"],
                        headers["warc-date"]))
                yield _batch(rows, _READ)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        lean(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "record_id string, target_uri string, date string")


def archived(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages through ARC files, the converter and WARC files, and what is read back from those.

    Null html is an empty payload, a null url becomes a urn, white space in a url
    is escaped; a null id stays null and never wins over another. Repeated rows
    become a response and revisits of it. An empty table gives no records.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark)
    write_arc(pages, f"{folder}/arc", id, url, html)
    convert(read_arc(spark, f"{folder}/arc"), f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc")
