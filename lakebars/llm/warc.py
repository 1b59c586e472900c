"""WARC archives as seekable Zstandard bundles.

A bundle holds WARC records in independent Zstandard frames. A skippable frame
maps each record identifier to its frame and its offset inside that frame's
content; a footer seek table gives the compressed and plain size of every
frame. Both are skipped by ordinary decoders, so a bundle is a valid `.warc.zst`
file, and one record is read by inflating one frame.

Of pages with equal payloads one is stored in full and the others point to it.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm.common import slices, text_of, written
from lakebars.llm.files import read_files, write_files

LEAST_SHARED = 100  # bytes a payload must have to be pointed to
FRAME_BYTES = 256 << 10  # plain size at which a frame ends; a larger record is a frame of its own
BUNDLE_BYTES = 8 << 20  # compressed size at which a bundle ends
LEVEL = 3
BATCH_PAGES = 256
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format.
INDEX_MAGIC = 0x184D2A51
SEEK_FRAME_MAGIC = 0x184D2A5E
SEEKABLE = struct.pack("<I", 0x8F92EAB1)

RECORDS = (
    "page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, "
    "uri string, payload binary, frame int, offset long"
)


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]

    def page_id(self, header: str = "WARC-Record-ID") -> str | None:
        name = self.headers.get(header)
        return None if name in (None, _name(None)) else name[len("<urn:page:") : -1]

    def http(self) -> tuple[int, bytes]:
        """Length of the page's payload, and what of it is stored here."""
        head, _, payload = self.block.partition(b"\r\n\r\n")
        return int(re.search(rb"Content-Length: (\d+)", head)[1]), payload


def _name(page_id: object) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _record(kind: str, name: str, block: bytes, **headers: str | None) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": headers.pop("date", DATE)}
    lines |= {key.replace("_", "-"): value for key, value in headers.items() if value is not None}
    lines["Content-Length"] = str(len(block))
    head = "".join(f"{key}: {value}\r\n" for key, value in lines.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: object, url: str | None, payload: bytes, digest: str, first: object, date: str) -> bytes:
    """A response, or a revisit of page `first` without the payload."""
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = {"date": date, "WARC_Target_URI": uri, "WARC_Payload_Digest": f"sha256:{digest}"}
    common["Content_Type"] = "application/http; msgtype=response"
    if first is None:
        return _record("response", _name(page_id), http + payload, **common)
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return _record("revisit", _name(page_id), http, **common, WARC_Refers_To=_name(first), WARC_Profile=profile)


class BundleWriter:
    """Records in, the bytes of a bundle out, without the last four, `SEEKABLE`."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> None:
        self.frame_bytes = frame_bytes
        self._packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self._open: list[bytes] = []
        self._plain = 0
        self.packed = 0
        self._index: list[tuple[str, int, int]] = []
        info = b"software: lakebars\r\nformat: WARC File Format 1.1\r\n"
        self.add("<urn:bundle:info>", _record("warcinfo", "<urn:bundle:info>", info, Content_Type="application/warc-fields"))

    def add(self, name: str, record: bytes) -> None:
        if self._plain and self._plain + len(record) > self.frame_bytes:
            self._end_frame()
        self._index.append((name, len(self._frames), self._plain))
        self._open.append(record)
        self._plain += len(record)

    def _end_frame(self) -> None:
        if self._plain:
            self._append(self._packer.compress(b"".join(self._open)), self._plain)
            self._open, self._plain = [], 0

    def _append(self, frame: bytes, plain: int) -> None:
        self._frames.append(frame)
        self._sizes.append((len(frame), plain))
        self.packed += len(frame)

    def finish(self) -> bytes:
        self._end_frame()
        index = self._packer.compress(json.dumps(self._index, separators=(",", ":")).encode())
        self._append(struct.pack("<II", INDEX_MAGIC, len(index)) + index, 0)
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self._sizes)
        footer = struct.pack("<IB", len(self._sizes), 0)
        head = struct.pack("<II", SEEK_FRAME_MAGIC, len(entries) + len(footer) + len(SEEKABLE))
        return b"".join(self._frames) + head + entries + footer


class Bundle:
    """Records of a bundle by identifier; reads the footer, the index and the frames asked for."""

    def __init__(self, file: BinaryIO) -> None:
        self._file = file
        file.seek(-9, io.SEEK_END)
        count, _, magic = struct.unpack("<IB4s", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        file.seek(-9 - 8 * count, io.SEEK_END)
        self.sizes = list(struct.iter_unpack("<II", file.read(8 * count)))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        file.seek(self.starts[count - 1])
        magic, size = struct.unpack("<II", file.read(8))
        if magic != INDEX_MAGIC:
            raise ValueError("no index of records")
        self.index = [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(file.read(size)))]

    def frame(self, number: int) -> bytes:
        self._file.seek(self.starts[number])
        packed, plain = self.sizes[number]
        content = zstandard.ZstdDecompressor().decompress(self._file.read(packed))
        if len(content) != plain:
            raise ValueError(f"frame {number} has {len(content)} bytes, the seek table says {plain}")
        return content

    @staticmethod
    def record(content: bytes, offset: int) -> Record:
        end = content.index(b"\r\n\r\n", offset)
        version, *lines = content[offset:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("no record at this offset")
        headers = dict(line.split(": ", 1) for line in lines)
        return Record(headers, content[end + 4 : end + 4 + int(headers["Content-Length"])])

    def find(self, name: str) -> list[Record]:
        """All records of this identifier."""
        return [self.record(self.frame(frame), offset) for known, frame, offset in self.index if known == name]

    def records(self) -> Iterator[tuple[int, int, Record]]:
        """Frame, offset and record, one frame in memory at a time."""
        number, content = -1, b""
        for _, frame, offset in self.index:
            if frame != number:
                number, content = frame, self.frame(frame)
            yield frame, offset, self.record(content, offset)


def write_archive(
    pages: DataFrame, path: str, date: str = DATE, least: int = LEAST_SHARED, bundle_bytes: int = BUNDLE_BYTES
) -> None:
    """Write a record for each row of `pages` (`page_id, url, html`) in bundles below `path`.

    The payload is the html in UTF-8, null as empty. Of pages with equal
    payloads of at least `least` bytes, found by length and SHA-256, the one
    with the smallest id is a response and those with larger ids revisit it; a
    null id comes after all others. Rows that repeat an id share its record
    name and are found together. A null url gives a record without a target.
    Other columns take no part; no rows, no bundles.
    """
    html = text_of("html")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    same = rows.filter(F.octet_length("html") >= least).groupBy("digest")
    firsts = same.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    rows = rows.join(written(firsts.drop("n"), "first-pages"), "digest", "left")
    rows = rows.withColumn("first", F.when(F.coalesce(F.col("page_id") > F.col("first"), F.col("page_id").isNull()), F.col("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, empty = BundleWriter(), True
        for batch in slices(batches, BATCH_PAGES):
            for page_id, url, text, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bundle.add(_name(page_id), page_record(page_id, url, text.encode(), digest, first, date))
                empty = False
                if bundle.packed >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["bundle"])
                    bundle, empty = BundleWriter(), True
        if not empty:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["bundle"])

    bundles = rows.select("page_id", "url", "html", "digest", "first").mapInArrow(run, "bundle binary")
    write_files(bundles, "bundle", path, SEEKABLE)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the bundles below `path`; see `RECORDS`.

    `payload` is null for a revisit; its length and digest are those of the
    page it points to. A payload that does not match its digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows: list[tuple] = []
            held = 0
            for frame, offset, record in Bundle(io.BytesIO(batch.column(0)[0].as_py())).records():
                if record.kind == "warcinfo":
                    continue
                length, payload = record.http()
                digest = record.headers["WARC-Payload-Digest"].removeprefix("sha256:")
                if record.kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"payload of {record.headers['WARC-Record-ID']} does not match its digest")
                refers = record.page_id("WARC-Refers-To")
                stored = payload if record.kind == "response" else None
                uri = record.headers.get("WARC-Target-URI")
                rows.append((record.page_id(), record.kind, length, digest, refers, uri, stored, frame, offset))
                held += len(payload)
                if held >= BUNDLE_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return read_files(spark, path).select("content").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    types = [text, text, number, text, text, text, pa.binary(), pa.int32(), number]
    names = [field.split()[0] for field in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
