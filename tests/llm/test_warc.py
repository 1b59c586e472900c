from __future__ import annotations

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from lakebars.llm.files import read_files
from lakebars.llm.warc import SEEKABLE, Bundle, BundleWriter, page_record, read_archive, write_archive
from lakebars.operators.scratch import scratch_path

BIG = "<html>" + "same page " * 30 + "</html>"
PAGES = [
    (1, "http://a.example/ä b\r\nX: y", "<p>one</p>", "x"),
    (2, None, None, "x"),
    (3, "http://c.example/", "", "x"),
    (4, "http://d.example/", BIG, "x"),
    (5, "http://e.example/", BIG, "x"),
    (5, "http://f.example/", BIG, "x"),
    (None, "http://g.example/", BIG, "x"),
    (None, None, "漢字" * 100, "x"),
    (6, "http://h.example/", "s" * 99, "x"),
    (7, "http://i.example/", "s" * 99, "x"),
    (8, "http://j.example/", "é" * 50, "x"),
    (9, "http://k.example/", "é" * 50, "x"),
    (10, "http://l.example/", "\r\n\r\nContent-Length: 5\r\n\r\nWARC/1.1\r\n" * 20, "x"),
    (11, "http://m.example/", "long " * 400_000, "x"),
]


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "test-warc")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string")
    write_archive(pages.repartition(3), path, bundle_bytes=20_000)
    return path


def brute():
    firsts = {}
    for page_id, _, html, _ in PAGES:
        if html and len(html.encode()) >= 100 and page_id is not None:
            firsts[html] = min(page_id, firsts.get(html, page_id))
    found = []
    for page_id, _, html, _ in PAGES:
        payload = (html or "").encode()
        first = firsts.get(html) if len(payload) >= 100 else None
        again = first is not None and (page_id is None or page_id > first)
        found.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(found, key=repr)


def test_records_read_back(spark, archive):
    rows = read_archive(spark, archive)
    names = [F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")]
    assert sorted((tuple(r) for r in rows.select(*names).collect()), key=repr) == brute()
    stored = [bytes(r.payload).decode() for r in rows.filter("record_type = 'response'").collect()]
    again = [r[0] for r in brute() if r[3] == "revisit"]
    assert len(stored) + len(again) == len(PAGES) and set(stored) == {p[2] or "" for p in PAGES}


def test_bundles_are_plain_zstandard_and_seekable(spark, archive):
    for row in read_files(spark, archive).collect():
        content = bytes(row.content)
        assert content.endswith(SEEKABLE)
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
        assert plain.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        bundle = Bundle(io.BytesIO(content))
        assert sum(size for _, size in bundle.sizes) == len(plain)
        for name, frame, offset in bundle.index:
            assert bundle.record(bundle.frame(frame), offset).headers["WARC-Record-ID"] == name


def test_one_record_is_read_from_one_frame():
    writer = BundleWriter(frame_bytes=500)
    for page_id in range(50):
        payload = f"page {page_id} ".encode() * 20
        writer.add(f"<urn:page:{page_id}>", page_record(page_id, None, payload, "d", None, "2024-01-01T00:00:00Z"))
    bundle = Bundle(io.BytesIO(writer.finish() + SEEKABLE))
    assert len(bundle.sizes) > 20
    (record,) = bundle.find("<urn:page:37>")
    assert record.http() == (160, b"page 37 " * 20)
    assert bundle.find("<urn:page:99>") == []


def test_damage_is_an_error():
    writer = BundleWriter()
    writer.add("<urn:page:1>", page_record(1, None, b"x" * 500, "d", None, "2024-01-01T00:00:00Z"))
    content = writer.finish() + SEEKABLE
    with pytest.raises(ValueError):
        Bundle(io.BytesIO(content[:-1]))


def test_no_rows(spark):
    path = scratch_path(spark, "test-warc")
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archive(spark, path).count() == 0
