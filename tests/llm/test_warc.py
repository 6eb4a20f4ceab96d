import hashlib
import random
import struct

import pytest
from conftest import SF_SMALL

from panes.llm import warc
from panes.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, payload string, response string, value string"
BIG = "<html>" + "naïve content " * 200 + "</html>"


def rows():
    return [(1, "http://a/x y\r\nz", BIG), (7, "http://b", BIG), (3, None, BIG), (None, "http://c", BIG), (4, "http://d", "small"), (5, "http://e", "small"),
            (6, "http://f", None), (8, "http://g", ""), (9, "http://h", "x" * 300_000), (10, "http://i", "q" * 1000), (11, "http://j", "q" * 1000),
            (12, "http://k", "r" * 999), (13, "http://l", "r" * 999), (14, "u", "same id" * 400), (14, "u", "same id" * 400), (None, "v", "w" * 2000), (None, "v", "w" * 2000)]


def brute(pages, least=1000):
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        best = max(ids, default=None)
        revisit = len(raw) >= least and best is not None and i != best
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def archives(spark):
    path = scratch_path(spark, "archive-test")
    warc.write_archives(spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows()], SCHEMA).repartition(3), path)
    return path


def test_round_trip(spark, archives):
    back = warc.read_archives(spark, archives)
    found = [tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(found, key=repr) == brute(rows())
    payloads = {bytes(r["payload"]) for r in back.filter("record_type = 'response'").collect()}
    assert payloads == {(h or "").encode() for _, _, h in rows()}


def long_pages(n, words):
    r = random.Random(n)
    return [(i, f"http://p/{i}", "<html>" + " ".join(f"<p class='body text'>{r.randrange(5000)} naïve</p>" for _ in range(words)) + "</html>") for i in range(n)]


@pytest.mark.parametrize("pages", [long_pages(60, 1500) + [(100 + i, "u", "short") for i in range(3)], long_pages(2, 12_000)], ids=["mostly long", "few and long"])
def test_a_dictionary_is_trained_on_long_pages(spark, pages):
    assert sum(len(h.encode()) > warc.SAMPLE_BYTES for *_, h in pages) >= len(pages) - 3
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    assert struct.unpack_from("<I", warc.train(docs))[0] == 0xEC30A437
    path = scratch_path(spark, "archive-long")
    warc.write_archives(docs, path)
    back = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, path).collect()}
    assert back == {i: h for i, _, h in pages}


def test_too_little_for_a_dictionary_is_told(spark, caplog):
    docs = spark.createDataFrame([(1, "u", "one"), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")
    assert warc.train(docs) == b"" and "no dictionary" in caplog.text


def test_whole_table_round_trip(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    path = scratch_path(spark, "archive-pages")
    warc.write_archives(pages, path)
    html = {r["page_id"]: r["html"].encode() for r in pages.collect()}
    back = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(spark, path).collect() if r["record_type"] == "response"}
    assert all(html[k] == v for k, v in back.items()) and len(back) > 0
    # The dictionary stands in a leading skippable frame, and every record is a frame of its own.
    content = spark.read.format("binaryFile").load(path).orderBy("length", ascending=False).first()["content"]
    number, size = struct.unpack_from("<II", content)
    assert number == warc.DICTIONARY and size > 1000
    assert struct.unpack_from("<I", content, 8)[0] == 0xEC30A437  # a trained Zstandard dictionary
    import zstandard
    found = list(warc.records(bytes(content)))
    assert len(found) == len(html) and all(x.startswith(b"WARC/1.1\r\n") for x in found)
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(x)) for x in found)
    assert len(content) - size - 8 * (len(found) + 2) < 0.9 * plain


def test_no_pages(spark):
    path = scratch_path(spark, "archive-none")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).collect() == []


def test_a_damaged_archive_is_noticed():
    good = warc.record(1, "u", b"payload")
    assert warc.parse(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload", b"paYload"))
    with pytest.raises(ValueError):
        list(warc.records(b"not an archive"))


def test_frames_are_walked_exactly():
    import os

    import zstandard
    for data in (b"", b"a", b"x" * 70_000, os.urandom(300_000), b"ab" * 200_000 + os.urandom(1000)):
        for c in (zstandard.ZstdCompressor(), zstandard.ZstdCompressor(write_checksum=True), zstandard.ZstdCompressor(write_content_size=False)):
            frame = c.compress(data)
            assert warc.frame_end(memoryview(frame + b"tail"), 0) == len(frame)


@pytest.mark.parametrize(("archive_rows", "archive_bytes"), [(4, 1 << 20), (50, 4000), (2, 1)])
def test_archives_are_bounded_and_begin_with_their_dictionary(spark, archive_rows, archive_bytes):
    path = scratch_path(spark, "archive-bounds")
    pages = spark.createDataFrame(long_pages(40, 60) + [(100, "big", "".join(random.Random(1).choices("abcdef<>", k=60_000)))], "page_id long, url string, html string")
    warc.write_archives(pages.repartition(2), path, archive_rows=archive_rows, archive_bytes=archive_bytes)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    assert len(files) > 2
    for content in files:
        number, size = struct.unpack_from("<II", content)
        assert number == warc.DICTIONARY and size > 0
        own = list(warc.records(content))
        assert 1 <= len(own) < archive_rows
        body = len(content) - 8 - size - 16 * archive_rows
        assert body <= archive_bytes or len(own) == 1
    back = warc.read_archives(spark, path).select("page_id", "payload_digest").collect()
    assert sorted(r["page_id"] for r in back) == [*range(40), 100]
