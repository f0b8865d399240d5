"""Archives and their capture index."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from lexispark.llm import warc

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", "<p>é", "x\r\n\r\ny", "z" * 200_000]
    out = [(i, f"http://www.a{i % 7}.x.org/p{i % 3}" if i % 5 else None,
            texts[i % 5] if i % 2 else str(i)) for i in range(200)]
    out += [(999 + i, "http://hot.example.com/", "same") for i in range(100)]
    return [*out, (5000, "http://bad host\r\nX: y/", "odd")]


def expected(rows, least):
    first = {}
    for i, _, h in sorted(rows):
        first.setdefault(h or "", i)
    out = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = first[h or ""] != i and len(raw) >= least
        out[i] = (len(raw), digest, "revisit" if revisit else "response",
                  first[h or ""] if revisit else None)
    return out


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, rows, least):
    pages = spark.createDataFrame(rows, PAGES).repartition(5).withColumns(
        {c: F.lit(1) for c in ("key", "digest", "first", "file", "pages", "size")})
    archive = warc.write_archive(pages, least, block_lines=7)
    assert len(archive.ranges) > 1
    got = warc.lookup(spark, archive, pages).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
            for r in got} == expected(rows, least)
    assert len(got) == len(rows)
    html = {i: h or "" for i, _, h in rows}
    for r in got:
        assert r.payload is None or bytes(r.payload).decode() == html[r.page_id]
    asked = spark.createDataFrame([("https://HOT.example.com/#x",), ("http://none/",)], "url string")
    assert warc.lookup(spark, archive, asked).count() == 100


def test_several_tasks_read(spark, rows):
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    got = warc.lookup(spark, warc.write_archive(pages), pages)
    tasks = got.select(F.spark_partition_id().alias("task"), "page_id").collect()
    assert len({r.task for r in tasks}) > 1 and len(tasks) == len(rows)


def test_null_and_repeated_ids(spark):
    pages = spark.createDataFrame(
        [(None, "u", "a"), (1, "u", "a"), (1, "u", "a"), (None, None, "b")], PAGES)
    got = warc.lookup(spark, warc.write_archive(pages), pages).collect()
    assert sorted((str(r.page_id), r.record_type) for r in got) == [
        ("1", "response"), ("1", "response"), ("None", "response"), ("None", "response")]
    empty = warc.write_archive(pages.limit(0))
    assert warc.lookup(spark, empty, pages).count() == 0


def test_damage_is_an_error(spark, rows):
    record = warc.make_record(1, "http://a/", b"payload")
    assert warc.parse_record(record)["payload"] == b"payload"
    for broken in (record[:-1], record.replace(b"payload", b"Payload"), b"x" + record):
        with pytest.raises(ValueError):
            warc.parse_record(broken)


@pytest.mark.parametrize("url, key", [
    ("http://www.Example.com:80/a?b=1#c", "com,example)/a?b=1"),
    ("https://user@m.example.com:8443", "com,example,m:8443)/"),
    ("http://example.com", "com,example)/"), ("example.com/x", "com,example)/x"),
    (None, ""), ("", ""), ("http://[bad", "http://[bad"), ("http://a/\n", "a)/%0A")])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_bisection_finds_every_block(monkeypatch):
    directory = {"x": [("a", 0, 1), ("c", 1, 1), ("c", 2, 1), ("e", 3, 1)],
                 "y": [("e", 0, 1), ("g", 1, 1)]}
    monkeypatch.setattr(warc, "_directory", lambda folder, name: directory[name])
    archive = warc.Archive("", (("a", "e", "x"), ("e", "h", "y")))
    found = {k: [(n, o) for n, o, _ in warc.blocks_of(archive, k)] for k in "abcdefhz"}
    assert found["a"] == [("x", 0)] and found["b"] == [("x", 0)]
    assert found["c"] == [("x", 0), ("x", 1), ("x", 2)] and found["d"] == [("x", 2)]
    assert found["e"] == [("x", 2), ("x", 3), ("y", 0)]
    assert found["f"] == [("y", 0)] and found["h"] == [("y", 1)] and found["z"] == []
