"""WARC archives with a two-level capture index.

Each task writes one archive, a gzip member per record. Captures are sorted by their
reversed-host URL key into compressed blocks, a file of blocks per range of keys; a
sparse directory beside each file holds the first key and place of every block. A
lookup searches the ranges and then a directory by bisection, reads the block it
finds by its byte range, and then the records by theirs.

Files are reached through ``pyarrow.fs`` by the URI of the archive folder, so that
folder may be on any store it knows. Names are new for each task attempt and become
known only through the committed output of Spark tasks: an attempt that is lost
leaves a file that nothing refers to.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.common import join_groups, small_side
from lexispark.llm.text import slices
from lexispark.scale import materialize, shared_path

BLOCK_LINES = 1000  # captures per index block
RANGE_CAPTURES = 1_000_000  # captures per range of the index
READ_BYTES = 1 << 20  # neighboring records are read together up to this
CHUNK_BYTES = 32 << 20  # of an archive, read by one task
DATE = "2000-01-01T00:00:00Z"  # pages carry no time of capture
# Fixed value: the profile of a revisit of an equal payload, by the format's standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("6f1d1f0c-5f0e-4b1e-9d55-3c6b8f1c2a77")


def _clean(value: str | None) -> str:
    """A header value: control characters are escaped as in URLs."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels in reverse order, then port, path and query.
    Scheme, user, default port, a leading www label and fragment do not count; what
    is no URL is its own key."""
    text = _clean(url).strip()
    try:
        parts = urlsplit(text if "//" in text else "//" + text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text
    if not host:
        return text
    labels = host.rstrip(".").split(".")
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    where = ",".join(reversed(labels))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        where += f":{port}"
    return f"{where}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, str(page_id))}>"


def make_record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """A response, or a revisit of page ``refers_to``, whose payload is left out but
    told by its digest and length."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(url),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to),
                    "X-Refers-To-Page-ID": str(refers_to)}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers and payload of one record; raises ValueError where they disagree."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record of another length")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    length, digest = int(told["Content-Length"]), headers["WARC-Payload-Digest"][5:]
    if headers["WARC-Type"] == "response" and (
            len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("a payload of another digest")
    number = {k: int(headers[k]) if headers.get(k) else None
              for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
    return {"page_id": number["X-Page-ID"], "url": headers.get("WARC-Target-URI"),
            "payload_bytes": length, "payload_digest": digest,
            "record_type": headers["WARC-Type"], "refers_to": number["X-Refers-To-Page-ID"],
            "payload": payload if headers["WARC-Type"] == "response" else None}


def _open(folder: str):
    store, path = fs.FileSystem.from_uri(folder)
    return store, path.rstrip("/")


@lru_cache(maxsize=64)
def _file(folder: str, name: str):
    store, path = _open(folder)
    return store.open_input_file(f"{path}/{name}")


def read_range(folder: str, name: str, offset: int, length: int) -> bytes:
    data = _file(folder, name).read_at(length, offset)
    if len(data) != length:
        raise OSError(f"{name} ends before byte {offset + length}")
    return data


@dataclass(frozen=True)
class Archive:
    """A folder of archives and their index: ``ranges`` are (first key, last key, name),
    in order of keys, one for each ``RANGE_CAPTURES`` captures."""

    folder: str
    ranges: tuple[tuple[str, str, str], ...]


def _decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, html, first): ``first`` is the page that holds an equal payload
    if that is another one. Only digests are grouped; pages are joined with the
    revisits among them."""
    digests = materialize(pages.select(
        "page_id", F.concat_ws(":", F.sha1("html"), F.octet_length("html")).alias("digest"),
        F.octet_length("html").alias("size")), "warc-digests")
    groups = materialize(
        digests.where(F.col("size") >= least_bytes).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1"),
        "warc-groups")
    revisits = join_groups(
        digests.select("page_id", "digest"), groups, "digest", "pages",
        F.coalesce(F.col("page_id").cast("string"), F.lit("none"))).where("first < page_id")
    revisits = materialize(revisits.select(
        F.col("page_id").alias("__id"), "first").distinct(), "warc-revisits")
    return pages.join(small_side(revisits), F.col("page_id") == F.col("__id"), "left").select(
        "page_id", "url", "html", "first")


def write_archive(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id",
                  url: str = "url", html: str = "html", label: str = "warc",
                  block_lines: int = BLOCK_LINES) -> Archive:
    """Write a record per row of ``pages`` below the shared folder, and the index.

    The payload is the html in UTF-8, a null one is empty. Of pages with equal
    payloads (by SHA-1 and length) of at least ``least_bytes`` bytes, the one with the
    smallest id is a response and the others revisit it. Rows that share an id are
    each written; a null id is written without one and is always a response. A null
    url is empty. A page of any length is one record, held by one task at a time. Other
    columns are ignored.
    """
    folder = shared_path(pages.sparkSession, label)
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    source = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(html, F.lit("")).alias("html"))
    captures = materialize(_decided(source, least_bytes).mapInArrow(
        _archive_writer(folder),
        "key string, page_id bigint, file string, offset bigint, length bigint"),
        f"{label}-captures")
    cores = pages.sparkSession.sparkContext.defaultParallelism
    ranges = max(cores, captures.count() // RANGE_CAPTURES)
    order = ("key", "page_id", "file", "offset")  # so that one key may span ranges
    sorted_captures = captures.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    index = materialize(sorted_captures.mapInArrow(
        _index_writer(folder, block_lines), "first string, last string, name string"),
        f"{label}-ranges")
    return Archive(folder, tuple(sorted(map(tuple, index.collect()))))


def _archive_writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        name, at, out = f"pages-{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in slices(batches, "html"):
                rows = []
                for page_id, url, html, first in zip(
                        *(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    record = gzip.compress(
                        make_record(page_id, url, html.encode(), first), 6, mtime=0)
                    out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(record)
                    rows.append((url_key(url), page_id, name, at, len(record)))
                    at += len(record)
                yield _batch(rows, ("key", "page_id", "file", "offset", "length"),
                             (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))
        finally:
            if out:
                out.close()

    return run


def _batch(rows, names, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


def _index_writer(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        name = f"index-{uuid.uuid4().hex}"
        directory, at, lines, last = [], 0, [], ""
        out = None

        def flush():
            nonlocal at, lines, out
            block = gzip.compress("".join(json.dumps(x) + "\n" for x in lines).encode(), 6, mtime=0)
            out = out or store.open_output_stream(f"{path}/{name}.blocks", compression=None)
            out.write(block)
            directory.append((lines[0][0], at, len(block)))
            at, lines = at + len(block), []

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                lines.append(row)
                last = row[0]
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out:
            out.close()
            with store.open_output_stream(f"{path}/{name}.directory", compression=None) as file:
                file.write(gzip.compress(json.dumps(directory).encode(), 6, mtime=0))
            yield _batch([(directory[0][0], last, name)], ("first", "last", "name"),
                         (pa.string(),) * 3)

    return run


@lru_cache(maxsize=64)
def _directory(folder: str, name: str) -> list[tuple[str, int, int]]:
    store, path = _open(folder)
    with store.open_input_stream(f"{path}/{name}.directory", compression=None) as file:
        return [tuple(x) for x in json.loads(gzip.decompress(file.read()))]


def blocks_of(archive: Archive, key: str) -> Iterator[tuple[str, int, int]]:
    """(index file, offset, length) of the blocks that may hold ``key``. A key that
    fills several blocks may start in the one before the first that begins with it."""
    firsts = [r[0] for r in archive.ranges]
    for i in range(max(0, bisect.bisect_left(firsts, key) - 1), len(firsts)):
        first, last, name = archive.ranges[i]
        if first > key:
            break
        if last < key:
            continue
        directory = _directory(archive.folder, name)
        at = max(0, bisect.bisect_left(directory, (key,)) - 1)
        while at < len(directory) and directory[at][0] <= key:
            yield name, *directory[at][1:]
            at += 1


def lookup(spark: SparkSession, archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """All captures of the URLs: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and payload (null for revisits), a row per record.

    URLs with equal keys are asked once; unknown ones give no row. Each block and
    record is read by one task only, so a URL with very many captures is spread over
    the tasks of its blocks.
    """
    keys = urls.select(F.col(url).alias("url")).distinct().mapInArrow(_keys, "key string")
    found = keys.distinct().mapInArrow(
        _found(archive), "key string, name string, offset bigint, length bigint")
    blocks = found.groupBy("name", "offset", "length").agg(F.collect_set("key").alias("keys"))
    places = materialize(blocks.mapInArrow(
        _block_reader(archive.folder), "file string, offset bigint, length bigint"),
        "warc-places")
    # A number of partitions by the bytes to be read: adaptive execution sees only the
    # few bytes of the places and would join them all.
    total = places.agg(F.sum("length")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    places = places.repartition(
        max(cores, total // CHUNK_BYTES + 1), F.col("file"), F.expr(f"offset div {CHUNK_BYTES}"))
    return places.sortWithinPartitions("file", "offset").mapInArrow(
        _record_reader(archive.folder),
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array(map(url_key, batch.column(0).to_pylist()), pa.string())], ["key"])


def _found(archive: Archive):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, *block) for key in batch.column(0).to_pylist()
                    for block in blocks_of(archive, key)]
            yield _batch(rows, ("key", "name", "offset", "length"),
                         (pa.string(), pa.string(), pa.int64(), pa.int64()))

    return run


def _block_reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, offset, length, keys in zip(
                    *(batch.column(i).to_pylist() for i in range(4)), strict=True):
                wanted = set(keys)
                block = gzip.decompress(read_range(folder, f"{name}.blocks", offset, length))
                for line in block.decode().splitlines():
                    key, _, file, at, size = json.loads(line)
                    if key in wanted:
                        rows.append((file, at, size))
            yield _batch(rows, ("file", "offset", "length"),
                         (pa.string(), pa.int64(), pa.int64()))

    return run


_RECORD = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
           "payload")
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())


def _record_reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            at = 0
            while at < len(places):
                file, begin, size = places[at]
                end, stop = begin + size, at + 1
                while (stop < len(places) and places[stop][:2] == (file, end)
                       and end - begin < READ_BYTES):
                    end += places[stop][2]
                    stop += 1
                data = read_range(folder, file, begin, end - begin)
                records = [parse_record(gzip.decompress(data[o - begin:o - begin + n]))
                           for _, o, n in places[at:stop]]
                yield _batch([tuple(r[c] for c in _RECORD) for r in records], _RECORD, _KINDS)
                at = stop

    return run
