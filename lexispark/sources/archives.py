"""Zip archives of small files as a Spark data source.

``spark.read.format("zip_entries").load(folder)`` gives one row per archived
file. The work is planned by bytes, not by archive: an archive larger than
``splitBytes`` is read by several tasks, each taking the entries that start in
its byte range, and small archives share a task. One archive holding a third
of all input is therefore no longer than any other split.

Options:

``mode``        what to do with a damaged archive or entry: ``FAILFAST`` raises,
                ``DROPMALFORMED`` keeps what can be read, ``PERMISSIVE`` (the
                default) also adds a row with ``_error`` set and no content
``splitBytes``  bytes of archive per task, 128 MiB by default

An archive without a readable directory at its end, such as a truncated one,
is read from the front instead: entries before the damage are kept.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_entries"
MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")
SCHEMA = "archive string, name string, content binary, _error string"
DEFAULT_SPLIT_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
READ_BYTES = 1 << 20

# Fixed values of the zip format: the signature and layout of a local file
# header, its directory flag bits and compression methods.
LOCAL_HEADER = struct.Struct("<4sHHHHHIIIHH")
LARGE_SIZES = 1  # the extra field of entries that may exceed 4 GB
LOCAL_SIGNATURE = b"PK\x03\x04"
ENCRYPTED, SIZES_FOLLOW, UTF8_NAME = 0x1, 0x8, 0x800
STORED, DEFLATED = 0, 8

_ARROW_SCHEMA = pa.schema(
    [("archive", pa.string()), ("name", pa.string()), ("content", pa.binary()),
     ("_error", pa.string())]
)


class DamagedArchive(ValueError):
    """An archive, or the rest of one, cannot be read."""


@dataclass(frozen=True)
class ByteRange:
    path: str
    start: int
    end: int


@dataclass
class ArchiveSplit(InputPartition):
    ranges: tuple[ByteRange, ...]


def plan_splits(files: list[tuple[str, int]], split_bytes: int) -> list[ArchiveSplit]:
    """Cut large archives into byte ranges and pack small ones together."""
    splits: list[ArchiveSplit] = []
    packed: list[ByteRange] = []
    filled = 0
    for path, size in files:
        if size > split_bytes:
            for start in range(0, size, split_bytes):
                end = min(start + split_bytes, size)
                splits.append(ArchiveSplit((ByteRange(path, start, end),)))
            continue
        if packed and filled + size > split_bytes:
            splits.append(ArchiveSplit(tuple(packed)))
            packed, filled = [], 0
        packed.append(ByteRange(path, 0, max(size, 1)))
        filled += size
    if packed:
        splits.append(ArchiveSplit(tuple(packed)))
    return splits


def as_uri(path: str) -> str:
    """``path`` as Arrow reads it: Hadoop also writes ``file:/folder``."""
    return "file://" + path[5:] if path.startswith("file:/") and "://" not in path else path


def list_files(path: str) -> list[tuple[str, int]]:
    """``(path, size)`` of a file, or of the files below a folder; hidden ones
    are left out."""
    system, root = fs.FileSystem.from_uri(path)
    # The file system lists paths without the scheme that finds it again.
    scheme = path[: path.index(root)] if "://" in path else ""
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted(
        (scheme + f.path, f.size) for f in found
        if f.is_file and not f.base_name.startswith(("_", "."))
    )


def entries_from_front(stream) -> Iterator[tuple[str, bytes]]:
    """``(name, content)`` of the entries of an archive read front to back.

    Needs no directory. Raises DamagedArchive at the first thing that is not
    an entry, unless it is the directory that ends the archive.
    """
    pending = b""

    def take(n: int) -> bytes:
        nonlocal pending
        while len(pending) < n:
            more = stream.read(max(READ_BYTES, n - len(pending)))
            if not more:
                raise DamagedArchive("archive ends early")
            pending += more
        taken, pending = pending[:n], pending[n:]
        return taken

    while True:
        if len(pending) < 4:
            pending += stream.read(READ_BYTES)
        if pending[:4] != LOCAL_SIGNATURE:
            if pending[:2] == b"PK":
                return
            raise DamagedArchive("not a zip entry header")
        (_, _, flags, method, _, _, crc, packed_size, _, name_length,
         extra_length) = LOCAL_HEADER.unpack(take(LOCAL_HEADER.size))
        name = take(name_length).decode("utf-8" if flags & UTF8_NAME else "cp437")
        large = large_sizes(take(extra_length))
        if large and packed_size == 0xFFFFFFFF:
            packed_size = large[-1]
        if flags & ENCRYPTED or method not in (STORED, DEFLATED):
            raise DamagedArchive(f"unsupported entry {name}")
        if method == STORED:
            if flags & SIZES_FOLLOW:
                raise DamagedArchive(f"entry {name} does not say how long it is")
            content = take(packed_size)
        else:
            inflate = zlib.decompressobj(-zlib.MAX_WBITS)
            parts = []
            try:
                while not inflate.eof:
                    if not pending:
                        pending = stream.read(READ_BYTES)
                        if not pending:
                            raise DamagedArchive("archive ends early")
                    parts.append(inflate.decompress(pending))
                    pending = inflate.unused_data
            except zlib.error as error:
                raise DamagedArchive(f"entry {name}: {error}") from error
            content = b"".join(parts)
        if flags & SIZES_FOLLOW:
            # A data descriptor: optional signature, then checksum and sizes.
            head = take(4)
            crc = struct.unpack("<I", take(4) if head == b"PK\x07\x08" else head)[0]
            take(16 if large else 8)
        if zlib.crc32(content) != crc:
            raise DamagedArchive(f"entry {name} fails its checksum")
        if not name.endswith("/"):
            yield name, content


def large_sizes(extra: bytes) -> tuple[int, ...]:
    """The 64-bit sizes in an entry's extra field, the packed one last; none if the
    entry has no such field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == LARGE_SIZES:
            return struct.unpack_from(f"<{length // 8}Q", extra, at + 4)
        at += 4 + length
    return ()


def read_range(part: ByteRange, mode: str) -> Iterator[tuple]:
    """Rows of the entries that start in one byte range of an archive."""

    def damaged(name: str | None, error: Exception):
        if mode == "FAILFAST":
            raise DamagedArchive(f"{part.path}: {error}") from error
        if mode == "PERMISSIVE":
            yield part.path, name, None, str(error) or type(error).__name__

    system, path = fs.FileSystem.from_uri(part.path)
    with system.open_input_file(path) as file:
        try:
            archive = zipfile.ZipFile(file)
        except (zipfile.BadZipFile, EOFError, OSError, ValueError) as error:
            if mode == "FAILFAST":
                raise DamagedArchive(f"{part.path}: {error}") from error
            if part.start > 0:
                return
            file.seek(0)
            try:
                for name, content in entries_from_front(file):
                    yield part.path, name, content, None
            except (DamagedArchive, UnicodeDecodeError, struct.error) as broken:
                yield from damaged(None, broken)
            return
        with archive:
            for entry in archive.infolist():
                if entry.is_dir() or not part.start <= entry.header_offset < part.end:
                    continue
                try:
                    content = archive.read(entry)
                except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError,
                        NotImplementedError) as error:
                    yield from damaged(entry.filename, error)
                else:
                    yield part.path, entry.filename, content, None


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.path = as_uri(options.get("path") or "")
        self.mode = options.get("mode", "PERMISSIVE").upper()
        self.split_bytes = int(options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        if not self.path:
            raise ValueError("zip_entries needs a path")
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {self.mode!r}")
        if self.split_bytes <= 0:
            raise ValueError("splitBytes must be positive")

    def partitions(self):
        return plan_splits(list_files(self.path), self.split_bytes) or [ArchiveSplit(())]

    def read(self, partition):
        rows: list[tuple] = []
        size = 0
        for part in partition.ranges:
            for row in read_range(part, self.mode):
                rows.append(row)
                size += len(row[2] or b"")
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, field.type)
               for column, field in zip(zip(*rows), _ARROW_SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_SCHEMA)


class ArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_archives(
    spark: SparkSession,
    path: str,
    mode: str = "PERMISSIVE",
    split_bytes: int = DEFAULT_SPLIT_BYTES,
):
    """``(archive, name, content, _error)`` of the files in zip archives."""
    spark.dataSource.register(ArchiveSource)
    return (
        spark.read.format(FORMAT)
        .option("mode", mode)
        .option("splitBytes", split_bytes)
        .load(path)
    )
