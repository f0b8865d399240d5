"""A manifest of zip archives: one row per entry, read from each directory once.

The ``zip_entries`` source lets every byte range of an archive read the archive's
directory to find its entries. For archives of a terabyte a directory is large and
ranges are many. Here one job lists folders and reads directories, an archive at a time, and
writes where each entry lies. Entries are then sorted by archive and place and dealt out
by bytes; a task reads its entries at their places and never looks at a directory.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.scale import materialize
from lexispark.sources.archives import (
    BATCH_BYTES,
    DEFAULT_SPLIT_BYTES,
    DEFLATED,
    ENCRYPTED,
    LOCAL_HEADER,
    LOCAL_SIGNATURE,
    MODES,
    SCHEMA,
    STORED,
    ByteRange,
    DamagedArchive,
    as_uri,
    read_range,
)

MANIFEST = ("archive string, name string, offset bigint, packed bigint, size bigint, "
            "method int, flags int, crc bigint, _error string")
_NAMES = [column.split()[0] for column in MANIFEST.split(", ")]
_TYPES = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
          pa.int64(), pa.string())
MANIFEST_ROWS = 10_000  # rows of a batch


def _found(path: str, recursive: bool) -> list[tuple[str, bool]]:
    """``(path, is_file)`` of what is below a folder, or of a file; no hidden ones."""
    system, root = fs.FileSystem.from_uri(path)
    scheme = path[: path.index(root)] if "://" in path else ""
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    inside = [info] if info.is_file else system.get_file_info(
        fs.FileSelector(root, recursive=recursive))
    return sorted((scheme + f.path, f.is_file) for f in inside
                  if not f.base_name.startswith(("_", ".")))


def archive_paths(spark: SparkSession, path: str) -> DataFrame:
    """``(archive)``: files below ``path``. The driver lists its first level, tasks list the
    folders in it."""
    top = _found(as_uri(path), recursive=False)
    if not top:
        return spark.createDataFrame([], "archive string")
    slots = min(len(top), 4 * spark.sparkContext.defaultParallelism)
    frame = spark.createDataFrame(top, "path string, is_file boolean").repartition(
        slots, F.xxhash64("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for one, is_file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                paths += [one] if is_file else [
                    p for p, file in _found(one, recursive=True) if file]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["archive"])

    return frame.mapInArrow(run, "archive string")


def directory_rows(path: str) -> Iterator[tuple]:
    """The entries of one archive by its directory; one row with ``_error`` and no name if
    it has none that can be read."""
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as file:
        try:
            with zipfile.ZipFile(file) as archive:
                for e in archive.infolist():
                    if not e.is_dir():
                        yield (path, e.filename, e.header_offset, e.compress_size, e.file_size,
                               e.compress_type, e.flag_bits, e.CRC, None)
        except (zipfile.BadZipFile, EOFError, OSError, ValueError) as error:
            yield (path, None, 0, file.size(), 0, 0, 0, 0, str(error) or type(error).__name__)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A written table of the entries of all archives below ``path``."""
    archives = archive_paths(spark, path)
    slots = 4 * spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = []
                for row in directory_rows(archive):
                    rows.append(row)
                    if len(rows) == MANIFEST_ROWS:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    dealt = archives.repartition(slots, "archive")
    return materialize(dealt.mapInArrow(run, MANIFEST), "archive-manifest")


def read_entry(file, offset: int, packed: int, size: int, method: int, flags: int,
               crc: int) -> bytes:
    """One entry at its place; the local header only says how long itself is."""
    file.seek(offset)
    header = file.read(LOCAL_HEADER.size)
    if len(header) < LOCAL_HEADER.size or header[:4] != LOCAL_SIGNATURE:
        raise DamagedArchive("not a zip entry header")
    names = LOCAL_HEADER.unpack(header)[-2:]
    if flags & ENCRYPTED or method not in (STORED, DEFLATED):
        raise DamagedArchive("unsupported entry")
    file.seek(offset + LOCAL_HEADER.size + sum(names))
    content = file.read(packed)
    if len(content) < packed:
        raise DamagedArchive("archive ends early")
    if method == DEFLATED:
        content = zlib.decompressobj(-zlib.MAX_WBITS).decompress(content)
    if len(content) != size or zlib.crc32(content) != crc:
        raise DamagedArchive("entry fails its checksum")
    return content


def read_manifest_entries(manifest: DataFrame, mode: str = "PERMISSIVE",
                          split_bytes: int = DEFAULT_SPLIT_BYTES) -> DataFrame:
    """``(archive, name, content, _error)`` of the entries of a manifest, as
    ``archives.read_archives`` gives them. Work is dealt out by packed bytes; an archive
    without a directory is read from its front by one task."""
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    total = manifest.agg(F.sum("packed")).first()[0] or 0
    splits = total // split_bytes + 1
    chunk = F.shiftright("offset", max(split_bytes.bit_length() - 3, 0))
    dealt = manifest.repartition(splits, "archive", chunk).sortWithinPartitions(
        "archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        opened: list = [None, None]  # rows come archive by archive
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for found in entries(row, opened):
                    out.append(found)
                    held += len(found[2] or b"")
                    if held >= BATCH_BYTES:
                        yield rows(out)
                        out, held = [], 0
        yield rows(out)

    def entries(row, opened):
        archive, name, offset, packed, size, method, flags, crc, error = row
        if error is not None:
            yield from read_range(ByteRange(archive, 0, packed + 1), mode)
            return
        try:
            if opened[0] != archive:
                if opened[1] is not None:
                    opened[1].close()
                system, inner = fs.FileSystem.from_uri(archive)
                opened[:] = archive, system.open_input_file(inner)
            content = read_entry(opened[1], offset, packed, size, method, flags, crc)
        except (DamagedArchive, zlib.error, struct.error, OSError) as broken:
            if mode == "FAILFAST":
                raise DamagedArchive(f"{archive}: {name}: {broken}") from broken
            if mode == "PERMISSIVE":
                yield archive, name, None, str(broken) or type(broken).__name__
        else:
            yield archive, name, content, None

    def rows(found):
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)],
            ["archive", "name", "content", "_error"])

    return dealt.mapInArrow(run, SCHEMA)
