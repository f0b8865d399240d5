"""Archives by a manifest of their entries."""

import os
import random
import zipfile

import pytest

from lexispark.sources.archive_manifest import (directory_rows, read_manifest,
                                                read_manifest_entries)
from lexispark.sources.archives import read_archives


@pytest.fixture
def folder(tmp_path):
    """Archives in two levels of folders, stored and deflated, one empty, and one cut off."""
    rng = random.Random(4)
    for name in ("a.zip", "b/c.zip", "b/d/e.zip", "_hidden.zip"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(path, "w") as archive:
            archive.mkdir("folder")
            for i in range(40):
                archive.writestr(
                    f"folder/{name[0]}{i}.xml", rng.randbytes(rng.randrange(3000)) * (i % 3),
                    zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    whole = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(whole[: len(whole) // 2])
    return tmp_path


def rows(frame):
    return sorted((os.path.basename(r.archive), str(r.name), bytes(r.content or b""), r._error is None)
                  for r in frame.collect())


def test_equal_to_the_source(spark, folder):
    path = f"file://{folder}"
    manifest = read_manifest(spark, path)
    for split in (1 << 30, 5000):
        got = read_manifest_entries(manifest, split_bytes=split)
        assert rows(got) == rows(read_archives(spark, path))
    assert read_manifest_entries(manifest, split_bytes=5000).rdd.getNumPartitions() > 5
    kept = rows(read_manifest_entries(manifest, "DROPMALFORMED"))
    assert kept == rows(read_archives(spark, path, "DROPMALFORMED")) and all(r[3] for r in kept)
    with pytest.raises(Exception, match="cut.zip"):
        read_manifest_entries(manifest, "FAILFAST").collect()


def test_directories_are_not_read_again(spark, folder):
    """Entries are found after the directories have been cut away."""
    for name in ("cut.zip", "empty.zip"):
        (folder / name).unlink()
    path = f"file://{folder}"
    want = rows(read_archives(spark, path))
    manifest = read_manifest(spark, path)
    for name in ("a.zip", "b/c.zip", "b/d/e.zip"):
        with zipfile.ZipFile(folder / name) as archive:
            start = archive.start_dir
        os.truncate(folder / name, start)
    assert rows(read_manifest_entries(manifest, "FAILFAST", 5000)) == want


def test_damaged_entries(spark, folder):
    for name in ("cut.zip", "empty.zip"):
        (folder / name).unlink()
    path = folder / "a.zip"
    with zipfile.ZipFile(path) as archive:
        broken = max(archive.infolist(), key=lambda e: e.file_size)
    data = bytearray(path.read_bytes())
    at = broken.header_offset + 30 + len(broken.filename) + broken.compress_size // 2
    data[at] ^= 0xFF
    path.write_bytes(data)
    got = rows(read_manifest_entries(read_manifest(spark, f"file://{folder}")))
    assert [r[1] for r in got if not r[3]] == [broken.filename]


def test_no_archives(spark, tmp_path):
    assert read_manifest_entries(read_manifest(spark, f"file://{tmp_path}")).count() == 0
    (tmp_path / "no.zip").write_bytes(b"not a zip")
    assert [r[-1] is None for r in directory_rows(f"file://{tmp_path}/no.zip")] == [False]
