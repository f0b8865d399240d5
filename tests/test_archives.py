import io
import zipfile

import pytest

from lexispark.sources import archives
from lexispark.sources.archives import ByteRange, plan_splits, read_archives
from lexispark.sources.articles import documents, extract_articles, parse_article, quarantined


def article(item, title="T", headline="H", text="<p>Body</p>", date="2020-01-02"):
    return (f'<newsitem itemid="{item}" date="{date}"><title>{title}</title>'
            f"<headline>{headline}</headline><text>\n{text}\n</text></newsitem>").encode()


def zipped(entries, method=zipfile.ZIP_DEFLATED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def streamed(entries):
    """An archive whose entry headers do not hold sizes, as written to a pipe."""

    class Pipe(io.RawIOBase):
        def __init__(self):
            self.data = b""

        def writable(self):
            return True

        def write(self, chunk):
            self.data += bytes(chunk)
            return len(chunk)

    pipe = Pipe()
    with zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return pipe.data


ENTRIES = {f"{i}.xml": article(i) * (1 + i % 3) for i in range(40)}


def names(frame):
    return sorted(r.name for r in frame.where("_error is null").collect())


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped(ENTRIES))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.zip").write_bytes(
        zipped({"dir/": b"", "dir/x.xml": b"x", "empty.xml": b""}, zipfile.ZIP_STORED))
    (tmp_path / "_hidden.zip").write_bytes(b"junk")
    return tmp_path


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_every_entry_once(spark, folder, split):
    """Large archives are shared by tasks, directories are not entries."""
    frame = read_archives(spark, str(folder), "FAILFAST", split)
    assert names(frame) == sorted([*ENTRIES, "dir/x.xml", "empty.xml"])
    contents = {r.name: bytes(r.content) for r in frame.collect()}
    assert all(contents[name] == content for name, content in ENTRIES.items())
    if split == 64:
        assert frame.rdd.getNumPartitions() > 10


def test_single_file_and_uri(spark, folder):
    for path in (f"{folder}/a.zip", f"file:{folder}/a.zip", f"file://{folder}/a.zip"):
        assert names(read_archives(spark, path)) == sorted(ENTRIES)


def test_plan_splits():
    splits = plan_splits([("a", 250), ("b", 40), ("c", 50), ("d", 30), ("e", 0)], 100)
    assert [s.ranges for s in splits] == [
        (ByteRange("a", 0, 100),), (ByteRange("a", 100, 200),), (ByteRange("a", 200, 250),),
        (ByteRange("b", 0, 40), ByteRange("c", 0, 50)),
        (ByteRange("d", 0, 30), ByteRange("e", 0, 1))]


@pytest.mark.parametrize("make", [zipped, streamed,
                                  lambda e: zipped(e, zipfile.ZIP_STORED)])
def test_truncated_archive(spark, tmp_path, make):
    """Entries before the damage are kept, once, however the file is split."""
    whole = make(ENTRIES)
    with zipfile.ZipFile(io.BytesIO(whole)) as archive:
        cut = archive.infolist()[25].header_offset + 60
    (tmp_path / "a.zip").write_bytes(whole[:cut])
    want = sorted(list(ENTRIES)[:25])
    for split in (100, 1 << 20):
        assert names(read_archives(spark, str(tmp_path), "DROPMALFORMED", split)) == want
        permissive = read_archives(spark, str(tmp_path), "PERMISSIVE", split)
        assert names(permissive) == want
        assert permissive.where("_error is not null").count() == 1
        with pytest.raises(Exception, match="DamagedArchive"):
            read_archives(spark, str(tmp_path), "FAILFAST", split).collect()


def test_archive_without_its_directory_is_whole(spark, tmp_path):
    whole = zipped(ENTRIES)
    with zipfile.ZipFile(io.BytesIO(whole)) as archive:
        start = archive.start_dir
    (tmp_path / "a.zip").write_bytes(whole[: start + 10])
    assert names(read_archives(spark, str(tmp_path), "DROPMALFORMED")) == sorted(ENTRIES)


def test_damaged_entry_and_foreign_file(spark, tmp_path):
    whole = bytearray(zipped(ENTRIES))
    with zipfile.ZipFile(io.BytesIO(whole)) as archive:
        at = archive.infolist()[3].header_offset + 50
    whole[at] ^= 0xFF
    (tmp_path / "a.zip").write_bytes(bytes(whole))
    (tmp_path / "note.txt").write_bytes(b"not an archive")
    rows = read_archives(spark, str(tmp_path)).collect()
    bad = {r.name for r in rows if r._error}
    assert bad == {"3.xml", None}
    assert len(rows) == len(ENTRIES) + 1
    with pytest.raises(Exception, match="DamagedArchive"):
        read_archives(spark, str(tmp_path), "FAILFAST").collect()


def test_bad_options(spark, folder):
    with pytest.raises(Exception, match="mode must be"):
        read_archives(spark, str(folder), "LOOSE").collect()
    with pytest.raises(Exception, match="nowhere"):
        read_archives(spark, f"{folder}/nowhere").collect()


def test_parse_article():
    nested = (b'<r itemid="5" date="d"><a><title> one <b>two</b><!-- no --> three</title></a>'
              b"<title>second</title><text>x &amp; y<title>inner</title></text></r>")
    assert parse_article(nested) == ("5", "d", " one two three", "", "x & yinner", None)
    latin = '<?xml version="1.0" encoding="ISO-8859-1"?><r itemid="6"><text>é</text></r>'
    assert parse_article(latin.encode("latin-1"))[4] == "é"
    external = (b'<!DOCTYPE r [<!ENTITY e SYSTEM "file:///etc/hostname">]>'
                b'<r itemid="7"><text>[&e;]</text></r>')
    assert parse_article(external)[4] == "[]"
    for bad in (b"", None, b"<a><b></a>", b"<a/>junk", b"<a>&foo;</a>", b"<a/><b/>", b"<a>\x01</a>",
                b'<?xml version="1.0" encoding="no-such"?><a/>'):
        assert parse_article(bad)[5].startswith("malformed XML"), bad


def test_articles_and_quarantine(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({
        "1.xml": article(1, " Red fox ", "seen", "<p>A red fox.</p>\n<p>It ran.</p>"),
        "2.xml": article(2, date="soon"),
        "3.xml": article("three"),
        "4.xml": b"<newsitem",
        "5.xml": b'<newsitem itemid=" 5 "><text>only</text></newsitem>',
        "6.xml": b"<newsitem><text>no id</text></newsitem>",
    }))
    articles = extract_articles(read_archives(spark, str(tmp_path)))
    sound = {r.doc_id: (r.content, str(r.doc_date), r.raw_date) for r in
             documents(articles).collect()}
    assert sound == {
        1: ("Red fox seen A red fox.\nIt ran.", "2020-01-02", "2020-01-02"),
        2: ("T H Body", "None", "soon"),
        5: ("  only", "None", None)}
    assert {r.name for r in quarantined(articles).collect()} == {"3.xml", "4.xml", "6.xml"}
    plan = documents(articles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


class _Forward(io.RawIOBase):
    """A stream that can only be written front to back."""

    def __init__(self):
        super().__init__()
        self.parts = []

    def writable(self):
        return True

    def write(self, data):
        self.parts.append(bytes(data))
        return len(data)


@pytest.mark.parametrize("streamed", [True, False])
@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_large_format_entries_without_directory(streamed, method):
    if streamed and method == zipfile.ZIP_STORED:
        pytest.skip("a streamed stored entry does not say how long it is")
    target = _Forward() if streamed else io.BytesIO()
    with zipfile.ZipFile(target, "w", method) as archive:
        for i in range(3):
            info = zipfile.ZipInfo(f"{i}.xml")
            info.compress_type = method
            with archive.open(info, "w", force_zip64=True) as entry:
                entry.write(b"text %d " % i * 50)
    content = b"".join(target.parts) if streamed else target.getvalue()
    content = content[: content.index(b"PK\x01\x02")]
    found = archives.entries_from_front(io.BytesIO(content))
    got = []
    with pytest.raises(archives.DamagedArchive, match="archive ends|not a zip entry"):
        for name, text in found:
            got.append((name, text))
    assert got == [(f"{i}.xml", b"text %d " % i * 50) for i in range(3)]


@pytest.mark.parametrize("charset", ["gbk", "shift_jis", "big5", "utf-16", "windows-1252", "utf-8"])
def test_declared_charsets(charset):
    word = "caf\xe9" if charset == "windows-1252" else "\u4e2d\u6587"
    xml = f'<?xml version="1.0" encoding="{charset}"?><n itemid="7"><title>{word}</title></n>'
    item, _, title, *_, error = parse_article(xml.encode(charset))
    assert (item, title, error) == ("7", word, None)


def test_undecodable_charsets_are_told():
    for content in (b'<?xml version="1.0" encoding="gbk"?><n>\xff\xff</n>',
                    b'<?xml version="1.0" encoding="nonsense"?><n/>'):
        assert "malformed XML" in parse_article(content)[-1]
