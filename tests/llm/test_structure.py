"""The prefix trie, suffix arrays and periodic runs against plain versions."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import periodic_runs, prefix_trie, suffix_array

DOCS = "doc_id bigint, text string"
TURNS = "conv_id bigint, turn int, role string, text string"


def docs_of(spark, rows):
    extra = ("anchor", "start", "windows", "version", "key", "runs", "spans", "firsts", "low")
    return spark.createDataFrame(rows, DOCS).select("*", *[F.lit(1).alias(n) for n in extra])


# --- prefix trie


def trie_rows(frame):
    return sorted(tuple(r[c] for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")) for r in frame.collect())


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(3)
    rows = []
    for c in [*range(60), 100, 103, 104, 2**41, 2**41 + 3, -3, -10]:
        for t in range(rng.choice((0, 1, 2, 3, 7, 12, 30))):
            role = ("user", "assistant", None)[t % 3 if rng.random() < 0.1 else t % 2]
            rows.append((c, None if t == 0 and c % 7 == 0 else t, role,
                         rng.choice(("yes", "no", "", None, "größe" * 30, f"only {c} {t}"))))
    rows += [(None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


def test_trie(spark, chats):
    table = spark.createDataFrame(chats, TURNS).select(
        "*", *[F.lit(1).alias(n) for n in ("base", "depth", "k1", "f1", "own", "n")])
    assert trie_rows(prefix_trie.prefix_trie(table)) == brute.prefix_trie(chats)
    assert trie_rows(prefix_trie.prefix_trie(table, 3, 4)) == brute.prefix_trie(chats, 3, 4)
    assert prefix_trie.prefix_trie(table.limit(0)).count() == 0


def test_trie_of_copies_and_long_conversations(spark):
    """One conversation in many copies, and one longer than any batch."""
    rows = [(c, t, "user", f"t{t}") for c in range(0, 20000, 5) for t in range(3)]
    rows += [(7, t, "user", f"t{t % 50}") for t in range(25_000)]
    got = trie_rows(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)))
    want = brute.prefix_trie([r for r in rows if r[0] != 7 or r[1] < 200])
    h = zlib.crc32(b"7") % 9
    assert len(got) == 1 + min(3, h) + 25_000 - h
    assert {r[:5] for r in want if r[1] < 190} <= {r[:5] for r in got}
    assert [r[3:7] for r in got if r[1] == 0] == [(4001, 1, 1, 4000 * 6)]


def test_trie_of_split_conversations(spark, chats, monkeypatch):
    """Conversations cut over many tasks give the same trie, whatever chunks hold."""
    table = spark.createDataFrame(chats, TURNS)
    monkeypatch.setattr(prefix_trie, "LONG_TURNS", 5)
    for size in ("2", "11", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert trie_rows(prefix_trie.prefix_trie(table)) == brute.prefix_trie(chats)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_trie_takes_another_seed(spark, chats, monkeypatch):
    """Keys and fingerprints that collide are noticed."""
    table = spark.createDataFrame(chats, TURNS)
    turns, seeds = prefix_trie._turns, []

    def poor(conversations, seed):
        seeds.append(seed)
        frame = turns(conversations, seed)
        return frame if seed else frame.withColumns({"k1": F.col("k1") % 3, "k2": F.lit(1)})

    monkeypatch.setattr(prefix_trie, "_turns", poor)
    assert trie_rows(prefix_trie.prefix_trie(table)) == brute.prefix_trie(chats)
    assert seeds == [0, 1]


def test_products_compose():
    rng = np.random.default_rng(1)
    a, b = prefix_trie.maps(rng.integers(0, 1 << 63, 50, dtype=np.uint64))
    every = prefix_trie.Products(a, b)
    x, y = every.run(3, np.array([20])), every.run(20, np.array([41]))
    whole = every.run(3, np.array([41]))
    assert whole == (x[0] * y[0], x[1] * y[0] + y[1])
    assert prefix_trie.Products(a[3:41], b[3:41]).run(0, np.array([38])) == whole


# --- suffix arrays


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh"])
def test_previous_factors(letters):
    rng = random.Random(4)
    for window in (1, 2, 5, 8, 13, 20):
        text = bytes(rng.choice(letters) for _ in range(rng.randrange(20, 250)))
        text += text[: len(text) // 2]
        data = np.frombuffer(text, np.uint8)
        starts = np.arange(len(data) - window + 1)
        starts = starts[rng.randrange(2)::1 + rng.randrange(2)]
        suffixes = suffix_array.Suffixes(data, starts, window)
        cut = [text[s:s + window] for s in starts]
        assert [cut[i] for i in suffixes.order] == sorted(cut)

        def shared(a, b):
            return next((k for k in range(window) if cut[a][k] != cut[b][k]), window)

        n = range(len(starts))
        for places, others in ((starts, lambda i: range(i)), (-starts, lambda i: n[i + 1:])):
            want = [max((shared(i, j) for j in others(i)), default=0) for i in n]
            assert suffix_array.previous_factors(suffixes, places).tolist() == want
            assert suffix_array.reaching(suffixes, places).tolist() == [x == window for x in want]


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(8)

    def text(n, letters="abcdefghij "):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [text(rng.randrange(20, 90)) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "ä" * 200), (4, "ä" * 90), (5, "x" * 39), (6, "x" * 40)]
    for i in range(10, 60):
        parts = [text(rng.randrange(60)), rng.choice(shared), text(30), rng.choice(shared)]
        rows.append((i, "".join(parts[: rng.randrange(1, 5)])))
    rows += [(i, rows[20][1]) for i in range(70, 80)]
    rows.append((90, "".join(text(50) + shared[0][:45] for _ in range(40))))
    return rows


@pytest.mark.parametrize("options", [
    {}, {"anchor_pieces": 3, "piece_windows": 2}, {"shard_bytes": 500, "piece_windows": 7}])
def test_repeated_bytes(spark, passages, options):
    for first_stays in (True, False):
        got = suffix_array.without_repeats(
            docs_of(spark, passages), 40, first_stays, anchor=8, **options).collect()
        want = brute.without_repeated_bytes(passages, 40, first_stays)
        assert {r.doc_id: (r.n_spans, bytes(r.kept)) for r in got} == want
        assert all(r.n_bytes - r.n_removed == len(r.kept) for r in got)
        assert sum(r.n_removed for r in got) > 500


def test_repeated_rows_and_ids(spark):
    rows = [(1, "abcdefgh" * 3), (1, "abcdefgh" * 3), (None, "hgfedcbaXYZ"), (None, "zgfedcbaXY"),
            (2, "12345678")]
    got = suffix_array.without_repeats(docs_of(spark, rows), 8, False, anchor=3).collect()
    assert sorted((r.doc_id or 0, bytes(r.kept)) for r in got) == [
        (0, b"hZ"), (0, b"z"), (1, b""), (1, b""), (2, b"12345678")]
    first = suffix_array.without_repeats(docs_of(spark, rows[2:]), 8, True, anchor=3).collect()
    assert sum(len(r.kept) for r in first) == 21 + 8 - 9
    empty = docs_of(spark, rows).limit(0)
    assert suffix_array.without_repeats(empty, 8, anchor=3).count() == 0


def test_pieces_of_a_common_string(spark):
    """One short string in all documents, between texts of their own: its anchor is
    extended, and no longer string is taken for a repeat."""
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(40)) + "common line of text!"
             + "".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(300)]
    got = suffix_array.without_repeats(
        docs_of(spark, rows), 40, False, anchor=8, anchor_pieces=20).collect()
    assert all(r.n_removed == 0 for r in got)


# --- periodic runs


def test_tile_runs():
    rng = random.Random(5)
    for _ in range(40):
        w = [rng.choice("ab") for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(4)):
            part = [rng.choice("abcdef") for _ in range(rng.randrange(1, 30))]
            w += (part * 6)[: rng.randrange(len(part), 6 * len(part))]
        ids = np.array([ord(x) for x in w], np.int32)
        runs = periodic_runs.tile_runs(
            ids, np.array([0]), np.array([len(w)]), np.array([0]), np.array([62]),
            np.array([True]))
        smallest = {}
        for _, q, s, e in sorted(runs, key=lambda r: r[1]):
            smallest.setdefault((s, e - s), q)
        assert sorted((s, n, q) for (s, n), q in smallest.items()) == brute.periodic_runs(w)


@pytest.fixture(scope="module")
def rhythmic():
    rng = random.Random(6)

    def plain(n):
        return [f"w{rng.randrange(300)}" for _ in range(n)]

    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a a"), (5, "a a a a a"),
            (6, "  größe\n\n" * 7 + "x"), (7, "a b a b a b a b c\u0085d"), (None, "a " * 9)]
    for i in range(10, 60):
        w = plain(rng.randrange(50))
        for _ in range(rng.randrange(3)):
            part = plain(rng.randrange(1, 40))
            w += (part * 9)[: rng.randrange(9 * len(part))] + plain(rng.randrange(10))
        rows.append((i, " ".join(w)))
    rows.append((70, " ".join(plain(500) + plain(130) * 6 + ["z"] * 700 + plain(700) * 5)))
    rows.append((71, "\n".join(["z"] * 1500 + plain(3) * 400 + plain(60))))
    rows += [(72, "a a a a a a a"), (72, "b b b b b b b c")]
    return rows


@pytest.mark.parametrize("tile", [periodic_runs.TILE_WORDS, 128])
def test_collapsed(spark, rhythmic, tile):
    got = periodic_runs.collapsed(docs_of(spark, rhythmic), tile=tile).collect()
    want = []
    for i, text in rhythmic:
        w = brute.words(text)
        runs = brute.periodic_runs(w)
        want.append((i or 0, runs, " ".join(brute.without_repetitions(w, runs))))
    assert sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert any(len(r.runs) > 2 for r in got)
    assert periodic_runs.collapsed(docs_of(spark, rhythmic).limit(0)).count() == 0


def test_tiles_overlap():
    for n in (0, 5, 100, 1000, 70_000):
        tiles = periodic_runs.tiles_of(n, 128)
        for q in {1, 2, 3, 7, 40, n // 9, n // 4} - {0}:
            octave = q.bit_length() - 1
            if 4 * q > n:
                continue
            own = [(a, b) for a, b, low, high in tiles if low <= octave <= high]
            assert own[0][0] == 0 and own[-1][1] == n
            for (_, end), (start, _) in zip(own, own[1:], strict=False):
                assert end - start >= 4 * q + 6


def test_planted_periods(spark, rhythmic):
    got = periodic_runs.with_periods(spark.createDataFrame(
        [(i, t) for i, t in rhythmic] + [(i, "a b c d e f g h i j") for i in range(100, 200)], DOCS))
    changed = 0
    for r in got.collect():
        source = dict(rhythmic).get(r.doc_id) if r.doc_id not in range(100, 200) else (
            "a b c d e f g h i j")
        if r.doc_id == 72:
            continue
        assert brute.words(r.text) == brute.with_periods(r.doc_id, source)
        changed += r.text != source
    assert changed > 5


def test_digests(spark):
    runs = [(0, 8, 2), (20, 4, 1), (30, 12, 3), (50, 9, 2)]
    frame = spark.createDataFrame([(1, runs, "x"), (2, [], "")], f"doc_id bigint, "
                                  f"runs {periodic_runs.RUNS}, collapsed string")
    one, two = periodic_runs.digests(frame).orderBy("doc_id").collect()
    assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (4, 50, 9, 2, 4500)
    assert tuple(two)[1:6] == (0, None, None, None, None)
