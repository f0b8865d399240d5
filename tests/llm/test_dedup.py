"""Exact, line, near-duplicate and substring deduplication against plain versions."""

import random
from fractions import Fraction
from itertools import combinations

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.llm import common, exact_dedup, line_dedup, ngram_join, substring_dedup

DOCS = "doc_id bigint, text string"


def table(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(docs):
    """``docs`` with columns named like those the operators use inside."""
    names = ("lines", "line", "key", "node", "words", "hash", "norm", "copy", "n_exact", "spans")
    return docs.select("*", *[F.lit(1).alias(n) for n in names])


def filler(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.fixture(scope="module")
def varied():
    """Copies, near copies, shared passages, short, empty, null and long texts."""
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "one two three")]
    base, passage = filler(rng, 120), filler(rng, 60)
    for i in range(10, 40):
        w = base.split()
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(i, base) for i in range(50, 60)]
    rows += [(i, f"{filler(rng, 40)} {passage} {filler(rng, 30)}") for i in range(70, 90)]
    rows += [(i, filler(rng, rng.randrange(1, 200))) for i in range(100, 130)]
    rows.append((140, filler(rng, 5000)))
    rng.shuffle(rows)
    return rows


# --- shared helpers


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    edges += [(2000 + i, 2001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((brute.find(parent, a), brute.find(parent, b)))
        parent[y] = x
    got = common.components(table(spark, edges, "a bigint, b bigint"), "test")
    single = {x for x in parent if brute.find(parent, x) == x} - {
        brute.find(parent, x) for x in parent if brute.find(parent, x) != x}
    want = {(x, brute.find(parent, x)) for x in parent if x not in single}
    assert {tuple(r) for r in got.collect()} == want
    assert common.components(table(spark, [], "a bigint, b bigint"), "test").count() == 0


def test_join_groups_with_a_hot_key(spark):
    rows = [(i, "hot") for i in range(3000)] + [(i, f"k{i % 900}") for i in range(3000, 5000)]
    rows += [(6000, None), (6001, "alone")]
    docs = table(spark, rows, "id bigint, key string")
    groups = docs.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    groups = common.materialize(groups.where("n > 1"), "test-groups")
    got = common.join_groups(docs, groups, "key", "n", F.col("id").cast("string")).collect()
    assert len(got) == len(rows)
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    for r in got:
        alone = r.key in (None, "alone")
        assert r["first"] == (None if alone else first[r.key])


# --- exact


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_exact_groups(spark, varied, weak, broadcast_rows):
    rows = [*varied, (201, "a  b"), (202, "a b"), (203, "a b"), (200, "a\r\n\tb")]
    keys = {"content_hash": lambda c: F.substring(F.md5(c), 1, 1)} if weak else {}
    got = exact_dedup.exact_groups(
        clashing(table(spark, rows)), broadcast_rows=broadcast_rows, **keys).collect()
    norm = {i: brute.SPACES.sub(" ", t or "") for i, t in rows}
    for r in got:
        same = [i for i, n in norm.items() if n == norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(same), len(same), min(same) == r.doc_id)
    assert len(got) == len(rows)


def test_exact_with_null_and_repeated_ids(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c")]
    got = exact_dedup.exact_groups(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in got if r.keep_id) == [
        ("1", 1, 3, True), ("1", 1, 3, True), ("2", 2, 1, True), ("None", 1, 3, False)]
    assert [(r.group_size, r.kept) for r in got if r.keep_id is None] == [(2, True)] * 2
    kept = exact_dedup.drop_exact(table(spark, [(1, "a"), (2, "a"), (3, "b")]))
    assert {r.doc_id for r in kept.collect()} == {1, 3}
    kept = exact_dedup.drop_exact(table(spark, rows))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("1", "a"), ("1", "a"), ("2", "c"), ("None", "b"), ("None", "b")]


@pytest.fixture
def shuffled(monkeypatch):
    """No join is broadcast on purpose, as beyond the bounds."""
    for module in (exact_dedup, line_dedup, ngram_join, substring_dedup):
        monkeypatch.setattr(module, "small_side", lambda df, rows=0: df)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    monkeypatch.setattr(substring_dedup, "BROADCAST_NUMBERS", 0)


def test_shuffle_joins_give_the_same(spark, varied, shuffled):
    docs = table(spark, varied).repartition(4)
    near = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(docs).collect()}
    assert near == brute.near_duplicates(varied)
    kept = {r.doc_id: r.kept.split() for r in substring_dedup.without_repeats(docs, 30).collect()}
    assert kept == brute.without_repeats(varied, 30)
    lined = [(i, (t or "").replace(" w1", "\nw1")) for i, t in varied]
    cut = line_dedup.deduplicated(table(spark, lined), counts=True)
    assert {r.doc_id: (r.text, r.n_exact, r.n_near) for r in cut.collect()} == (
        brute.without_repeated_lines(lined))


# --- lines


def test_lines_with_null_and_repeated_ids(spark):
    line, other = "a line that is long enough", "another line that is long enough"
    rows = [(1, line), (None, line), (None, other), (None, None), (2, "x"), (2, line), (1, line)]
    got = line_dedup.deduplicated(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == [
        ("1", line), ("1", line), ("2", ""), ("2", "x"), ("None", ""), ("None", "None"),
        ("None", other)]




def test_banded_distance():
    rng = random.Random(1)
    pairs = []
    for _ in range(1500):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(14)))
        b = bytearray(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                b.insert(at, rng.choice(b"abc"))
            elif at < len(b):
                b[at:at + 1] = b"" if kind == 1 else bytes([rng.choice(b"abc")])
        pairs.append((a, bytes(b)))
    for edits in (1, 2, 3):
        got = line_dedup.within([a for a, _ in pairs], [b for _, b in pairs], edits)
        assert got.tolist() == [brute.distance(a, b) <= edits for a, b in pairs]


@pytest.mark.parametrize("edits", [1, 2])
def test_lines(spark, edits):
    rng = random.Random(9)
    rows, stock = [], [filler(rng, n) for n in (5, 6, 8, 12, 40)] + ["zu über " + "ä" * 12]
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            line = list(rng.choice(stock))
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(line))
                line[at:at + 1] = rng.choice([[], ["q"], ["q", line[at]]])
            lines.append("".join(line) if rng.random() < 0.8 else rng.choice(["", "short", "."]))
        rows.append((i, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, stock[4] + "\n" + "x" * 50_000)]
    docs = clashing(table(spark, rows))
    got = {r.doc_id: (r.text or "", r.e, r.n) for r in line_dedup.deduplicated(
        docs.drop("n_exact"), edits, counts=True).selectExpr(
            "doc_id", "text", "n_exact e", "n_near n").collect()}
    assert got == brute.without_repeated_lines(rows, edits)
    assert sum(n for _, _, n in got.values()) > 10
    assert line_dedup.deduplicated(docs).columns == docs.columns


def test_short_lines(spark):
    long = "a line that is long enough"
    rows = [(1, f"Yes.\n\n \n{long}\nNo.\nYes."), (2, f"Yes.\n\n \n{long}s\nNo!\n行六字"),
            (3, "行六字\nyes."), (None, "No.\n行六字")]
    got = {r.doc_id: (r.text, r.n_exact, r.n_near) for r in line_dedup.deduplicated(
        table(spark, rows), counts=True).collect()}
    assert got == {1: (f"Yes.\n\n \n{long}\nNo.", 1, 0), 2: ("\n \nNo!\n行六字", 1, 1),
                   3: ("yes.", 1, 0), None: ("", 2, 0)}
    again = table(spark, rows).withColumn("n_near", F.lit(7)).withColumn("n_lines", F.lit(1))
    assert line_dedup.deduplicated(again, counts=True).columns == [
        "doc_id", "text", "n_lines", "n_exact", "n_near"]


def test_sketch_bounds_edits():
    rng = random.Random(2)
    for _ in range(300):
        a = bytes(rng.randrange(97, 110) for _ in range(rng.randrange(1, 30)))
        b = bytearray(a)
        at = rng.randrange(len(a))
        b[at:at + 1] = rng.choice([b"", b"z", bytes([a[at], 122])])
        data = np.frombuffer(a + bytes(b), dtype=np.uint8)
        ends = np.array([len(a), len(data)])
        one, two = line_dedup.pair_sketch(data, np.array([0, len(a)]), ends).tolist()
        assert ((one ^ two) & (1 << 64) - 1).bit_count() <= 4


# --- near duplicates


@pytest.mark.parametrize("block", [1000, 4])
def test_near_duplicates(spark, varied, block):
    docs = clashing(table(spark, varied)).repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(
        docs, block=block).collect()}
    assert got == brute.near_duplicates(varied)
    assert max(n for _, n in got.values()) > 20


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "z"), (4, "z")]
    got = ngram_join.near_duplicates(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == [
        ("3", 3, 0), ("3", 3, 0), ("4", 4, 0), ("None", 3, 0), ("None", 4, 0)]
    kept = ngram_join.keep_one(table(spark, [(5, "a b c d e f"), (2, "a b c d e f"), (9, "")]))
    assert {r.doc_id for r in kept.collect()} == {2, 9}


def test_near_duplicates_that_share_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "x")
    rows = [(3, base), (5, base), (5, "an unrelated text of some words"), (5, near), (7, base + " y"),
            (None, "only null ids have this text here"), (None, "only null ids have this text here"),
            (None, near + " z"), (8, "twice the very same row of words"),
            (8, "twice the very same row of words"), (None, None), (None, "")]
    docs = clashing(table(spark, rows))
    got = ngram_join.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == [
        ("3", "3", 4), ("5", "3", 4), ("5", "3", 4), ("5", "5", 0), ("7", "3", 4),
        ("8", "8", 0), ("8", "8", 0), ("None", "3", 4), *[("None", "None", 0)] * 4]
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([
        ("3", base), ("5", rows[2][1]), ("8", rows[8][1]), ("None", rows[5][1]),
        ("None", "None"), ("None", "")])
    rows = [(None, base), (None, near)]
    assert ngram_join.keep_one(table(spark, rows)).count() == 1


def test_pruning_keeps_pairs_at_the_threshold():
    least = ngram_join.least_matches(0.8, 1e-6)
    assert list(least) == [20, 40, 60, 80, 100] and list(least.values()) == sorted(least.values())
    rng = np.random.default_rng(4)
    left = rng.integers(0, 1 << 16, (20_000, 100), dtype=np.uint16)
    right = np.where(rng.random((20_000, 100)) < 0.8, left, left + 1).astype(np.uint16)
    assert len(ngram_join.likely(left, right, least)) >= 19_999
    other = rng.integers(0, 1 << 16, (20_000, 100), dtype=np.uint16)
    assert len(ngram_join.likely(left, other, least)) == 0


# --- substrings


def test_suffix_automaton():
    rng = random.Random(8)
    for _ in range(60):
        texts = [[rng.choice("ab") for _ in range(rng.randrange(12))] for _ in range(4)]
        automaton = substring_dedup.SuffixAutomaton()
        for label, t in enumerate(texts):
            automaton.add(t, label)
        automaton.finish()
        query = [rng.choice("abc") for _ in range(15)]
        for label in range(5):
            covered = set()
            for t in texts[:label]:
                for i in range(len(t) - 2):
                    for k in range(len(query) - 2):
                        if query[k:k + 3] == t[i:i + 3]:
                            covered.update(range(k, k + 3))
            spans = automaton.spans(query, label, 3)
            assert {p for a, b in spans for p in range(a, b)} == covered
            assert all(x[1] < y[0] for x, y in zip(spans[:-1], spans[1:], strict=True))


@pytest.mark.parametrize("window, anchor, shard", [(50, 20, 50_000), (12, 5, 30), (8, 8, 20)])
def test_substrings(spark, varied, window, anchor, shard, monkeypatch):
    monkeypatch.setattr(substring_dedup, "QUERY_WORDS", 40)
    monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", shard)
    rng = random.Random(1)
    rows = [*varied, (300, "la " * 400), (301, "la " * 30), (302, filler(rng, 300, 3))]
    rows.append((303, filler(rng, 300, 3)))
    docs = clashing(table(spark, rows)).repartition(6)
    got = {r.doc_id: r for r in substring_dedup.without_repeats(
        docs, window, anchor=anchor).collect()}
    want = brute.without_repeats(rows, window)
    assert {i: r.kept for i, r in got.items()} == {i: " ".join(w) for i, w in want.items()}
    for i, text in rows:
        n = len(brute.words(text))
        assert (got[i].n_words, got[i].n_removed) == (n, n - len(want[i]))


def test_a_long_document_is_cut_into_shards(spark, monkeypatch):
    """A long text and a near copy of it: no shard has more of it than its share."""
    rng = random.Random(12)
    words = filler(rng, 6000, 5000).split()
    changed = [w if i % 700 else "x" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(words[3000:3100]))]
    kept, write = {}, substring_dedup.materialize

    def written(frame, label):
        kept[label] = write(frame, label)
        return kept[label]

    monkeypatch.setattr(substring_dedup, "materialize", written)
    monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", 500)
    got = {r.doc_id: r.kept.split() for r in substring_dedup.without_repeats(
        table(spark, rows), 30, anchor=10).collect()}
    assert got == brute.without_repeats(rows, 30)
    pieces = kept["substring-pieces"].where("reference").collect()
    assert max(len(r.words.split()) for r in pieces) <= 500 + 29
    assert len({r.shard for r in pieces}) > 4


def test_substrings_with_null_ids(spark):
    text = " ".join(map(str, range(20)))
    rows = [(None, text), (None, text), (7, text), (7, text)]
    got = substring_dedup.without_repeats(table(spark, rows), 10, anchor=4).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [
        ("7", 0), ("7", 0), ("None", 20), ("None", 20)]
    rows = [(None, text), (None, "other " * 30), (7, text), (7, "short"), (8, "a b " + text)]
    got = substring_dedup.without_repeats(table(spark, rows), 10, anchor=4).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == [
        ("7", 1, 0), ("7", 20, 0), ("8", 22, 20), ("None", 20, 20), ("None", 30, 0)]


@pytest.mark.parametrize("operator", [
    exact_dedup.exact_groups, exact_dedup.drop_exact, line_dedup.deduplicated,
    ngram_join.near_duplicates, ngram_join.keep_one, substring_dedup.without_repeats])
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).count() == 0
    assert operator(table(spark, [(1, None)])).count() == 1


@pytest.mark.parametrize(("large", "low", "high"), [(True, 0, 1), (True, 0, 0), (False, 0, 0)])
@pytest.mark.parametrize("empty_block", [False, True])
def test_links_of_a_block_pair(large, low, high, empty_block):
    """A pair of different blocks counts links between them only, also where a block
    has no rows."""
    rng = np.random.default_rng(5)
    n, base = 300, rng.integers(0, 1 << 40, 20)
    sets = [np.unique(np.where(rng.random(20) < 0.06, rng.integers(0, 1 << 40, 20), base))
            for _ in range(n)]
    block = np.ones(n, int) if empty_block else rng.integers(0, 2, n)
    block = block * (low != high)
    copies = rng.integers(1, 4, n)
    found = ngram_join._verified(Fraction(4, 5))(pa.table({
        "component": np.zeros(n, np.int64), "node": np.arange(n), "block": block,
        "copies": copies, "shingles": pa.array(sets, pa.list_(pa.int64())),
        "large": [large] * n, "low": [low] * n, "high": [high] * n}))
    expected = np.zeros(n, int)
    for i, j in combinations(range(n), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        union = len(sets[i]) + len(sets[j]) - common
        if (low == high or block[i] != block[j]) and 5 * common >= 4 * union:
            expected[[i, j]] += copies[[j, i]]
    assert dict(zip(found["node"].to_pylist(), found["links"].to_pylist(), strict=True)) == dict(
        enumerate(expected.tolist()))
