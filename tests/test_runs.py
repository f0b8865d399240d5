"""Lists made of neighboring rows: whole groups, and one shuffle or none."""

import pyarrow as pa
import pytest

from lexispark import scale
from lexispark.operators import blocks, corpus, index, numbering, runs
from lexispark.scale import materialize
from lexispark.sources import articles


@pytest.fixture(scope="module")
def small(spark):
    texts = ["red fox", "fox  fox hill", "7", "", "hill red fox hill"]
    docs = spark.createDataFrame(
        [(i * 3, texts[i % 5]) for i in range(40)], "doc_id bigint, content string")
    return materialize(corpus.token_table(docs), "tokens")


@pytest.mark.parametrize("size", [1, 2, 5, 100])
def test_groups_over_batches(size, monkeypatch):
    monkeypatch.setattr(runs, "BATCH_ROWS", 2)
    keys = [None, None, "a", "a", "a", "a", "a", "b", "c", "c"]
    rows = pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])
    parts = [rows.slice(at, size) for at in range(0, len(keys), size)] + [rows.slice(0, 0)]
    got = []
    for batch, starts in runs.whole_groups(iter(parts), ["key"]):
        ends = [*starts[1:], batch.num_rows]
        got += [batch.column(0)[int(a):int(b)].to_pylist() for a, b in zip(starts, ends, strict=True)]
    assert got == [[None] * 2, ["a"] * 5, ["b"], ["c"] * 2]


def test_id_lists_of_repeated_and_null_ids(spark):
    rows = spark.createDataFrame(
        [(5, "x"), (None, "x"), (5, "x"), (3, "x"), (70, "x"), (None, "y")],
        "doc_id bigint, term string").repartition(3)
    got = index._id_lists(rows, "term", 6).collect()
    assert sorted((r.term, r.segment if r.segment is not None else -1, r.doc_ids) for r in got) == [
        ("x", -1, []), ("x", 0, [3, 5]), ("x", 1, [70]), ("y", -1, [])]


def test_id_lists_are_shuffled_as_rows(small):
    """no lists of one id before the shuffle."""
    for lists in (index.biword_index(small, 3), index.inverted_index(small, 3)):
        assert "Aggregate" not in lists._jdf.queryExecution().executedPlan().toString()


def test_positional_index_is_one_shuffle(small, monkeypatch):
    """F10, F15, F16: no join of lists with counts; frequent terms give the same."""
    postings = materialize(index.local_postings(small), "postings")
    lists = index.positional_index(postings, 3)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan
    monkeypatch.setattr(index, "FREQUENT_ROWS", 5)
    assert index.frequent_terms(postings)
    dealt = index.positional_index(postings, 3)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, lists.collect()))
    fox = [r for r in lists.collect() if r.term == "fox"]
    assert {r.df for r in fox} == {24} and sum(len(r.docs) for r in fox) == 24
    assert all(r.docs == sorted(r.docs) for r in fox)


def test_local_postings_in_slices(spark, small, monkeypatch):
    """F7, F8, F14: array operations give what the shuffled form gives."""
    local = index.local_postings(small)
    assert "MapInArrow" in local._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(str, local.select("term", "doc_id", "tf", "positions").collect()))
    want = index.postings(small, positions=True).select("term", "doc_id", "tf", "positions")
    assert got == sorted(map(str, want.collect()))
    odd = spark.createDataFrame(
        [(1, 0, 0, None), (2, 0, 0, []), (3, 3, 2, ["b", "", "b"]), (None, 1, 1, [None, "a"])],
        "doc_id bigint, doc_len int, indexed_len int, tokens array<string>").coalesce(1)
    rows = sorted((r.term, r.doc_id, r.tf, r.positions) for r in index.local_postings(odd).collect())
    assert rows == [("a", None, 1, [2]), ("b", 3, 2, [1, 3])]


def test_document_slices(monkeypatch):
    monkeypatch.setattr(index, "SLICE_TOKENS", 3)
    tokens = pa.array([["b", "a"], None, ["a", "a", "", "c"], [], ["c"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3, 4, 5]), *[pa.array([0] * 5, pa.int32())] * 2, tokens],
        ["doc_id", "doc_len", "indexed_len", "tokens"])
    rows = [r for part in index._local(iter([batch])) for r in part.to_pylist()]
    assert sorted((r["doc_id"], r["term"], r["positions"]) for r in rows) == [
        (1, "a", [2]), (1, "b", [1]), (3, "a", [1, 2]), (3, "c", [4]), (5, "c", [1])]


def test_blocks_and_numbers_without_a_shuffle(spark, small):
    """blocks are made where the stored postings lie, tokens from sorted texts."""
    from pyspark.sql import functions as F

    docs = small.select("doc_id", F.array_join("tokens", " ").alias("content"))
    before = len(scale._materialized)
    tokens = numbering.numbered(docs, corpus.token_table)
    assert len(scale._materialized) == before
    assert [r.doc_no for r in tokens.orderBy("doc_id").collect()] == list(range(40))
    stored = materialize(index.local_postings(tokens).coalesce(1), "postings")
    made = blocks.posting_blocks(stored, F.lit(2.0), 2)
    assert "hashpartitioning" not in made._jdf.queryExecution().executedPlan().toString()
    rows = made.where("term = 'fox'").collect()
    assert sum(r.n for r in rows) == 24 and len({r.block for r in rows}) == len(rows)
    assert all(r.n == len(r.docs) for r in rows)


def test_articles_are_parsed_by_the_slice(monkeypatch):
    """what is held besides a batch is a slice of it, not all its parsed texts."""
    monkeypatch.setattr(articles, "SLICE_BYTES", 100)
    xml = [f'<n itemid="{i}"><title>{"x" * 60}</title></n>'.encode() for i in range(10)] + [None]
    contents = pa.array(xml, pa.binary())
    parts = list(articles._parsed(iter([contents, contents.slice(0, 0)])))
    assert max(len(part) for part in parts) <= 2
    rows = [row for part in parts for row in part.to_pylist()]
    assert [row["item"] for row in rows] == [*map(str, range(10)), None]
    assert rows[-1]["error"].startswith("malformed XML")
