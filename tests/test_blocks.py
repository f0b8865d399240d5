"""Dense numbers, row-local postings, block-max search, bitmaps and long phrases."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.operators import bitmaps, blocks, boolean, corpus, index, numbering, ranking
from lexispark.operators.query_text import query_table
from lexispark.scale import materialize, shared_path
from lexispark.sources import index_store


def texts(rng, n, kinds=60):
    """Documents in which some terms are common and some rare."""
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(kinds)]
    shares = [1 / (i + 1) for i in range(kinds)]
    return [" ".join(rng.choices(words, shares, k=rng.randrange(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def sparse(spark):
    """2,000 documents under hashed ids."""
    rng = random.Random(1)
    rows = [(rng.randrange(1 << 62), t + " rarely" * (i < 6)) for i, t in enumerate(texts(rng, 2000))]
    return spark.createDataFrame(rows, "doc_id bigint, content string").repartition(7)


@pytest.fixture(scope="module")
def stored(spark, sparse):
    path = shared_path(spark, "test-blocks")
    index_store.build_index(sparse, path, buckets=4, biwords=True, block_max=True, segments=True)
    return index_store.read_index(spark, path)


def test_numbers_are_dense_and_in_id_order(spark, sparse):
    rows = numbering.numbered(sparse).orderBy("doc_no").collect()
    assert [r.doc_no for r in rows] == list(range(2000))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in sparse.collect())
    assert numbering.numbered(sparse.limit(0)).count() == 0


def test_lists_are_as_many_as_with_dense_ids(spark, sparse):
    numbered = numbering.numbered(corpus.token_table(sparse))
    dense = numbered.withColumn("doc_id", F.col("doc_no")).drop("doc_no")
    for build in (index.inverted_index, index.biword_index):
        for bits in (6, 16):
            got, want = build(numbered, bits), build(dense, bits)
            assert got.count() == want.count() < build(numbered.drop("doc_no"), bits).count()
    positional = index.positional_index(materialize(index.local_postings(numbered), "test"), 6)
    assert positional.count() == index.inverted_index(numbered, 6).count()


def test_local_postings(spark, sparse, tokens):
    for table in (tokens, corpus.token_table(sparse)):
        local = index.local_postings(table)
        columns = ["term", "doc_id", "tf", "doc_len", "indexed_len", "positions"]
        assert sorted(map(tuple, local.select(columns).collect())) == sorted(
            map(tuple, index.postings(table, positions=True).select(columns).collect()))
        assert "Exchange" not in tokens_plan(index.local_postings(tokens))


def tokens_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 10, 3000])
def test_block_max_equals_full_scoring(spark, stored, k):
    rng = random.Random(k)
    queries = {i: " ".join(t.split()[:rng.randrange(1, 4)]) for i, t in enumerate(texts(rng, 12))}
    queries |= {20: "taa tcb tcc", 21: "zzz taa taa", 22: "zzz"}
    query = ranking.QueryTerms.of(query_table(spark, queries))
    want = ranking.top_k(ranking.bm25(stored, query), k)
    got = stored.top_k(query, k)

    def rows(frame):
        return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in frame.collect())

    assert rows(got) == rows(want)


def test_block_max_opens_few_blocks(spark, stored):
    query = ranking.QueryTerms.of(query_table(spark, "tab rarely"))
    seen = []
    stored.top_k(query, 5, seen.append).collect()
    opened = stored.blocks.where("term IN ('tab', 'rarely')").join(seen[0], "block")
    every = stored.postings.where("term IN ('tab', 'rarely')").count()
    assert 0 < opened.agg(F.sum("n")).first()[0] < every / 2


def test_blocks_hold_every_posting(spark, stored):
    rows = stored.blocks.select("term", "n", "most", F.explode("docs").alias("d"))
    assert rows.count() == stored.postings.count()
    assert stored.blocks.agg(F.max("n")).first()[0] <= 1 << blocks.BLOCK_BITS


BOOLEAN = {1: "taa AND tab", 2: "tcg OR tcf", 3: "taa AND zzz", 4: "taa tab tac OR tcg AND taa",
           5: "zzz OR tch"}


def test_bitmaps_equal_boolean_search(spark, stored, sparse, monkeypatch):
    queries = query_table(spark, BOOLEAN)
    want = sorted(map(tuple, stored.boolean_search(queries).collect()))
    assert sorted(map(tuple, stored.bitmap_search(queries).collect())) == want
    counts = {r.query_id: r.n_hits for r in bitmaps.counts(stored.bitmap_matches(queries)).collect()}
    assert counts == {q: sum(r[0] == q for r in want) for q in {r[0] for r in want}}
    rows = numbering.numbered(corpus.token_table(sparse))
    for listed in (0, 100):
        segments = materialize(
            bitmaps.term_segments(corpus.distinct_term_rows(rows), listed), "test-segments")
        assert segments.count() == segments.select("term", "segment").distinct().count()
        assert segments.where("bits IS NULL").count() == (0 if listed == 0 else
                                                          segments.where("n <= 100").count())
        got = bitmaps.matching_segments(segments, boolean.clause_terms(queries))
        numbers = bitmaps.document_numbers(got).join(rows, "doc_no").select("query_id", "doc_id")
        assert sorted(map(tuple, numbers.collect())) == want


def test_many_segments(spark):
    """Numbers beyond one bitmap, and a term in every document."""
    rows = spark.range(100_000).select(
        F.col("id").alias("doc_no"), F.explode(F.array(
            F.lit("all"), F.when(F.col("id") % 2 == 0, "even"),
            F.when(F.col("id") % 30_000 == 0, "rare"))).alias("term")).where("term IS NOT NULL")
    segments = materialize(bitmaps.term_segments(rows), "test-segments")
    assert segments.groupBy("term").count().collect().__len__() == 3
    clauses = boolean.clause_terms(query_table(spark, {1: "even AND all", 2: "rare even OR rare"}))
    found = bitmaps.matching_segments(segments, clauses)
    assert {r.query_id: r.n_hits for r in bitmaps.counts(found).collect()} == {1: 50_000, 2: 4}
    numbers = bitmaps.document_numbers(found.where("query_id = 2")).collect()
    assert sorted(r.doc_no for r in numbers) == [0, 30_000, 60_000, 90_000]


@pytest.mark.parametrize("text,want", [
    ("red fox hill", [1]), ("red fox sat", [2]), ("red fox sat fox hill", [2]),
    ("fox hill red fox", []), ("red fox hill OR sat fox hill AND red fox", [1, 2]),
    ("fox fox fox", [4]), ("red ran", [1]), ("ran red fox", [5]),
    ("the hill red", []), ("fox hill and", [])])
def test_long_phrases(spark, text, want):
    docs = spark.createDataFrame(
        [(1, "a red fox hill and red ran"), (2, "red fox sat fox hill"), (3, "red fox\nthe 7\nhill"),
         (4, "fox fox fox"), (5, "fox ran! red fox")], "doc_id bigint, content string")
    scanned = boolean.phrase_search(corpus.token_table(docs), query_table(spark, text))
    assert sorted(r.doc_id for r in scanned.collect()) == want
    path = shared_path(spark, "test-phrases")
    index_store.build_index(docs, path, buckets=2, biwords=True)
    found = index_store.read_index(spark, path).phrase_search(query_table(spark, text))
    assert sorted(r.doc_id for r in found.collect()) == want
