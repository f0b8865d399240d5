"""Relations that hold between operators on any collection."""

import os

import pytest
from pyspark.sql import functions as F

from lexispark.operators import boolean, corpus, index, ranking
from lexispark.operators.query_text import query_table
from lexispark.plans import inputs
from lexispark.scale import materialize

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def table(spark):
    return materialize(inputs.tokens(spark, SF_DIR), "tokens")


def pairs(frame):
    return {tuple(r) for r in frame.collect()}


def test_frequencies_agree(table):
    postings = index.postings(table)
    stats = index.term_stats(postings)
    listed = index.inverted_index(table).groupBy("term").agg(
        F.sum(F.size("doc_ids")).alias("df"))
    assert pairs(stats.select("term", "df")) == pairs(listed.select("term", "df"))
    assert pairs(stats.select("term", "df")) == pairs(index.document_frequencies(table))
    totals = stats.agg(F.sum("df"), F.sum("cf")).first()
    assert totals[0] == postings.count()
    assert totals[1] == corpus.term_rows(table).count()
    assert totals[1] == corpus.corpus_stats(table).first().total_indexed_len


def test_segments_hold_each_document_once(table):
    for bits in (3, 16):
        rows = index.inverted_index(table, segment_bits=bits).select(
            "term", F.explode("doc_ids").alias("doc_id"))
        assert rows.count() == rows.distinct().count()
        assert rows.count() == corpus.distinct_term_rows(table).count()


def test_and_is_within_or(spark, table):
    both = pairs(boolean.boolean_search(table, query_table(spark, "this AND tion")))
    either = pairs(boolean.boolean_search(table, query_table(spark, "this OR tion")))
    assert both and both < either


def test_one_term_factored_is_saturation_times_idf(spark, table):
    docs = inputs.documents(spark, SF_DIR)
    query = ranking.QueryTerms.of(query_table(spark, "leon"))
    search = ranking.scan_documents(docs, query)
    stats = search.corpus.first()
    df = search.terms.first().df
    average = stats.total_len // stats.n_docs
    idf = search.postings.select(F.log10(F.lit(float(stats.n_docs // df)))).first()[0]
    want = {
        r.doc_id: pytest.approx(
            3 * r.tf / (2 * (0.25 + 0.75 * r.doc_len / average) + r.tf) * idf)
        for r in search.postings.collect()}
    got = {r.doc_id: r.score for r in ranking.bm25_factored(search, query).collect()}
    assert got == want


def test_best_of_many_equals_best_of_each(spark, table):
    docs = inputs.documents(spark, SF_DIR)
    texts = {1: "this tion", 2: "leon the end", 3: "eriner thanea"}
    query = ranking.QueryTerms.of(query_table(spark, texts))
    together = pairs(ranking.top_k(
        ranking.bm25(ranking.scan_documents(docs, query), query), 5).select("query_id", "doc_id"))
    apart = set()
    for key, text in texts.items():
        one = ranking.QueryTerms.of(query_table(spark, {key: text}))
        apart |= pairs(ranking.top_k(
            ranking.bm25(ranking.scan_documents(docs, one), one), 5).select("query_id", "doc_id"))
    assert together == apart
