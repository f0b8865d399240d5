import math
import random

import pytest
from pyspark.sql import functions as F

from lexispark.operators import boolean, corpus, index, ranking
from lexispark.operators.query_text import (clause_terms, query_bag, query_table, query_words,
                                            split_operands)
from lexispark.scale import Sized


def found(frame):
    return sorted(r.doc_id for r in frame.collect())


@pytest.mark.parametrize("text, want", [
    ("fox AND hill", [3]),
    ("fox AND zzzz", []),
    ("ran OR hill", [1, 2, 3]),
    ("ran OR zzzz", [1]),
    ("red fox", [1]),
    ("red AND fox AND ran", [1]),
    ("RED  AND  Fox!", [1]),
    ("red fox OR hill", [1, 2, 3]),
    ("fox fox", [1, 3]),
    ("7", []),
    ("zzz OR red 7 AND ran", [1]),
    ("zzz OR red\nAND ran", [1]),
    ("red AND hill OR fox AND ran", [1, 2]),
])
def test_boolean(spark, tokens, text, want):
    assert found(boolean.boolean_search(tokens, query_table(spark, text))) == want


@pytest.mark.parametrize("text, want", [
    ("red fox", [1]), ("red fox AND fox ran", [1]), ("red fox OR fox hill", [1, 3]),
    ("red ran", []), ("red fox ran", [1]), ("fox ran hill", []),
    ("red fox AND fox ran OR fox hill", [1, 3]), ("red fox AND fox hill", []),
])
def test_phrases(spark, tokens, text, want):
    assert found(boolean.phrase_search(tokens, query_table(spark, text))) == want


def test_and_or_of_terms(tokens):
    rows = corpus.distinct_term_rows(tokens)
    assert found(boolean.all_of(rows, ["fox", "hill"])) == [3]
    assert found(boolean.any_of(rows, ["ran", "hill"])) == [1, 2, 3]


def test_many_queries_and_counts(spark, tokens):
    queries = query_table(spark, {1: "fox AND hill", 2: "red OR ran", 3: "zzzz"})
    results = boolean.boolean_search(tokens, queries)
    assert {tuple(r) for r in boolean.hit_counts(results).collect()} == {(1, 1), (2, 2)}
    assert {tuple(r) for r in boolean.hit_counts(results, queries).collect()} == {
        (1, 1), (2, 2), (3, 0)}


def test_word_matching_keeps_occurrences(spark, tokens):
    inverted = index.inverted_index(tokens)
    rows = boolean.match_words(inverted, query_table(spark, "fox Fox zzzz")).collect()
    assert sorted((r.pos, r.term, tuple(r.doc_ids)) for r in rows) == [
        (1, "fox", (1, 3)), (2, "fox", (1, 3))]
    assert [r.doc_ids for r in boolean.lookup(inverted, " FOX").collect()] == [[1, 3]]
    assert boolean.lookup(inverted, "fo").count() == 0


def test_query_parsing(spark):
    queries = query_table(spark, {1: "a AND b OR c", 2: "Red fox fox"})
    rows = {(r.query_id, r.clause, r.operand) for r in split_operands(queries).collect()}
    assert rows == {(1, 0, "a"), (1, 0, "b"), (1, 1, "c"), (2, 0, "Red fox fox")}
    assert {tuple(r) for r in query_bag(queries.where("query_id = 2")).collect()} == {
        (2, "red", 1), (2, "fox", 2)}
    assert query_words(queries.where("query_id = 2")).count() == 3
    assert {(r.clause, r.term, r.n_terms) for r in
            clause_terms(queries.where("query_id = 1")).collect()} == {
        (0, "a", 2), (0, "b", 2), (1, "c", 1)}


def score(spark, docs, text, scorer, **options):
    query = ranking.QueryTerms.of(query_table(spark, text))
    rows = scorer(ranking.scan_documents(docs, query), query, **options).collect()
    return {r.doc_id: r.score for r in rows}


def test_tf_idf(spark, docs):
    assert score(spark, docs, "ran", ranking.tf_idf) == {
        1: pytest.approx(math.log10(3) ** 2 / 3)}
    assert score(spark, docs, "fox", ranking.tf_idf) == {1: 0.0, 3: 0.0}
    real = score(spark, docs, "fox fox", ranking.tf_idf, arithmetic="real")
    assert real == {1: pytest.approx(math.log10(1.5) ** 2 * 2 / 3),
                    3: pytest.approx(math.log10(1.5) ** 2 * 2 * 2 / 3)}
    with pytest.raises(ValueError):
        score(spark, docs, "fox", ranking.tf_idf, arithmetic="exact")


def test_bm25_factored(spark, docs):
    damped = 3 / (2 * (0.25 + 0.75 * 3 / 2) + 1)
    assert score(spark, docs, "ran", ranking.bm25_factored) == {
        1: pytest.approx(math.log10(3) * damped)}
    # Words count once, and a term's idf reaches documents without the term.
    both = score(spark, docs, "ran ran hill", ranking.bm25_factored)
    assert set(both) == {1, 2, 3}
    assert both[1] == pytest.approx(math.log10(3) * damped)


def test_bm25(spark, docs):
    want = math.log10(2.5 / 1.5) * 3 / (1 + 2 * (0.25 + 0.75 * 3 / (8 / 3)))
    assert score(spark, docs, "ran", ranking.bm25) == {1: pytest.approx(want)}
    assert score(spark, docs, "ran ran zzzz", ranking.bm25) == {1: pytest.approx(2 * want)}
    assert score(spark, docs, "zzzz", ranking.bm25) == {}


def test_statistics_that_do_not_fit_fail(spark, docs, tokens):
    query = ranking.QueryTerms.of(query_table(spark, "ran"))
    found = ranking.searchable(tokens)
    stale = ranking.Searchable(found.postings, found.terms.withColumn("df", F.lit(9)), found.corpus)
    with pytest.raises(Exception, match="exceeds document count"):
        ranking.tf_idf(stale, query).collect()


def test_unbounded_queries_give_the_same(spark, docs, tokens):
    """Past the size check nothing is broadcast or sent as a literal."""
    query = ranking.QueryTerms.of(query_table(spark, {1: "red fox", 2: "hill hill"}))
    assert query.bag.small and query.terms == ["fox", "hill", "red"]
    large = ranking.QueryTerms(Sized(query.bag.df, None))
    assert large.terms is None
    for scorer in (ranking.tf_idf, ranking.bm25, ranking.bm25_factored):
        small_rows = {tuple(r)[:2]: pytest.approx(r.score) for r in
                      scorer(ranking.scan_documents(docs, query), query).collect()}
        for found in (ranking.searchable(tokens), ranking.scan_documents(docs, large)):
            large_rows = {tuple(r)[:2]: r.score for r in scorer(found, large).collect()}
            assert large_rows == small_rows


def test_top_k(spark):
    rng = random.Random(3)
    rows = [(q, d, float(rng.randrange(50))) for q in (1, 2) for d in range(3000)]
    scores = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double")
    for k in (1, 10, 2000):
        got = {(r.query_id, r.rank, r.doc_id) for r in ranking.top_k(scores, k).collect()}
        want = set()
        for q in (1, 2):
            best = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[2], r[1]))[:k]
            want |= {(q, i + 1, r[1]) for i, r in enumerate(best)}
        assert got == want
    plan = ranking.top_k(scores, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, plan


def test_key_order(spark):
    scores = spark.createDataFrame([(1, 10, 1.0), (1, 9, 2.0)],
                                   "query_id bigint, doc_id bigint, score double")
    assert [r.doc_id for r in ranking.in_key_order(scores).collect()] == [10, 9]


def test_random_corpus_against_brute_force(spark):
    rng = random.Random(11)
    words = ["fox", "hill", "red", "ran", "dog", "sky", "sea", "-", "the"]
    texts = {d: " ".join(rng.choices(words, [30, 5, 5, 3, 2, 1, 1, 1, 4], k=rng.randrange(1, 30)))
             for d in range(1, 120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, content string")
    token_lists = {r.doc_id: r.tokens for r in
                   corpus.tokenized(docs).collect()}
    words_of = {d: [t for t in ts if t] for d, ts in token_lists.items()}
    query = ["fox", "hill", "hill", "sky"]
    indexed = {d: ws for d, ws in words_of.items() if ws}
    average = sum(map(len, indexed.values())) / len(indexed)
    want = {}
    for w in query:
        df = sum(w in ws for ws in indexed.values())
        for d, ws in indexed.items():
            tf = ws.count(w)
            if tf:
                damped = tf * 3 / (tf + 2 * (0.25 + 0.75 * len(ws) / average))
                idf = math.log10((len(indexed) - df + 0.5) / (df + 0.5))
                want[d] = want.get(d, 0) + damped * idf
    got = score(spark, docs, " ".join(query), ranking.bm25)
    assert got == {d: pytest.approx(s) for d, s in want.items()}
