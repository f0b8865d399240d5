"""Searches with more query terms than a literal list takes."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.operators import corpus, ranking
from lexispark.operators.query_text import query_table
from lexispark.scale import BitSet, Sized, check_size


def word(i):
    return "".join(chr(97 + (i // 26**k) % 26) for k in range(5))


@pytest.fixture(scope="module")
def collection(spark):
    """Documents of which one word in ten is among 60,000 wanted terms."""
    rng = random.Random(7)
    rows = [(i, " ".join(word(rng.randrange(60_000) if rng.random() < 0.1 else
                              rng.randrange(60_000, 4_000_000)) for _ in range(200)))
            for i in range(300)]
    return spark.createDataFrame(rows, "doc_id bigint, content string")


def test_few_other_tokens_become_rows(spark, collection):
    wanted = spark.range(60_000).select("id").collect()
    terms = spark.createDataFrame([(word(r.id),) for r in wanted], "term string")
    sized = Sized(terms, None)
    tokens = corpus.token_table(collection)
    kept = corpus.likely_tokens(tokens, sized)
    rows = kept.select("doc_id", F.explode("tokens").alias("term"))
    every = tokens.select(F.explode("tokens").alias("term"))
    matches = every.join(terms, "term").count()
    assert rows.join(terms, "term").count() == matches
    assert matches <= rows.count() < 1.7 * matches < every.count() / 4


def test_bit_sets(spark):
    values = spark.range(1000).select(F.col("id").cast("string").alias("term"))
    held = BitSet.of(values, "term").may_hold("term")
    assert values.where(f"NOT ({held})").count() == 0
    others = spark.range(1000, 21_000).select(F.col("id").cast("string").alias("term"))
    assert others.where(held).count() < 2000
    nothing = BitSet.of(values.limit(0), "term").may_hold("term")
    assert others.where(nothing).count() == 0


def test_scores_of_many_terms(spark, collection, monkeypatch):
    """A join and a list of terms give the same."""
    text = " ".join(word(i) for i in range(0, 60_000, 7))
    query = ranking.QueryTerms.of(query_table(spark, text))
    assert query.terms is None
    many = ranking.bm25(ranking.scan_documents(collection, query), query)
    monkeypatch.setattr("lexispark.scale.LITERAL_TERMS", 100_000)
    bag = check_size(query.bag.df, "term")
    few = ranking.QueryTerms(bag)
    listed = ranking.bm25(ranking.scan_documents(collection, few), few)

    def rows(frame):
        return sorted((r.doc_id, round(r.score, 9)) for r in frame.collect())

    assert rows(many) == rows(listed) and many.count() > 200
