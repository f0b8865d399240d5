"""Every registered query against its SQL on the smallest given tables, and the
shape of the plans that matter at scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference

from lexispark.operators import boolean, corpus, index, ranking
from lexispark.plans.queries import REGISTERED
from lexispark.operators.query_text import query_table
from lexispark.plans import inputs

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_sql():
    assert set(REGISTERED) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@given
@pytest.mark.parametrize("name", list(REGISTERED))
def test_query_equals_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert difference(frame, con, entry.oracle_sql()[name]) is None


@given
def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, 11))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@given
def test_only_needed_columns_are_read(spark):
    text = plan(inputs.tokens(spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "ReadSchema: struct<>" in plan(corpus.doc_count(
        spark.read.parquet(f"{SF_DIR}/documents.parquet")))


def test_postings_shuffle_documents_once(tokens):
    for positions in (False, True):
        text = plan(index.postings(tokens, positions))
        assert text.count("Exchange hashpartitioning(doc_id") == 1
        assert text.count("Exchange") == 1


def test_row_local_steps_do_not_shuffle(tokens):
    for frame in (tokens, corpus.term_rows(tokens), corpus.position_rows(tokens),
                  corpus.biword_rows(tokens), corpus.doc_lengths(tokens)):
        assert "Exchange" not in plan(frame)


def test_scoring_shuffles_by_document_only(spark, docs):
    query = ranking.QueryTerms.of(query_table(spark, "red fox"))
    search = ranking.scan_documents(docs, query)
    text = plan(ranking.bm25(search, query)).split("Subqueries")[0]
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert text.count("REPARTITION_BY_COL") == 1


def test_boolean_shuffles_by_document_only(spark, tokens):
    text = plan(boolean.boolean_search(tokens, query_table(spark, "red AND fox OR hill")))
    assert text.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in text
