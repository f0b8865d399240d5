"""Steps that would repeat work, or hold more than a part of it, on large tables."""

import pytest

from lexispark.operators import boolean, corpus, index
from lexispark.operators.query_text import query_table
from lexispark.plans import queries
from lexispark.sources import index_text, long_lines


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(1, "one two three " * 50), (2, "red fox"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_replaced_output_normalizes_once(spark, tables, monkeypatch):
    plans = []
    write = index_text.write_doc_lengths
    monkeypatch.setattr(index_text, "write_doc_lengths",
                        lambda df, path: (plans.append(optimized(df)), write(df, path)))
    rows = queries.replaced_output(spark, tables).collect()
    assert [(r.doc_id, r.doc_len) for r in rows] == [(1, 150)]
    assert len(plans) == 2 and not any("regexp_replace" in plan for plan in plans)


def test_phrase_search_normalizes_once(spark, docs):
    tokens = corpus.token_table(docs)
    found = boolean.phrase_search(tokens, query_table(spark, {
        1: "red fox ran", 2: "fox fox hill OR red hill", 3: "fox ran AND red fox", 4: "hill"}))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 2), (2, 3), (3, 1)]
    assert " Union" not in optimized(found)


def test_length_join_partitions_follow_the_tokens(spark, tables, monkeypatch):
    want = sorted(map(tuple, queries.doc_length_join(spark, tables).collect()))
    monkeypatch.setattr(index, "PARTITION_TOKENS", 4)
    joined = queries.doc_length_join(spark, tables)
    assert "REPARTITION_BY_NUM" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.rdd.getNumPartitions() == 152 // 4 + 1
    assert sorted(map(tuple, joined.collect())) == want == sorted([
        *((term, 1, 50, 150) for term in ("one", "two", "three")), ("red", 2, 1, 2),
        ("fox", 2, 1, 2)])


def test_heads_of_ranges_are_not_sorted(spark, tmp_path, monkeypatch):
    """A sort by range would hold all ids of a split in one task."""
    index_text.write_lines(spark.createDataFrame(
        [("a\t1 2 3",), ("b\t2 3",)], "value string").coalesce(1), f"{tmp_path}/lines")
    plans = []
    last = long_lines._last_heads
    monkeypatch.setattr(long_lines, "_last_heads", lambda rows, first_is_head: (
        plans.append(last(rows, first_is_head)), plans[-1])[1])
    found = long_lines.read_id_rows(spark, f"{tmp_path}/lines").collect()
    assert sorted(map(tuple, found)) == [("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 3)]
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
