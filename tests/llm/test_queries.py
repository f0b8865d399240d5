"""The registered queries against their SQL, and the pipeline against plain versions."""

import os

import __spark_entry__ as entry
import brute
import corpus_pipeline
import pytest
from compare import connect, difference

from lexispark.llm import bpe, quality
from lexispark.llm.queries import ACCEPTED, REGISTERED, vocabulary_path
from lexispark.llm.sql import ORACLE

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not (os.path.isdir(SF_DIR)), reason="no given tables")


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in REGISTERED]
    assert sorted(numbers) == list(range(1, 14))
    assert {*REGISTERED, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    frame = REGISTERED[name](spark, SF_DIR)
    assert difference(frame, connect(SF_DIR), ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in REGISTERED if n.split("_")[0] in (
    "op3", "op6", "op10")])
def test_native_plans(spark, name):
    plan = REGISTERED[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = quality.score_documents(docs, labels).where(f"score >= {ACCEPTED}").collect()
    accepted = {r.doc_id for r in scores}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in accepted]
    cut = brute.without_repeated_lines(rows)
    texts = {i: t for i, t in rows}
    rows = [(i, t if e + n else texts[i]) for i, (t, e, n) in cut.items()
            if not (e + n) or t.strip(" \t\n\v\f\r")]
    classes = brute.near_duplicates(rows)
    rows = [(i, t) for i, t in rows if classes[i][0] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hit = brute.hits(rows, items)
    rows = {i: t or "" for i, t in rows if not hit[i][1]}
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows.items()}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for empty in (docs.limit(0), docs.limit(1).selectExpr(
            "doc_id", "cast(null as string) text", "cast(null as string) lang",
            "cast(null as string) source", "cast(null as bigint) n_chars")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, empty, SF_DIR).columns == docs.columns
        assert corpus_pipeline.encode(spark, empty, SF_DIR).count() == empty.count()
    assert bpe.byte_letters()[chr(256)] == 0
