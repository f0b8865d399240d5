from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexispark.operators import corpus, index, ranking
from lexispark.operators.query_text import query_table
from lexispark.scale import materialize, shared_path
from lexispark.sources import index_store, index_text


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_inverted_text(spark, tokens, tmp_path):
    path = str(tmp_path / "inverted")
    for bits in (1, 16):
        inverted = index.inverted_index(tokens, segment_bits=bits)
        index_text.write_lines(index_text.id_list_lines(inverted), path)
        rows = index_text.read_id_lists(spark, path)
        pairs = {(r.term, d) for r in rows.collect() for d in r.doc_ids}
        assert pairs == {("fox", 1), ("fox", 3), ("hill", 2), ("hill", 3), ("ran", 1),
                         ("red", 1), ("red", 2)}
    assert lines(spark, path) == ["fox\t1 3", "hill\t2 3", "ran\t1", "red\t1 2"]


def test_foreign_ids_fail(spark, tmp_path):
    path = tmp_path / "part"
    path.write_text("fox\t1 x3\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        index_text.read_id_lists(spark, str(path)).collect()


def test_positional_text_round_trip(spark, tokens, tmp_path):
    postings = materialize(index.postings(tokens, positions=True), "postings")
    path = str(tmp_path / "positional")
    want = {(r.term, r.doc_id, r.tf, tuple(r.positions)) for r in postings.collect()}
    for bits in (1, 12):
        lists = index.positional_index(postings, bits)
        index_text.write_lines(index_text.positional_lines(lists), path)
        rows = index_text.read_positional(spark, path).collect()
        assert {(r.term, r.doc_id, r.tf, tuple(r.positions)) for r in rows} == want
        assert {r.df for r in rows if r.term == "fox"} == {2}
    assert "fox:2;1:2;3:1,2;\t" in lines(spark, path)


def test_positional_text_without_tab(spark, tmp_path):
    path = tmp_path / "part"
    path.write_text("fox:2;1001:2,7;1002:1;\nran:1;1001:3;\t\n")
    rows = {(r.term, r.df, r.doc_id, r.tf) for r in
            index_text.read_positional(spark, str(path)).collect()}
    assert rows == {("fox", 2, 1001, 2), ("fox", 2, 1002, 1), ("ran", 1, 1001, 1)}


def test_counts_and_lengths(spark, docs, tokens, tmp_path):
    count, lengths = str(tmp_path / "n"), str(tmp_path / "lengths")
    index_text.write_doc_count(corpus.doc_count(docs), count)
    assert index_text.read_doc_count(spark, count).first().n_docs == 3
    index_text.write_doc_lengths(corpus.doc_lengths(tokens), lengths)
    read = index_text.read_doc_lengths(spark, lengths)
    assert {tuple(r) for r in read.collect()} == {(1, 3), (2, 2), (3, 3)}


def test_last_length_counts(spark, tmp_path):
    (tmp_path / "a").write_text("1\t5\n2\t6\n1\t7\n")
    (tmp_path / "b").write_text("2\t8\n")
    rows = index_text.read_doc_lengths(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {(1, 7), (2, 8)}


def test_missing_length_is_an_error(spark, tokens):
    lengths = corpus.doc_lengths(tokens).where("doc_id <> 2")
    postings = index.postings(tokens).select("term", "doc_id", "tf")
    with pytest.raises(Exception, match="no length for document 2"):
        index_text.attach_doc_lengths(postings, lengths).collect()


def test_write_replaces(spark, tokens, tmp_path):
    path = str(tmp_path / "out")
    index_text.write_doc_lengths(corpus.doc_lengths(tokens), path)
    index_text.write_doc_lengths(corpus.doc_lengths(tokens.where("doc_id = 1")), path)
    assert lines(spark, path) == ["1\t3"]


def test_stored_index(spark, docs):
    path = shared_path(spark, "index")
    index_store.build_index(docs, path, buckets=4)
    stored = index_store.read_index(spark, path)
    assert stored.buckets == 4
    query = ranking.QueryTerms.of(query_table(spark, {1: "red fox", 2: "hill hill zzzz"}))
    for scorer in (ranking.tf_idf, ranking.bm25, ranking.bm25_factored):
        got = {tuple(r)[:2]: pytest.approx(r.score) for r in scorer(stored, query).collect()}
        want = {tuple(r)[:2]: r.score for r in
                scorer(ranking.scan_documents(docs, query), query).collect()}
        assert want == got
    narrowed = stored.narrowed(["red"])
    plan = narrowed.postings._jdf.queryExecution().executedPlan().toString()
    assert "In(term_bucket" in plan or "EqualTo(term_bucket" in plan
    assert "EqualTo(term,red)" in plan
    assert {r.term: (r.df, r.cf) for r in stored.terms.collect()} == {
        "fox": (2, 3), "hill": (2, 2), "ran": (1, 1), "red": (2, 2)}
    assert index_store.stored_tokens(spark, path).count() == 3
    positions = {(r.term, r.doc_id): r.positions for r in stored.postings.collect()}
    assert positions[("fox", 3)] == [1, 2]
    assert stored.narrowed(["ran", "zzzz"]).postings.count() == 1


def test_stored_boolean_and_phrases(spark, docs):
    path = shared_path(spark, "index")
    index_store.build_index(docs, path, buckets=4, biwords=True)
    stored = index_store.read_index(spark, path)

    def ids(frame):
        return sorted(r.doc_id for r in frame.collect())

    assert ids(stored.boolean_search(query_table(spark, "fox AND hill"))) == [3]
    assert ids(stored.boolean_search(query_table(spark, "ran OR zzzz"))) == [1]
    assert ids(stored.phrase_search(query_table(spark, "red fox OR fox hill"))) == [1, 3]
    assert ids(stored.phrase_search(query_table(spark, "red ran"))) == []
    index_store.build_index(docs, path, buckets=4)
    with pytest.raises(ValueError, match="without biwords"):
        index_store.read_index(spark, path).phrase_search(query_table(spark, "red fox"))


def test_text_statistics_must_agree(spark, tokens):
    rows = index.postings(tokens).join(
        index.document_frequencies(tokens), "term").select("term", "df", "doc_id", "tf")
    lengths = corpus.doc_lengths(tokens)
    query = ranking.QueryTerms.of(query_table(spark, "ran"))
    count = lengths.agg(F.count("*").alias("n_docs"))
    good = index_text.text_index(rows, count, lengths)
    assert ranking.tf_idf(good, query).count() == 1
    bad = index_text.text_index(rows, count.select((F.col("n_docs") + 1).alias("n_docs")), lengths)
    with pytest.raises(Exception, match="number of lengths differ"):
        ranking.tf_idf(bad, query).collect()
    with pytest.raises(ValueError):
        index_text.text_index(rows, count)


def test_buckets_grow_with_the_collection():
    sizes = [index_store.default_buckets(n) for n in (0, 10**9, 10**10, 10**15)]
    assert sizes == [32, 32, 200, 20_000_000]  # no cap


def test_a_search_opens_only_the_files_of_its_terms(spark, monkeypatch):
    def word(i):  # digits would be stripped
        return "".join(chr(97 + int(d)) for d in str(i % 1500)) + "x"

    texts = [(i, " ".join(f"{word(i * 7 + j)} common" for j in range(30))) for i in range(600)]
    many = spark.createDataFrame(texts, "doc_id bigint, content string").repartition(4)
    path = shared_path(spark, "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index_store.build_index(
            many, path, buckets=40_000, biwords=True, block_max=True, segments=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = index_store.read_index(spark, path)
    everything = len(stored.postings.inputFiles())
    opened = stored.narrowed([word(7)])
    assert everything >= 8 and len(opened.postings.inputFiles()) <= everything // 4
    assert len(opened.terms.inputFiles()) == 1
    assert opened.postings.count() == stored.postings.where(F.col("term") == word(7)).count() > 0
    assert stored.narrowed(["absent word"]).postings.count() == 0
    assert opened.narrowed([word(8)]).postings.count() == 0  # narrowed twice: terms of both
    listed = stored.directory.where("table = 'postings'")
    assert listed.select("file").distinct().count() == everything
    queries = query_table(spark, {1: f"{word(7)} common", 2: f"{word(1499)} {word(3)} {word(3)} nowhere"})
    query = ranking.QueryTerms.of(queries)
    clauses = query_table(spark, f"{word(7)} AND common OR {word(9)}")
    phrases = query_table(spark, f"{word(7)} common OR common {word(9)} common")

    def answers(index):
        return [sorted(map(tuple, rows.collect())) for rows in (
            ranking.top_k(ranking.bm25(index, query)).drop("score"),
            index.top_k(query).drop("score"), index.boolean_search(clauses),
            index.bitmap_search(clauses), index.phrase_search(phrases))]

    want = answers(stored)
    assert all(want)
    monkeypatch.setattr(index_store, "LISTED_FILES", 0)  # more files than are listed
    assert answers(stored) == want
    assert answers(replace(stored, directory=None)) == want  # an index without a directory


def test_term_files_hold_bloom_filters(spark):
    """Where a column has a dictionary throughout, that serves instead."""
    path = shared_path(spark, "terms")
    terms = spark.range(200_000).select(F.sha1(F.col("id").cast("string")).alias("term"), "id")
    index_store._write_by_term(terms, path, 4, "term")
    file = spark.read.parquet(path).inputFiles()[0]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
    reader.close()
    assert offsets["term"] > 0 and offsets["id"] <= 0


def test_repeated_ids_are_refused(spark, docs):
    with pytest.raises(ValueError, match="document id 1 occurs 2 times"):
        index_store.build_index(docs.union(docs.where(F.col("doc_id") == 1)),
                                shared_path(spark, "index"))


def test_a_failed_rebuild_leaves_the_old_index(spark, docs):
    path = shared_path(spark, "index")
    with pytest.raises(FileNotFoundError):
        index_store.read_index(spark, path)
    index_store.build_index(docs, path, buckets=4)
    more = docs.union(spark.createDataFrame([(9, "red wolf"), (9, "wolf")], docs.schema))
    with pytest.raises(ValueError, match="document id 9"):
        index_store.build_index(more, path, buckets=4)
    wolf = query_table(spark, "wolf OR hill")

    def hits():
        found = index_store.read_index(spark, path).boolean_search(wolf)
        return sorted(r.doc_id for r in found.collect())

    assert hits() == [2, 3]
    index_store.build_index(more.where("content <> 'wolf'"), path, buckets=4)
    assert hits() == [2, 3, 9]
    index_store.remove_old_versions(spark, path)
    assert hits() == [2, 3, 9] and index_store.stored_tokens(spark, path).count() == 4


def test_a_large_batch_still_prunes_buckets(spark, docs, monkeypatch):
    from lexispark import scale

    path = shared_path(spark, "index")
    index_store.build_index(docs, path, buckets=64, biwords=True)
    stored = index_store.read_index(spark, path)
    queries = query_table(spark, {1: "red fox", 2: "hill hill zzzz", 3: "y" * 3000})
    scorers = (ranking.tf_idf, ranking.bm25, ranking.bm25_factored)

    def answers():
        query = ranking.QueryTerms.of(queries)
        scanned = ranking.scan_documents(docs, query)
        return query, [{tuple(r)[:2]: pytest.approx(r.score) for r in scorer(s, query).collect()}
                       for scorer in scorers for s in (stored, scanned)]

    query, want = answers()
    assert query.terms is not None
    monkeypatch.setattr(scale, "LITERAL_TERMS", 1)
    for rows in (scale.SMALL_ROWS, 1):  # too many for a list, then for a broadcast
        monkeypatch.setattr(scale, "SMALL_ROWS", rows)
        query, got = answers()
        assert query.terms is None and got == want
        plan = ranking.bm25(stored, query)._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan parquet" in line and "PushedFilters" in line
                   and "term_bucket" in line.split("PushedFilters")[1]
                   for line in plan.split("\n")) >= 2
        phrases = stored.phrase_search(query_table(spark, "red fox OR fox hill"))
        assert sorted(r.doc_id for r in phrases.collect()) == [1, 3]


def test_repeated_ids_in_a_scan(spark, docs):
    query = ranking.QueryTerms.of(query_table(spark, "red"))
    with pytest.raises(ValueError, match="document id 1 occurs 2 times"):
        ranking.scan_documents(docs.union(docs.where("doc_id = 1")), query)


@pytest.mark.parametrize("small_rows", [None, 1])
def test_repeated_ids_in_a_scan_of_many_terms(spark, docs, monkeypatch, small_rows):
    from lexispark import scale

    monkeypatch.setattr(scale, "LITERAL_TERMS", 0)
    if small_rows:
        monkeypatch.setattr(scale, "SMALL_ROWS", small_rows)
    query = ranking.QueryTerms.of(query_table(spark, "red fox"))
    assert query.terms is None
    with pytest.raises(ValueError, match="document id 1 occurs 2 times"):
        ranking.scan_documents(docs.union(docs.where("doc_id = 1")), query)


def test_written_tables_can_be_removed(spark, docs, monkeypatch):
    from lexispark import scale

    monkeypatch.setattr(scale, "_materialized", [])
    frame = scale.materialize(docs, "removable")
    assert frame.count() == 3
    scale.remove_materialized(spark)
    assert scale._materialized == []
    with pytest.raises(Exception):
        frame.count()


def test_text_scoring_reads_matching_lines_only(spark, tokens, docs):
    base = shared_path(spark, "text")
    postings = index.postings(tokens, positions=True)
    index_text.write_lines(
        index_text.positional_lines(index.positional_index(postings)), f"{base}/positional")
    lengths = corpus.doc_lengths(tokens)
    count = lengths.agg(F.count("*").alias("n_docs"))
    rows = index_text.read_positional(spark, f"{base}/positional")
    terms = index_text.read_positional_terms(spark, f"{base}/positional")
    counted = index_text.text_index(rows, count, lengths, terms)
    query = ranking.QueryTerms.of(query_table(spark, "red fox"))
    scanned = ranking.scan_documents(docs, query)
    for scorer in (ranking.tf_idf, ranking.bm25_factored):
        got = scorer(counted, query)
        plan = got._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan text" in line]
        assert 2 <= len(scans) <= 3 and "HashAggregate(keys=[doc_id" not in plan
        assert {tuple(r) for r in got.collect()} == {
            tuple(r) for r in scorer(scanned, query).collect()}
    with pytest.raises(ValueError, match="indexed lengths"):
        ranking.bm25(counted, query)
    with pytest.raises(ValueError, match="count and lengths"):
        ranking.tf_idf(index_text.text_index(rows, terms=terms), query)
