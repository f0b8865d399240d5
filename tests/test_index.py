from lexispark.operators import corpus, index
from lexispark.scale import materialize


def lists(frame, key):
    return {(r[key], r.segment): r.doc_ids for r in frame.collect()}


def test_inverted(tokens):
    assert lists(index.inverted_index(tokens), "term") == {
        ("fox", 0): [1, 3], ("hill", 0): [2, 3], ("ran", 0): [1], ("red", 0): [1, 2]}


def test_inverted_segments_bound_each_list(tokens):
    got = lists(index.inverted_index(tokens, segment_bits=1), "term")
    assert got == {("fox", 0): [1], ("fox", 1): [3], ("hill", 1): [2, 3], ("ran", 0): [1],
                   ("red", 0): [1], ("red", 1): [2]}


def test_biword(tokens):
    assert lists(index.biword_index(tokens), "biword") == {
        ("fox fox", 0): [3], ("fox hill", 0): [3], ("fox ran", 0): [1], ("red fox", 0): [1],
        ("red hill", 0): [2]}


def test_biword_blanks(spark):
    docs = spark.createDataFrame(
        [(1, "-x"), (2, "x -"), (3, "-"), (4, "x"), (5, ""), (6, "x \x0b y")],
        "doc_id bigint, content string")
    got = {tuple(r) for r in corpus.biword_rows(corpus.token_table(docs)).collect()}
    assert got == {(1, "x"), (6, "x"), (6, "y")}


def test_positional(tokens):
    table = materialize(index.postings(tokens, positions=True), "postings")
    for bits in (1, 12):
        rows = [r for r in index.positional_index(table, bits).collect() if r.term == "fox"]
        assert all(r.df == 2 for r in rows)
        docs = {d.doc_id: d.positions for r in rows for d in r.docs}
        assert docs == {1: [2], 3: [1, 2]}
        assert len(rows) == (2 if bits == 1 else 1)


def test_postings_and_statistics(tokens):
    table = index.postings(tokens)
    got = {(r.term, r.doc_id): (r.tf, r.doc_len, r.indexed_len) for r in table.collect()}
    assert got[("fox", 3)] == (2, 3, 3)
    assert len(got) == 7
    assert {(r.term, r.df, r.cf) for r in index.term_stats(table).collect()} == {
        ("fox", 2, 3), ("hill", 2, 2), ("ran", 1, 1), ("red", 2, 2)}
    assert {tuple(r) for r in index.indexed_doc_lengths(table).collect()} == {
        (1, 3), (2, 2), (3, 3)}
    assert index.indexed_doc_count(table).first()[0] == 3
    assert {tuple(r) for r in index.document_frequencies(tokens).collect()} == {
        ("fox", 2), ("hill", 2), ("ran", 1), ("red", 2)}


def test_corpus_statistics(docs, tokens):
    assert corpus.doc_count(docs).first()[0] == 3
    assert {tuple(r) for r in corpus.doc_lengths(tokens).collect()} == {(1, 3), (2, 2), (3, 3)}
    assert corpus.average_length(tokens).first()[0] == 2.0
    assert abs(corpus.average_length(tokens, "real").first()[0] - 8 / 3) < 1e-12
    assert tuple(corpus.corpus_stats(tokens).first()) == (3, 8, 3, 8)


def test_empty_collection(docs):
    empty = corpus.token_table(docs.where("doc_id < 0"))
    assert tuple(corpus.corpus_stats(empty).first()) == (0, 0, 0, 0)
    assert corpus.average_length(empty).first()[0] is None
    assert index.inverted_index(empty).count() == 0


def test_duplicate_ids(docs):
    assert corpus.duplicate_ids(docs).count() == 0
    assert [tuple(r) for r in corpus.duplicate_ids(docs.union(docs.limit(1))).collect()] == [(1, 2)]
