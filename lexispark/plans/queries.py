"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions import normalize as N
from lexispark.operators import boolean, corpus, index, numbering, ranking
from lexispark.operators.query_text import (
    clause_terms,
    query_bag,
    query_table,
    query_words,
    split_operands,
)
from lexispark.plans import inputs
from lexispark.scale import materialize, shared_path
from lexispark.sources import archive_manifest, index_store, index_text, long_lines
from lexispark.sources.archives import read_archives
from lexispark.sources.articles import documents as sound_articles
from lexispark.sources.articles import extract_articles

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

def _joined(column: str, separator: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), separator).alias(column)


def _rounded() -> Column:
    return F.round("score", 6).alias("score")


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def _ranked(scores: DataFrame) -> DataFrame:
    return scores.select("query_id", "doc_id", _rounded())


def _ranked_top(scores: DataFrame) -> DataFrame:
    """Ranked by the scores themselves, then rounded for the comparison."""
    return ranking.top_k(scores, 10).select("query_id", "doc_id", _rounded(), "rank")


# --- sources ---------------------------------------------------------------


@registered
def zip_entries(spark, sf_dir):
    folder = inputs.article_archives(spark, sf_dir)
    entries = read_archives(spark, folder, mode="FAILFAST", split_bytes=256 << 10)
    return entries.select("name", F.decode("content", "UTF-8").alias("content"))


@registered
def zip_entries_truncated(spark, sf_dir):
    """Every archive is cut inside its last entry: the others are all read."""
    folder = inputs.article_archives(spark, sf_dir, truncated=True)
    entries = read_archives(spark, folder, mode="DROPMALFORMED")
    return entries.select("name", F.decode("content", "UTF-8").alias("content"))


@registered
def zip_entries_manifest(spark, sf_dir):
    """Every directory is read once, entries at the places it names."""
    manifest = archive_manifest.read_manifest(spark, inputs.article_archives(spark, sf_dir))
    entries = archive_manifest.read_manifest_entries(manifest, "FAILFAST", 256 << 10)
    return entries.select("name", F.decode("content", "UTF-8").alias("content"))


@registered
def article_documents(spark, sf_dir):
    entries = read_archives(spark, inputs.article_archives(spark, sf_dir))
    return sound_articles(extract_articles(entries)).select("doc_id", "content")


@registered
def article_dates(spark, sf_dir):
    entries = read_archives(spark, inputs.article_archives(spark, sf_dir))
    return corpus.doc_dates(sound_articles(extract_articles(entries))).select(
        "doc_id", F.col("doc_date").cast("string").alias("doc_date")
    )


def _positional_text(spark, sf_dir) -> str:
    path = shared_path(spark, "positional-text")
    postings = materialize(index.local_postings(inputs.tokens(spark, sf_dir)), "postings")
    index_text.write_lines(index_text.positional_lines(index.positional_index(postings)), path)
    return path


def _inverted_text(spark, sf_dir) -> str:
    path = shared_path(spark, "inverted-text")
    inverted = index.inverted_index(inputs.tokens(spark, sf_dir))
    index_text.write_lines(index_text.id_list_lines(inverted), path)
    return path


@registered
def positional_text_scan(spark, sf_dir):
    rows = index_text.read_positional(spark, _positional_text(spark, sf_dir))
    return rows.select("term", "df", "doc_id", "tf", _joined("positions", ","))


@registered
def inverted_text_scan(spark, sf_dir):
    rows = index_text.read_id_lists(spark, _inverted_text(spark, sf_dir))
    return boolean.doc_terms_of(rows)


def _one_line_per_term(lines: DataFrame) -> str:
    path = shared_path(lines.sparkSession, "long-lines")
    index_text.write_lines(lines, path)
    return path


@registered
def positional_text_scan_long_lines(spark, sf_dir):
    """One line per term, however common; lines are read in pieces."""
    postings = materialize(index.local_postings(inputs.tokens(spark, sf_dir)), "postings")
    lists = index.positional_index(postings, segment_bits=62)
    rows = long_lines.read_positional(
        spark, _one_line_per_term(index_text.positional_lines(lists)))
    return rows.select("term", "df", "doc_id", "tf", _joined("positions", ","))


@registered
def inverted_text_scan_long_lines(spark, sf_dir):
    lists = index.inverted_index(inputs.tokens(spark, sf_dir), segment_bits=62)
    return long_lines.read_id_rows(
        spark, _one_line_per_term(index_text.id_list_lines(lists))).select("doc_id", "term")


@registered
def doc_count_file(spark, sf_dir):
    path = shared_path(spark, "numdocs")
    index_text.write_doc_count(corpus.doc_count(inputs.documents(spark, sf_dir)), path)
    return index_text.read_doc_count(spark, path)


@registered
def doc_lengths_file(spark, sf_dir):
    path = shared_path(spark, "doc-lengths")
    index_text.write_doc_lengths(corpus.doc_lengths(inputs.tokens(spark, sf_dir)), path)
    return index_text.read_doc_lengths(spark, path)


# --- normalizer steps ------------------------------------------------------


def _step(spark, sf_dir, *steps) -> DataFrame:
    text = F.col("content")
    for step in steps:
        text = step(text)
    return inputs.documents(spark, sf_dir).select("doc_id", text.alias("text"))


@registered
def strip_punctuation(spark, sf_dir):
    return _step(spark, sf_dir, N.strip_punctuation)


@registered
def strip_digit_tails(spark, sf_dir):
    return _step(spark, sf_dir, N.strip_digits)


@registered
def lowercase(spark, sf_dir):
    return _step(spark, sf_dir, N.lowercase)


@registered
def remove_stop_words(spark, sf_dir):
    return _step(spark, sf_dir, N.lowercase, N.remove_stop_words)


@registered
def hyphens_to_spaces(spark, sf_dir):
    return _step(spark, sf_dir, N.hyphens_to_spaces)


@registered
def collapse_separators(spark, sf_dir):
    return _step(spark, sf_dir, N.strip_punctuation, N.collapse_separators)


@registered
def normalized_text(spark, sf_dir):
    """The whole chain, with the final trim."""
    return corpus.normalized(inputs.documents(spark, sf_dir))


@registered
def split_tokens(spark, sf_dir):
    return corpus.tokenized(inputs.documents(spark, sf_dir)).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens")
    )


@registered
def nonblank_tokens(spark, sf_dir):
    words = F.array_remove("tokens", "")
    return inputs.tokens(spark, sf_dir).select(
        "doc_id", F.size(words).alias("n_tokens"), F.array_join(words, "|").alias("tokens")
    )


@registered
def query_tokens(spark, sf_dir):
    return query_words(inputs.benchmark_queries(spark, sf_dir))


@registered
def boolean_operands(spark, sf_dir):
    """Neighboring benchmark texts made into AND and OR queries, and split."""
    texts = inputs.benchmark_queries(spark, sf_dir)
    operator = F.when(F.col("query_id") % 2 == 0, " AND ").otherwise(" OR ")
    queries = texts.select(
        "query_id", F.concat("text", operator, F.reverse("text")).alias("text")
    )
    return split_operands(queries)


@registered
def same_term(spark, sf_dir):
    rows = corpus.position_rows(inputs.tokens(spark, sf_dir))
    padded = F.concat(F.lit(" "), F.upper("term"), F.lit("\t"))
    return rows.where(N.same_term(padded, F.lit("Leon "))).select("doc_id", "pos", "term")


# --- generators ------------------------------------------------------------


@registered
def term_explode(spark, sf_dir):
    return corpus.term_rows(inputs.tokens(spark, sf_dir))


@registered
def positional_explode(spark, sf_dir):
    return corpus.position_rows(inputs.tokens(spark, sf_dir))


@registered
def bigram_explode(spark, sf_dir):
    return corpus.biword_rows(inputs.tokens(spark, sf_dir))


@registered
def posting_frequencies(spark, sf_dir):
    return index.postings(inputs.tokens(spark, sf_dir)).select("term", "doc_id", "tf")


@registered
def query_bags(spark, sf_dir):
    return query_bag(inputs.benchmark_queries(spark, sf_dir))


# --- filters and joins -----------------------------------------------------


def _search(spark, sf_dir, queries: DataFrame):
    query = ranking.QueryTerms.of(queries)
    return ranking.scan_documents(inputs.documents(spark, sf_dir), query), query


@registered
def term_filter(spark, sf_dir):
    """Postings of the query terms only."""
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    wanted = query.bag.hinted().select("term")
    return search.postings.join(wanted, "term", "left_semi").select("term", "doc_id", "tf")


@registered
def term_match(spark, sf_dir):
    inverted = index.inverted_index(inputs.tokens(spark, sf_dir))
    return boolean.match_words(inverted, inputs.rank_queries(spark)).select(
        "query_id", "pos", "term", _joined("doc_ids", " ")
    )


@registered
def term_lookup(spark, sf_dir):
    inverted = index.inverted_index(inputs.tokens(spark, sf_dir))
    return boolean.lookup(inverted, "Leon").select("term", _joined("doc_ids", " "))


@registered
def doc_length_join(spark, sf_dir):
    """Postings read from index text, with lengths read from a length file."""
    tokens = materialize(inputs.tokens(spark, sf_dir), "tokens")
    path = shared_path(spark, "doc-lengths")
    index_text.write_doc_lengths(corpus.doc_lengths(tokens), path)
    postings = index.postings(tokens, partitions=index.token_partitions(tokens)).select(
        "term", "doc_id", "tf")
    return index_text.attach_doc_lengths(
        postings, index_text.read_doc_lengths(spark, path)
    ).select("term", "doc_id", "tf", "doc_len")


@registered
def corpus_scalar_join(spark, sf_dir):
    """Matched postings with the document count and average length."""
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    weights = ranking.query_weights(search, query)
    stats = F.col("stats")
    return search.postings.join(weights.select("query_id", "term", "stats"), "term").select(
        "query_id",
        "term",
        "doc_id",
        stats["n_docs"].alias("n_docs"),
        F.floor(stats["total_len"] / stats["n_docs"]).alias("average_length"),
    )


@registered
def query_weight_join(spark, sf_dir):
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    return search.postings.join(query.bag.hinted(), "term").select(
        "query_id", "term", "doc_id", "tf", "qtf"
    )


# --- indexes and aggregates ------------------------------------------------


@registered
def inverted_index(spark, sf_dir):
    return index.inverted_index(inputs.tokens(spark, sf_dir)).select("term", "segment", _joined("doc_ids", " "))


@registered
def inverted_index_segments(spark, sf_dir):
    """The same in segments of 256 ids, as common terms have at scale."""
    return index.inverted_index(inputs.tokens(spark, sf_dir), segment_bits=8).select(
        "term", "segment", _joined("doc_ids", " ")
    )


@registered
def inverted_index_sparse_ids(spark, sf_dir):
    """Documents under ids that are far apart: lists by dense number, 256 documents each."""
    docs = inputs.documents(spark, sf_dir).withColumn("doc_id", F.expr(inputs.SPARSE_ID))
    tokens = numbering.numbered(docs, corpus.token_table)
    return index.inverted_index(tokens, segment_bits=8).select(
        "term", "segment", _joined("doc_ids", " ")
    )


@registered
def biword_index_sparse_ids(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).withColumn("doc_id", F.expr(inputs.SPARSE_ID))
    tokens = numbering.numbered(docs, corpus.token_table)
    return index.biword_index(tokens, segment_bits=8).select(
        "biword", "segment", _joined("doc_ids", " ")
    )


@registered
def biword_index(spark, sf_dir):
    return index.biword_index(inputs.tokens(spark, sf_dir)).select("biword", "segment", _joined("doc_ids", " "))


@registered
def positional_postings(spark, sf_dir):
    """The flat positional index: positions per term and document."""
    return index.postings(inputs.tokens(spark, sf_dir), positions=True).select(
        "term", "doc_id", "tf", _joined("positions", ",")
    )


@registered
def positional_index(spark, sf_dir):
    """List form with document frequencies, in segments of 256 ids."""
    postings = materialize(index.local_postings(inputs.tokens(spark, sf_dir)), "postings")
    lists = index.positional_index(postings, segment_bits=8)
    return lists.select("term", "segment", "df", index_text.positional_docs_text().alias("docs"))


@registered
def collection_frequency(spark, sf_dir):
    tokens = inputs.tokens(spark, sf_dir)
    return corpus.term_rows(tokens).groupBy("term").agg(F.count("*").alias("cf"))


@registered
def document_count(spark, sf_dir):
    return corpus.doc_count(inputs.documents(spark, sf_dir))


@registered
def document_lengths(spark, sf_dir):
    return corpus.doc_lengths(inputs.tokens(spark, sf_dir))


@registered
def average_length_integer(spark, sf_dir):
    return corpus.average_length(inputs.tokens(spark, sf_dir))


@registered
def average_length_real(spark, sf_dir):
    return corpus.average_length(inputs.tokens(spark, sf_dir), "real").select(
        F.round("average_length", 6).alias("average_length")
    )


@registered
def indexed_lengths(spark, sf_dir):
    """Document length as the sum of term frequencies."""
    return index.indexed_doc_lengths(index.postings(inputs.tokens(spark, sf_dir)))


@registered
def indexed_document_count(spark, sf_dir):
    return index.indexed_doc_count(corpus.distinct_term_rows(inputs.tokens(spark, sf_dir)))


@registered
def indexed_average_length(spark, sf_dir):
    stats = corpus.corpus_stats(inputs.tokens(spark, sf_dir))
    return stats.select(
        F.round(F.try_divide("total_indexed_len", "n_indexed"), 6).alias("average_length")
    )


@registered
def total_term_frequency(spark, sf_dir):
    return index.term_stats(index.postings(inputs.tokens(spark, sf_dir))).select("term", "cf")


@registered
def document_frequency(spark, sf_dir):
    return index.document_frequencies(inputs.tokens(spark, sf_dir))


@registered
def score_sum(spark, sf_dir):
    """Sums of tf * qtf per query and document."""
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    matched = search.postings.join(query.bag.hinted(), "term")
    return matched.groupBy("query_id", "doc_id").agg(
        F.sum(F.col("tf") * F.col("qtf")).alias("score")
    )


@registered
def idf_sum(spark, sf_dir):
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    weights = ranking.query_weights(search, query).select(
        "query_id",
        ranking.ratio_idf(F.col("stats.n_docs"), F.col("df")).alias("idf"),
    )
    return ranking.idf_sums(weights).select("query_id", F.round("sum_idf", 6).alias("sum_idf"))


# --- boolean retrieval -----------------------------------------------------


@registered
def boolean_and(spark, sf_dir):
    rows = corpus.distinct_term_rows(inputs.tokens(spark, sf_dir))
    return boolean.all_of(rows, ["this", "tion"])


@registered
def boolean_or(spark, sf_dir):
    rows = corpus.distinct_term_rows(inputs.tokens(spark, sf_dir))
    return boolean.any_of(rows, ["leon", "tion"])


@registered
def boolean_search(spark, sf_dir):
    return boolean.boolean_search(
        inputs.tokens(spark, sf_dir), query_table(spark, inputs.BOOLEAN_QUERIES)
    )


@registered
def phrase_search(spark, sf_dir):
    return boolean.phrase_search(
        inputs.tokens(spark, sf_dir), query_table(spark, inputs.PHRASE_QUERIES)
    )


@registered
def phrase_search_long(spark, sf_dir):
    """Phrases of three words and more, next to each other in the text."""
    return boolean.phrase_search(
        inputs.tokens(spark, sf_dir), query_table(spark, inputs.LONG_PHRASE_QUERIES)
    )


@registered
def boolean_search_text_index(spark, sf_dir):
    """Boolean search over an inverted index read from text."""
    rows = index_text.read_id_lists(spark, _inverted_text(spark, sf_dir))
    queries = query_table(spark, inputs.BOOLEAN_QUERIES)
    return boolean.evaluate(boolean.doc_terms_of(rows), clause_terms(queries))


@registered
def result_counts(spark, sf_dir):
    """How many hits each query has, those without any included."""
    return boolean.hit_counts(
        boolean_search(spark, sf_dir), query_table(spark, inputs.BOOLEAN_QUERIES)
    )


@registered
def no_results(spark, sf_dir):
    """No hits is an empty result, without a placeholder row."""
    search, query = _search(spark, sf_dir, query_table(spark, "zzzabsent zzznone"))
    return _ranked(ranking.bm25(search, query))


# --- ranking ---------------------------------------------------------------


@registered
def tf_idf(spark, sf_dir):
    return _ranked(ranking.tf_idf(*_search(spark, sf_dir, inputs.rank_queries(spark))))


@registered
def tf_idf_real(spark, sf_dir):
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    return _ranked(ranking.tf_idf(search, query, arithmetic="real"))


@registered
def bm25_factored(spark, sf_dir):
    return _ranked(ranking.bm25_factored(*_search(spark, sf_dir, inputs.rank_queries(spark))))


@registered
def bm25_factored_real(spark, sf_dir):
    search, query = _search(spark, sf_dir, inputs.rank_queries(spark))
    return _ranked(ranking.bm25_factored(search, query, arithmetic="real"))


@registered
def bm25(spark, sf_dir):
    return _ranked(ranking.bm25(*_search(spark, sf_dir, inputs.rank_queries(spark))))


@registered
def bm25_top10(spark, sf_dir):
    """One query given as text, its ten best documents."""
    scores = ranking.bm25(*_search(spark, sf_dir, query_table(spark, inputs.ONE_QUERY)))
    return _ranked_top(scores)


@registered
def bm25_top10_batch(spark, sf_dir):
    """Each benchmark text as a query, ten best documents each."""
    scores = ranking.bm25(*_search(spark, sf_dir, inputs.benchmark_queries(spark, sf_dir)))
    return _ranked_top(scores)


@registered
def results_in_key_order(spark, sf_dir):
    return ranking.in_key_order(tf_idf(spark, sf_dir))


def _stored_index(spark, sf_dir, **parts) -> index_store.StoredIndex:
    path = shared_path(spark, "index")
    index_store.build_index(inputs.documents(spark, sf_dir), path, **parts)
    return index_store.read_index(spark, path)


@registered
def bm25_stored_index(spark, sf_dir):
    """Build the stored index, then search it."""
    query = ranking.QueryTerms.of(inputs.rank_queries(spark))
    return _ranked(ranking.bm25(_stored_index(spark, sf_dir), query))


def _top_of_blocks(found: DataFrame) -> DataFrame:
    return found.select("query_id", "doc_id", _rounded(), "rank")


@registered
def bm25_top10_block_max(spark, sf_dir):
    """One query on a stored index, blocks out of reach unopened."""
    query = ranking.QueryTerms.of(query_table(spark, inputs.ONE_QUERY))
    return _top_of_blocks(_stored_index(spark, sf_dir, block_max=True).top_k(query))


@registered
def bm25_top10_batch_block_max(spark, sf_dir):
    """Each benchmark text as a query, the same way."""
    query = ranking.QueryTerms.of(inputs.benchmark_queries(spark, sf_dir))
    return _top_of_blocks(_stored_index(spark, sf_dir, block_max=True).top_k(query))


@registered
def boolean_search_bitmaps(spark, sf_dir):
    """AND and OR on one row per term and segment."""
    return _stored_index(spark, sf_dir, segments=True).bitmap_search(
        query_table(spark, inputs.BOOLEAN_QUERIES)
    )


@registered
def boolean_search_stored_index(spark, sf_dir):
    return _stored_index(spark, sf_dir).boolean_search(
        query_table(spark, inputs.BOOLEAN_QUERIES)
    )


@registered
def phrase_search_stored_index(spark, sf_dir):
    return _stored_index(spark, sf_dir, biwords=True).phrase_search(
        query_table(spark, inputs.PHRASE_QUERIES)
    )


@registered
def phrase_search_long_stored_index(spark, sf_dir):
    """The same from the positions of a stored index."""
    return _stored_index(spark, sf_dir, biwords=True).phrase_search(
        query_table(spark, inputs.LONG_PHRASE_QUERIES)
    )


def _text_index(spark, sf_dir) -> ranking.Searchable:
    """Index, document count and lengths, all written to and read from text."""
    tokens = materialize(inputs.tokens(spark, sf_dir), "tokens")
    postings = materialize(index.local_postings(tokens), "postings")
    base = shared_path(spark, "text-index")
    lines = index_text.positional_lines(index.positional_index(postings))
    index_text.write_lines(lines, f"{base}/positional")
    index_text.write_doc_count(corpus.doc_count(tokens), f"{base}/numdocs")
    index_text.write_doc_lengths(corpus.doc_lengths(tokens), f"{base}/lengths")
    return index_text.text_index(
        index_text.read_positional(spark, f"{base}/positional"),
        index_text.read_doc_count(spark, f"{base}/numdocs"),
        index_text.read_doc_lengths(spark, f"{base}/lengths"),
        index_text.read_positional_terms(spark, f"{base}/positional"),
    )


@registered
def tf_idf_text_index(spark, sf_dir):
    query = ranking.QueryTerms.of(inputs.rank_queries(spark))
    return _ranked(ranking.tf_idf(_text_index(spark, sf_dir), query))


@registered
def bm25_factored_text_index(spark, sf_dir):
    query = ranking.QueryTerms.of(inputs.rank_queries(spark))
    return _ranked(ranking.bm25_factored(_text_index(spark, sf_dir), query))


@registered
def bm25_text_index(spark, sf_dir):
    """Classic BM25 from a positional text index alone."""
    path = _positional_text(spark, sf_dir)
    search = index_text.text_index(
        index_text.read_positional(spark, path),
        terms=index_text.read_positional_terms(spark, path),
    )
    query = ranking.QueryTerms.of(inputs.rank_queries(spark))
    return _ranked(ranking.bm25(search, query))


# --- sinks -----------------------------------------------------------------


@registered
def inverted_index_text(spark, sf_dir):
    return spark.read.text(_inverted_text(spark, sf_dir))


@registered
def biword_index_text(spark, sf_dir):
    path = shared_path(spark, "biword-text")
    biwords = index.biword_index(inputs.tokens(spark, sf_dir))
    index_text.write_lines(index_text.id_list_lines(biwords, "biword"), path)
    return spark.read.text(path)


@registered
def positional_index_text(spark, sf_dir):
    return spark.read.text(_positional_text(spark, sf_dir))


@registered
def search_results_text(spark, sf_dir):
    path = shared_path(spark, "search-results")
    search, query = _search(spark, sf_dir, query_table(spark, inputs.ONE_QUERY))
    index_text.write_lines(index_text.result_lines(ranking.tf_idf(search, query)), path)
    parts = F.split("value", "\t")
    return spark.read.text(path).select(
        parts[0].cast("bigint").alias("doc_id"),
        F.round(parts[1].cast("double"), 6).alias("score"),
    )


@registered
def replaced_output(spark, sf_dir):
    """A second write to a folder leaves nothing of the first."""
    path = shared_path(spark, "replaced")
    # Written once: a filter on a length would repeat the normalizer for it.
    lengths = materialize(corpus.doc_lengths(inputs.tokens(spark, sf_dir)), "lengths")
    index_text.write_doc_lengths(lengths, path)
    index_text.write_doc_lengths(lengths.where("doc_len > 100"), path)
    return index_text.read_doc_lengths(spark, path)
