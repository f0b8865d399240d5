"""Boolean AND/OR retrieval over terms and over two-word phrases.

Matching counts rows per document; posting lists are never intersected whole,
so a term found in a third of all documents is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions.normalize import same_term
from lexispark.operators import corpus
from lexispark.operators.query_text import clause_terms, query_words
from lexispark.scale import Sized, check_size, in_list


def evaluate(doc_terms: DataFrame, clauses: DataFrame | Sized) -> DataFrame:
    """``(query_id, doc_id)`` of documents that meet any clause of a query.

    ``doc_terms`` is ``(doc_id, term)``. The three aggregations below all group
    by ``doc_id`` and more, so one shuffle on it serves them all. A term no
    document has leaves its clause short, hence unmet.
    """
    sized = clauses if isinstance(clauses, Sized) else check_size(clauses, "term")
    terms = sized.literal()
    if terms is not None:
        doc_terms = doc_terms.where(in_list("term", terms))
    return (
        doc_terms.select("doc_id", "term")
        .join(sized.hinted(), "term")
        .repartition("doc_id")
        .distinct()
        .groupBy("query_id", "clause", "n_terms", "doc_id")
        .agg(F.count("*").alias("n_met"))
        .where(F.col("n_met") == F.col("n_terms"))
        .select("query_id", "doc_id")
        .distinct()
    )


def boolean_search(tokens: DataFrame, queries: DataFrame) -> DataFrame:
    """Words and AND need all terms, OR any of its sides; over single terms. Only
    the wanted terms of a document become rows."""
    clauses = check_size(clause_terms(queries), "term")
    return evaluate(corpus.distinct_term_rows(tokens, clauses.literal()), clauses)


def phrase_search(tokens: DataFrame, queries: DataFrame) -> DataFrame:
    """The same over phrases: a document meets one if it has its words side by side, in
    order. Runs are formed and filtered inside the row, only of the lengths asked for, and
    all lengths in one pass: a union would normalize the texts once for each."""
    clauses = check_size(clause_terms(queries, phrases=True), "term")
    found = corpus.distinct_run_rows(tokens, phrase_lengths(clauses.df), clauses.literal())
    return evaluate(found.withColumnRenamed("phrase", "term"), clauses)


def phrase_lengths(clauses: DataFrame) -> list[int]:
    """The distinct numbers of words of phrases of more than two."""
    n_words = F.size(F.split("term", " "))
    rows = clauses.select(n_words.alias("n")).where("n > 2").distinct().collect()
    return sorted(row.n for row in rows)


def long_phrase_rows(postings: DataFrame, clauses: DataFrame) -> DataFrame:
    """``(doc_id, term)``, the terms being the phrases of more than two words among those of
    ``clauses`` that the document holds.

    Each position of a word, less the word's place in the phrase, says where the phrase
    would start; it starts where all of its words say so. Blank tokens have
    positions, so words around one are not neighbors. Documents that lack a word of a phrase
    are left out before positions become rows, and those of a document stay with it.
    """
    long = clauses.select(F.col("term").alias("phrase")).distinct().select(
        "phrase", F.split("phrase", " ").alias("words")).where(F.size("words") > 2)
    words = long.select(
        "phrase", F.size("words").alias("n_words"),
        F.posexplode("words").alias("place", "term"))
    sized = check_size(words, "phrase")
    met = postings.select("term", "doc_id", "positions").join(sized.hinted(), "term")
    starts = F.transform(
        "positions", lambda position: (position - F.col("place")).cast("int"))
    per_document = met.groupBy("doc_id", "phrase").agg(
        F.first("n_words").alias("n_words"),
        F.collect_list(F.struct("place", starts.alias("starts"))).alias("found"))
    common = F.reduce(
        F.slice("found", F.lit(2), F.col("n_words")), F.get("found", F.lit(0))["starts"],
        lambda left, one: F.array_intersect(left, one["starts"]))
    return per_document.where(
        (F.size("found") == F.col("n_words")) & (F.size(common) > 0)).select(
        "doc_id", F.col("phrase").alias("term"))


def search_index(
    narrowed: Callable[[list[str] | None, DataFrame], DataFrame], queries: DataFrame
) -> DataFrame:
    """Boolean search over a stored index: ``narrowed`` gives its ``(doc_id,
    term)`` rows for a list of terms, or for a frame of them if they are too many
    for a list, so that only those are read."""
    clauses = check_size(clause_terms(queries), "term")
    return evaluate(narrowed(clauses.literal(), clauses.df), clauses)


def all_of(doc_terms: DataFrame, terms: list[str]) -> DataFrame:
    """Documents that have every one of ``terms``."""
    wanted = set(terms)
    return (
        doc_terms.where(in_list("term", sorted(wanted)))
        .groupBy("doc_id")
        .agg(F.count_distinct("term").alias("n_met"))
        .where(F.col("n_met") == len(wanted))
        .select("doc_id")
    )


def any_of(doc_terms: DataFrame, terms: list[str]) -> DataFrame:
    """Documents that have at least one of ``terms``, each once."""
    return doc_terms.where(in_list("term", sorted(set(terms)))).select("doc_id").distinct()


def match_words(inverted: DataFrame, queries: DataFrame) -> DataFrame:
    """Index lists of each query word, one copy per occurrence of the word:
    ``(query_id, pos, term, segment, doc_ids)``, case ignored."""
    words = check_size(query_words(queries).withColumnRenamed("term", "word"), "word")
    return inverted.join(
        words.hinted(), same_term(F.col("term"), F.col("word"))
    ).select("query_id", "pos", "term", "segment", "doc_ids")


def lookup(inverted: DataFrame, word: str) -> DataFrame:
    """The lists of exactly this word, lowercased and trimmed."""
    return inverted.where(same_term(F.col("term"), F.lit(word)))


def doc_terms_of(inverted: DataFrame, key: str = "term") -> DataFrame:
    """``(doc_id, term)`` rows of an inverted or biword index."""
    return inverted.select(
        F.explode_outer("doc_ids").alias("doc_id"), F.col(key).alias("term")
    )


def hit_counts(results: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """``(query_id, n_hits)``; zero for those of ``queries`` without a hit."""
    counts = results.groupBy("query_id").agg(F.count("*").alias("n_hits"))
    if queries is None:
        return counts
    return queries.select("query_id").distinct().join(counts, "query_id", "left").select(
        "query_id", F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits")
    )


def print_results(results: DataFrame, rows: int | None = None) -> None:
    """Print how many results there are, then all in id order, or the first ``rows``.
    They are fetched partition by partition."""
    print(f"Number of results found: {results.count()}")
    ordered = results.orderBy("query_id", "doc_id")
    for row in (ordered if rows is None else ordered.limit(rows)).toLocalIterator():
        print(*row, sep="\t")
