"""TF-IDF and two BM25 forms over postings, for any number of queries at once.

The work per query term (idf, query counts, collection averages) is done on
the small query table, which then meets the postings in one join. Scores are
summed per (query, document) with partial sums before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators import corpus, index
from lexispark.operators.query_text import query_bag
from lexispark.scale import Sized, check_size, in_list, materialize

# The parameters of both BM25 forms.
BM25_K = 2.0
BM25_B = 0.75

# Where Spark keeps no rank limit of this size in its map tasks (its
# WindowGroupLimit), ranks are first cut per slice of documents.
RANK_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"
RANK_SLICES = 64
# Scores are ranked to so many decimals: the order in which a sum of doubles was
# taken then does not decide between equal documents.
RANK_DECIMALS = 12

ARITHMETICS = ("integer", "real")


@dataclass(frozen=True)
class Searchable:
    """What the scorers read.

    ``postings``: (term, doc_id, tf, doc_len, indexed_len)
    ``terms``: (term, df)
    ``corpus``: one row (n_docs, total_len, n_indexed, total_indexed_len)
    """

    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame
    only: tuple[str, ...] | None = None  # the terms it was made for, if not all
    has_counts: bool = True  # n_docs, total_len and doc_len are there
    has_indexed: bool = True  # n_indexed, total_indexed_len and indexed_len are there

    def require(self, counts: bool) -> None:
        if counts and not self.has_counts:
            raise ValueError("this index was made without document count and lengths")
        if not counts and not self.has_indexed:
            raise ValueError("this index was made without indexed lengths")

    def narrowed(
        self, terms: list[str] | None, wanted: DataFrame | None = None
    ) -> Searchable:
        """Only the rows of ``terms``; a literal list reaches the file scan. Where
        there is no list, an index may use ``wanted``, a frame of terms."""
        if terms is None or self.only == tuple(terms):
            return self
        wanted = in_list("term", terms)
        return replace(
            self,
            postings=self.postings.where(wanted),
            terms=self.terms.where(wanted),
            only=tuple(terms),
        )


@dataclass(frozen=True)
class QueryTerms:
    """A bag of query words after its size check."""

    bag: Sized

    @staticmethod
    def of(queries: DataFrame, digits: str = "line") -> QueryTerms:
        return QueryTerms(check_size(query_bag(queries, digits), "term"))

    @property
    def terms(self) -> list[str] | None:
        """The distinct terms, if few enough for a literal list."""
        return self.bag.literal()


def searchable(tokens: DataFrame, query: QueryTerms | None = None) -> Searchable:
    """Read a token table as an index, or only what ``query`` needs of it. It is
    read several times, so pass a written one."""
    only = None if query is None else query.bag.hinted().select("term")
    return Searchable(
        index.postings(tokens, only=only),
        index.document_frequencies(tokens, only=only),
        corpus.corpus_stats(tokens),
    )


def scan_documents(docs: DataFrame, query: QueryTerms, digits: str = "line") -> Searchable:
    """Make ``docs`` searchable for these queries without building an index.

    One pass normalizes the texts and writes, per document, its lengths and
    the query terms in it. Statistics, frequencies and postings are then read
    from that small table. Query terms are found by a literal list, or by a join
    if there are too many for one. Repeated ids among matching documents are an
    error, as they are in an index.
    """
    terms = query.terms
    if terms is None:
        tokens = corpus.matched_tokens(corpus.token_table(docs, digits=digits), query.bag)
    else:
        tokens = corpus.token_table(docs, keep_terms=terms, digits=digits)
    tokens = materialize(tokens, "matched-tokens")
    corpus.check_unique(tokens.where(F.size("tokens") > 0))
    return replace(searchable(tokens), only=None if terms is None else tuple(terms))


def _corpus_column(stats: DataFrame) -> Column:
    """The one-row collection statistics as a scalar subquery."""
    return stats.select(F.struct(*stats.columns)).scalar()


def _check_arithmetic(arithmetic: str) -> None:
    if arithmetic not in ARITHMETICS:
        raise ValueError(f"arithmetic must be one of {ARITHMETICS}, not {arithmetic!r}")


def ratio_idf(n_docs: Column, df: Column, arithmetic: str = "integer") -> Column:
    """``log10(N / df)``; ``integer`` drops the quotient's fraction first, which
    gives zero to every term found in more than half of the documents.
    Statistics that do not belong to the index (df > N) are an error."""
    _check_arithmetic(arithmetic)
    quotient = n_docs.cast("double") / df
    if arithmetic == "integer":
        quotient = F.floor(quotient).cast("double")
    return F.when(
        df > n_docs, F.raise_error(F.lit("document frequency exceeds document count"))
    ).otherwise(F.log10(quotient))


def odds_idf(n_docs: Column, df: Column) -> Column:
    """``log10((N - df + 0.5) / (df + 0.5))``, negative for common terms."""
    return F.log10((n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, doc_len: Column, average_length: Column) -> Column:
    """BM25's damped term frequency."""
    relative = doc_len / average_length
    return (BM25_K + 1) * tf / (BM25_K * ((1 - BM25_B) + BM25_B * relative) + tf)


def query_weights(search: Searchable, query: QueryTerms) -> DataFrame:
    """``(query_id, term, qtf, df, stats)`` of the query terms the index has."""
    return (
        search.terms.select("term", "df")
        .join(query.bag.hinted(), "term")
        .withColumn("stats", _corpus_column(search.corpus))
    )


def _matched(search: Searchable, weights: DataFrame, query: QueryTerms) -> DataFrame:
    # Weights have at most the bag's rows, so its size check holds for them.
    return search.postings.join(F.broadcast(weights) if query.bag.small else weights, "term")


def _summed(rows: DataFrame, contribution: Column, *others: Column) -> DataFrame:
    return rows.groupBy("query_id", "doc_id").agg(F.sum(contribution).alias("score"), *others)


def tf_idf(search: Searchable, query: QueryTerms, arithmetic: str = "integer") -> DataFrame:
    """``(query_id, doc_id, score)``: products of document and query weights,
    summed and divided by document length. Zero scores are kept."""
    search.require(counts=True)
    search = search.narrowed(query.terms, query.bag.df)
    idf = ratio_idf(F.col("stats.n_docs"), F.col("df"), arithmetic)
    weights = query_weights(search, query).select(
        "query_id", "term", (F.pow(idf, F.lit(2.0)) * F.col("qtf")).alias("weight")
    )
    scores = _summed(
        _matched(search, weights, query),
        F.col("weight") * F.col("tf"),
        F.max("doc_len").alias("doc_len"),
    )
    return scores.select(
        "query_id", "doc_id", (F.col("score") / F.col("doc_len")).alias("score")
    )


def classic_weights(search: Searchable, query: QueryTerms) -> DataFrame:
    """``(query_id, term, weight, average_length)`` of classic BM25."""
    return query_weights(search, query).select(
        "query_id",
        "term",
        (odds_idf(F.col("stats.n_indexed"), F.col("df")) * F.col("qtf")).alias("weight"),
        (F.col("stats.total_indexed_len") / F.col("stats.n_indexed")).alias("average_length"),
    )


def bm25(search: Searchable, query: QueryTerms) -> DataFrame:
    """Classic BM25: the sum of saturation times odds idf. Repeated query words
    count again; lengths and counts are those of indexed tokens."""
    search.require(counts=False)
    search = search.narrowed(query.terms, query.bag.df)
    weights = classic_weights(search, query)
    return _summed(
        _matched(search, weights, query),
        saturation(F.col("tf"), F.col("indexed_len"), F.col("average_length"))
        * F.col("weight"),
    )


def bm25_factored(
    search: Searchable, query: QueryTerms, arithmetic: str = "integer"
) -> DataFrame:
    """The factored form: summed saturation times the summed idf of the query
    terms found anywhere. Query words count once; lengths include blanks."""
    search.require(counts=True)
    search = search.narrowed(query.terms, query.bag.df)
    stats = F.col("stats")
    average = stats["total_len"] / stats["n_docs"]
    if arithmetic == "integer":
        average = F.floor(average).cast("double")
    weights = query_weights(search, query).select(
        "query_id",
        "term",
        ratio_idf(stats["n_docs"], F.col("df"), arithmetic).alias("idf"),
        average.alias("average_length"),
    )
    # A window: a join with idf_sums would compute the weights a second time.
    total = F.sum("idf").over(Window.partitionBy("query_id")).alias("sum_idf")
    weights = weights.select("query_id", "term", "average_length", total)
    rows = _matched(search, weights, query)
    scores = _summed(
        rows,
        saturation(F.col("tf"), F.col("doc_len"), F.col("average_length")),
        F.max("sum_idf").alias("sum_idf"),
    )
    return scores.select(
        "query_id", "doc_id", (F.col("score") * F.col("sum_idf")).alias("score")
    )


def idf_sums(weights: DataFrame) -> DataFrame:
    """``(query_id, sum_idf)`` over a query's distinct matched terms."""
    return weights.groupBy("query_id").agg(F.sum("idf").alias("sum_idf"))


def top_k(scores: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each query; ties go to the lower id.

    Spark cuts each map task's rows to ``k`` per query before the shuffle, so
    a query matching a third of all documents sends only a few. Beyond the
    bound of that rule the cut is made per slice of documents first.
    """
    best_first = [F.round("score", RANK_DECIMALS).desc(), F.col("doc_id")]

    def cut(rows: DataFrame, *keys: Column | str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))
        return rows.withColumn("rank", rank).where(F.col("rank") <= k)

    if k > int(scores.sparkSession.conf.get(RANK_LIMIT_SETTING)):
        slices = F.pmod(F.xxhash64("doc_id"), F.lit(RANK_SLICES))
        scores = cut(scores, "query_id", slices).drop("rank")
    return cut(scores, "query_id")


def in_key_order(scores: DataFrame) -> DataFrame:
    """Results ordered by document id as a string, per query."""
    return scores.orderBy("query_id", F.col("doc_id").cast("string"))
