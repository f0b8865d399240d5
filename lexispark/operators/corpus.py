"""Documents to tokens, and the statistics of a document collection.

Documents are ``(doc_id BIGINT, content STRING)`` with unique ids, optionally
with ``doc_date``. All steps work row by row, so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions import normalize as N
from lexispark.scale import BitSet, Sized, in_list


def normalized(docs: DataFrame, digits: str = "line", text: str = "content") -> DataFrame:
    """``docs`` with ``text`` replaced by ``normalized``, tokens joined by ``::``."""
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, N.normalize(F.col(text), digits).alias("normalized"))


def tokenized(docs: DataFrame, digits: str = "line", text: str = "content") -> DataFrame:
    """``docs`` with ``text`` replaced by its ``tokens`` array, blanks included.

    Each step is its own projection: later steps use a column more than once,
    and a single projection would repeat the chain for each use.
    """
    kept = [c for c in docs.columns if c != text]
    return (
        normalized(docs, digits, text)
        .select(*kept, N.clean_tokens(F.col("normalized")).alias("cleaned"))
        .select(*kept, N.split_tokens(F.col("cleaned")).alias("tokens"))
    )


def token_table(
    docs: DataFrame, keep_terms: Sequence[str] | None = None, digits: str = "line"
) -> DataFrame:
    """One row per document: both of its lengths and its tokens.

    ``doc_len`` counts all tokens, ``indexed_len`` the non-blank ones. With
    ``keep_terms`` only those terms stay in ``tokens`` (the lengths are those
    of the whole text), which makes the table small enough to write and reuse
    for a search without an index.
    """
    lengths = tokenized(docs.select("doc_id", "content"), digits).select(
        "doc_id",
        F.size("tokens").alias("doc_len"),
        F.size(F.array_remove("tokens", "")).alias("indexed_len"),
        "tokens",
    )
    if keep_terms is None:
        return lengths
    kept = f"filter(tokens, token -> {in_list('token', keep_terms)})"
    return lengths.withColumn("tokens", F.expr(kept))


def id_columns(rows: DataFrame) -> list[str]:
    """The document's id, and its dense number if it has been given one."""
    return [c for c in ("doc_id", "doc_no") if c in rows.columns]


def term_rows(tokens: DataFrame) -> DataFrame:
    """``(doc_id, term)`` for each non-blank token."""
    return tokens.select("doc_id", F.explode(F.array_remove("tokens", "")).alias("term"))


def _distinct_rows(
    tokens: DataFrame, words: Column, keep: Sequence[str] | None, name: str
) -> DataFrame:
    """``(doc_id, name)`` per distinct element of ``words``, filtered inside the row, so
    that other elements never become rows. The list is built as text, see ``in_list``."""
    ids = id_columns(tokens)
    rows = tokens.select(*ids, words.alias("words"))
    if keep is not None:
        kept = F.expr(f"filter(words, word -> {in_list('word', keep)})")
        rows = rows.select(*ids, kept.alias("words"))
    return rows.select(*ids, F.explode(F.array_distinct("words")).alias(name))


def distinct_term_rows(tokens: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``(doc_id, term)`` once per document, deduplicated inside the row; with
    ``keep`` only those terms."""
    return _distinct_rows(tokens, F.array_remove("tokens", ""), keep, "term")


def position_rows(tokens: DataFrame, *carried: str) -> DataFrame:
    """``(doc_id, pos, term)``; positions start at 1 and count blank tokens,
    which themselves give no row.

    The outer form keeps Catalyst from inferring a size filter on the array
    and pushing the whole normalizer a second time below the scan; the null
    row it adds for an empty array goes with the blanks.
    """
    return (
        tokens.select("doc_id", *carried, F.posexplode_outer("tokens").alias("pos", "term"))
        .where(F.col("term") != "")
        .select("doc_id", *carried, (F.col("pos") + 1).alias("pos"), "term")
    )


def biword_rows(tokens: DataFrame) -> DataFrame:
    """``(doc_id, biword)`` for each pair of neighboring tokens.

    Pairs are formed inside the row by zipping the array with itself moved by
    one, so no window or shuffle is needed. A pair of blanks gives no row; a
    pair with one blank is the other word alone.
    """
    following = F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0)))
    return (
        tokens.select(
            "doc_id",
            F.explode(
                F.arrays_zip(F.col("tokens").alias("first"), following.alias("second"))
            ).alias("pair"),
        )
        .where(F.col("pair.second").isNotNull())
        .select(
            "doc_id",
            F.trim(F.concat_ws(" ", "pair.first", "pair.second")).alias("biword"),
        )
        .where(F.col("biword") != "")
    )


def _biwords() -> Column:
    most = F.greatest(F.size("tokens") - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice("tokens", F.lit(1), most),
        F.slice("tokens", F.lit(2), most),
        lambda first, second: F.trim(F.concat_ws(" ", first, second)),
    )
    return F.array_remove(pairs, "")


def distinct_biword_rows(tokens: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``(doc_id, biword)`` once per document, deduplicated inside the row; with
    ``keep`` only those pairs."""
    return _distinct_rows(tokens, _biwords(), keep, "biword")


def _phrases(n_words: int, keep: Sequence[str] | None) -> Column:
    """The runs of ``n_words`` tokens without a blank; with ``keep`` only those that begin
    with a word one of ``keep`` begins with, so that others are never joined."""
    last = F.greatest(F.size("tokens") - n_words, F.lit(-1))
    if keep is None:
        starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(
            F.array().cast("array<int>"))
    else:
        first = in_list("token", sorted({phrase.split(" ")[0] for phrase in keep}))
        starts = F.filter(
            F.expr(f"transform(tokens, (token, i) -> if({first}, i + 1, NULL))"),
            lambda i: i <= last + 1)
    runs = F.transform(starts, lambda i: F.slice("tokens", i, F.lit(n_words)))
    return F.transform(
        F.filter(runs, lambda run: ~F.array_contains(run, "")), lambda run: F.array_join(run, " "))


def distinct_phrase_rows(
    tokens: DataFrame, n_words: int, keep: Sequence[str] | None = None
) -> DataFrame:
    """``(doc_id, phrase)`` once per document for runs of ``n_words`` neighboring tokens, of
    which none is blank: words on both sides of a removed token are not neighbors."""
    return _distinct_rows(tokens, _phrases(n_words, keep), keep, "phrase")


def distinct_run_rows(
    tokens: DataFrame, lengths: Sequence[int], keep: Sequence[str] | None = None
) -> DataFrame:
    """``(doc_id, phrase)`` of the biwords and of the runs of all ``lengths``, in one pass
    over the tokens."""
    runs = [_phrases(n, keep) for n in lengths]
    return _distinct_rows(tokens, F.concat(_biwords(), *runs), keep, "phrase")


def doc_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"))


def doc_lengths(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "doc_len")


def average_length(tokens: DataFrame, arithmetic: str = "integer") -> DataFrame:
    """Mean document length; ``integer`` drops the fraction."""
    total = F.sum(F.col("doc_len").cast("bigint"))
    mean = F.try_divide(total, F.count("*"))
    if arithmetic == "integer":
        mean = F.floor(mean).cast("double")
    return tokens.agg(mean.alias("average_length"))


def doc_dates(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "doc_date")


def corpus_stats(tokens: DataFrame) -> DataFrame:
    """One row: what the scorers need to know about the whole collection, over
    all documents and over those with at least one indexed token."""
    indexed = F.col("indexed_len") > 0
    return tokens.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum(F.col("doc_len").cast("bigint")), F.lit(0)).alias("total_len"),
        F.count(F.when(indexed, True)).alias("n_indexed"),
        F.coalesce(F.sum(F.col("indexed_len").cast("bigint")), F.lit(0)).alias(
            "total_indexed_len"
        ),
    )


def likely_tokens(tokens: DataFrame, wanted: Sized) -> DataFrame:
    """A token table without most tokens that are not among the terms of ``wanted``: those
    whose hash is not that of any are dropped inside the row, with memory of a fixed bound."""
    held = BitSet.of(wanted.df, "term").may_hold("token")
    return tokens.withColumn("tokens", F.expr(f"filter(tokens, token -> {held})"))


def matched_tokens(tokens: DataFrame, wanted: Sized) -> DataFrame:
    """A token table with only the terms of ``wanted`` in its arrays, found by a join.
    Most others do not become rows for it, see ``likely_tokens``.

    A document's rows are adjacent, so partial aggregation makes them one row again
    before the shuffle by document. They are known by the number of their row, so rows
    that share an id stay apart.
    """
    keep = wanted.df.select("term").distinct().withColumn("wanted", F.lit(True))
    numbered = likely_tokens(tokens, wanted).withColumn("row", F.monotonically_increasing_id())
    rows = numbered.select(
        "row", "doc_id", "doc_len", "indexed_len", F.explode_outer("tokens").alias("term")
    )
    found = rows.join(F.broadcast(keep) if wanted.small else keep, "term", "left")
    return found.groupBy("row", "doc_id", "doc_len", "indexed_len").agg(
        F.collect_list(F.when(F.col("wanted"), F.col("term"))).alias("tokens")
    ).drop("row")


def check_unique(tokens: DataFrame) -> None:
    """Raise an error naming a document id that occurs more than once."""
    repeated = duplicate_ids(tokens).first()
    if repeated is not None:
        raise ValueError(f"document id {repeated.doc_id} occurs {repeated.n_rows} times")


def duplicate_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_rows)`` of ids that occur more than once; empty for a sound
    collection. Counts are combined before the shuffle."""
    return (
        docs.groupBy("doc_id").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    )
