"""Line-oriented text forms of indexes, statistics and results.

Inverted and biword lines are ``key TAB id id ...``; positional lines are
``term:df;doc:pos,pos;doc:pos;`` and a tab. A common term takes one line per
segment of document ids, each with the same ``df``; readers treat lines of one
term as one list, so they read single-line indexes the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators import index
from lexispark.operators.ranking import Searchable


def id_list_lines(lists: DataFrame, key: str = "term") -> DataFrame:
    ids = F.array_join(F.col("doc_ids").cast("array<string>"), " ")
    return lists.select(F.concat_ws("\t", key, ids).alias("value"))


def positional_docs_text() -> Column:
    """The ``docs`` column of a positional index as ``doc:pos,pos;doc:pos;``."""

    def doc(entry: Column) -> Column:
        positions = F.array_join(entry["positions"].cast("array<string>"), ",")
        return F.concat(entry["doc_id"].cast("string"), F.lit(":"), positions, F.lit(";"))

    return F.array_join(F.transform("docs", doc), "")


def positional_lines(lists: DataFrame) -> DataFrame:
    header = F.concat("term", F.lit(":"), F.col("df").cast("string"), F.lit(";"))
    return lists.select(F.concat(header, positional_docs_text(), F.lit("\t")).alias("value"))


def result_lines(scores: DataFrame) -> DataFrame:
    """``docId TAB score`` of one query's results."""
    return scores.select(F.concat_ws("\t", "doc_id", "score").alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Replace what is at ``path``."""
    lines.write.mode("overwrite").text(path)


def _before(text: Column | str, separator: str) -> Column:
    return F.trim(F.substring_index(text, separator, 1))


def _after(text: Column | str, separator: str) -> Column:
    return F.trim(F.substring_index(text, separator, -1))


def read_id_lists(spark: SparkSession, path: str, key: str = "term") -> DataFrame:
    """``(key, doc_ids)`` of an inverted or biword text index. An id that is not
    a whole number is an error."""
    return (
        spark.read.text(path)
        .where(F.contains(F.col("value"), F.lit("\t")))
        .select(
            _before("value", "\t").alias(key),
            F.split(_after("value", "\t"), " ").cast("array<bigint>").alias("doc_ids"),
        )
    )


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """``(term, df, doc_id, tf, positions)`` rows of a positional text index,
    with or without the closing tab."""
    # Each split is its own projection, so that it is done once per line.
    lines = (
        spark.read.text(path)
        .where(F.contains(F.col("value"), F.lit(";")))
        .select(F.split("value", ";").alias("pieces"))
        .select(
            F.col("pieces")[0].alias("header"),
            F.explode(F.slice("pieces", F.lit(2), F.size("pieces"))).alias("piece"),
        )
        .where(F.contains(F.col("piece"), F.lit(":")))
    )
    return lines.select(
        _before("header", ":").alias("term"),
        _after("header", ":").cast("bigint").alias("df"),
        _before("piece", ":").cast("bigint").alias("doc_id"),
        F.split(_after("piece", ":"), ",").alias("positions"),
    ).select(
        "term",
        "df",
        "doc_id",
        F.size("positions").cast("bigint").alias("tf"),
        F.col("positions").cast("array<int>").alias("positions"),
    )


def read_positional_terms(spark: SparkSession, path: str) -> DataFrame:
    """``(term, df)`` from the headers of a positional text index alone."""
    header = F.substring_index("value", ";", 1)
    lines = spark.read.text(path).where(F.contains(F.col("value"), F.lit(";")))
    return lines.select(
        _before(header, ":").alias("term"), _after(header, ":").cast("bigint").alias("df")
    ).distinct()


def write_doc_count(count: DataFrame, path: str) -> None:
    value = F.concat(F.lit("\t"), F.col("n_docs").cast("string")).alias("value")
    write_lines(count.select(value), path)


def read_doc_count(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(n_docs)`` from the first line of a count file."""
    return (
        spark.read.text(path)
        .limit(1)
        .select(F.btrim("value", F.lit(" \t")).cast("bigint").alias("n_docs"))
    )


def write_doc_lengths(lengths: DataFrame, path: str) -> None:
    write_lines(lengths.select(F.concat_ws("\t", "doc_id", "doc_len").alias("value")), path)


def read_doc_lengths(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, doc_len)``; of several lines for one id the last one counts,
    files being taken in name order."""
    line_order = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return (
        spark.read.text(path)
        .where(F.contains(F.col("value"), F.lit("\t")))
        .select(
            _before("value", "\t").cast("bigint").alias("doc_id"),
            _after("value", "\t").cast("int").alias("doc_len"),
            line_order.alias("line_order"),
        )
        .groupBy("doc_id")
        .agg(F.max_by("doc_len", "line_order").alias("doc_len"))
    )


def attach_doc_lengths(postings: DataFrame, lengths: DataFrame) -> DataFrame:
    """Imported postings with the imported length of their document. A document
    without one is an error, not a lost row."""
    missing = F.raise_error(
        F.concat(F.lit("no length for document "), F.col("doc_id").cast("string"))
    ).cast("int")
    return postings.join(lengths, "doc_id", "left").withColumn(
        "doc_len", F.coalesce(F.col("doc_len"), missing)
    )


def text_index(
    rows: DataFrame,
    count: DataFrame | None = None,
    lengths: DataFrame | None = None,
    terms: DataFrame | None = None,
) -> Searchable:
    """Make ``read_positional`` rows searchable.

    TF-IDF and the factored BM25 need the document count and lengths read from their
    files, which must describe the same documents; matched rows are then joined with
    lengths and nothing else. Classic BM25 needs neither: without them indexed lengths
    and counts come from all rows, as sums of term frequencies. ``terms``, from
    ``read_positional_terms``, saves taking (term, df) from the rows.
    """
    if (count is None) != (lengths is None):
        raise ValueError("document count and lengths go together")
    if terms is None:
        terms = rows.select("term", "df").distinct()
    postings = rows.select("term", "doc_id", "tf")
    nothing = F.lit(None).cast("bigint")
    if lengths is None:
        indexed = index.indexed_doc_lengths(rows).withColumnRenamed("doc_len", "indexed_len")
        postings = postings.join(indexed, "doc_id").withColumn("doc_len", nothing.cast("int"))
        stats = indexed.agg(
            nothing.alias("n_docs"),
            nothing.alias("total_len"),
            F.count("*").alias("n_indexed"),
            F.sum("indexed_len").alias("total_indexed_len"),
        )
        return Searchable(postings, terms, stats, has_counts=False)
    postings = attach_doc_lengths(postings, lengths).withColumn("indexed_len", nothing)
    counted = count.scalar()
    differs = F.raise_error(F.lit("document count and number of lengths differ"))
    stats = lengths.agg(
        F.count("*").alias("n_lengths"),
        F.sum(F.col("doc_len").cast("bigint")).alias("total_len"),
    ).select(
        F.when(counted == F.col("n_lengths"), F.col("n_lengths"))
        .otherwise(differs.cast("bigint"))
        .alias("n_docs"),
        "total_len",
        nothing.alias("n_indexed"),
        nothing.alias("total_indexed_len"),
    )
    return Searchable(postings, terms, stats, has_indexed=False)
