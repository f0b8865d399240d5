"""The stored index: Parquet tables built once and read by every search.

``tokens``    one row per document with its lengths and token array, sorted by id; the
              row's place is the document's dense number
``postings``  one row per (term, document) with frequency, positions, lengths
``terms``     document and collection frequency per term
``biwords``   one row per (two-word phrase, document), if asked for
``blocks``    postings of neighboring documents with a bound on their scores, if asked for
``segments``  one bitmap or short list per term and 2**15 documents, if asked for
``corpus``    one row of collection statistics
``directory`` which files hold which blocks of terms, one row per block and file

The tables of one build are in a folder of their own; ``versions`` names the folders of
completed builds, of which the last counts. Tables of terms are sorted by block of terms
(a bucket of a hash; their number follows the collection's size) and by term inside. A
search looks up the blocks of its terms in the directory, opens only the files it names,
and there skips row groups by block, by term range and by dictionary or Bloom filter.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.operators import bitmaps, blocks, boolean, corpus, index, numbering
from lexispark.operators.query_text import clause_terms
from lexispark.operators.ranking import QueryTerms, Searchable, classic_weights
from lexispark.scale import check_size, in_list, local_table

# By default as many buckets as hold so many tokens each, but no fewer than these.
BUCKET_TOKENS = 50_000_000
MIN_BUCKETS = 32
# A search that needs more files than this reads the table, skipping row groups alone.
LISTED_FILES = 10_000


def default_buckets(n_tokens: int) -> int:
    return max(MIN_BUCKETS, -(-n_tokens // BUCKET_TOKENS))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _write_by_term(
    rows: DataFrame, path: str, buckets: int, *order: str, dealt: bool = False
) -> None:
    """Adaptive execution evens out the write: a bucket with a common term is
    split over tasks, and small ones share a file. Rows made from a table written
    this way are ``dealt`` already."""
    rows = rows.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    (
        (rows if dealt else rows.hint("rebalance", F.col("term_bucket")))
        .sortWithinPartitions("term_bucket", *order)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.bloom.filter.enabled#term", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def _write_directory(spark: SparkSession, folder: str, tables: list[str]) -> None:
    """One row per table, bucket and file, sorted: reads one short column of each table."""
    rows = [
        spark.read.parquet(f"{folder}/{table}").select(
            F.lit(table).alias("table"), "term_bucket",
            F.col("_metadata.file_name").alias("file")).distinct()
        for table in tables
    ]
    reduce(DataFrame.union, rows).sort("table", "term_bucket").write.parquet(
        f"{folder}/directory")


def build_index(
    docs: DataFrame,
    path: str,
    buckets: int | None = None,
    digits: str = "line",
    biwords: bool = False,
    block_max: bool = False,
    segments: bool = False,
) -> None:
    """Write the index of ``docs``, replacing one at ``path``.

    Texts are normalized once; later tables are built from written ones, postings inside
    the rows of documents. ``block_max`` adds what ``StoredIndex.top_k`` needs, ``segments``
    what ``StoredIndex.bitmap_search`` needs. All
    tables go to a folder of their own, and only a row appended to ``versions``
    at the end makes readers see it: a build that fails, for repeated document ids
    or a lost job, leaves the earlier index as it was.
    """
    spark = docs.sparkSession
    folder = f"{path}/version-{uuid.uuid4().hex}"
    numbering.write_in_order(
        docs.select("doc_id", "content"), f"{folder}/tokens",
        lambda rows: corpus.token_table(rows, digits=digits))
    tokens = numbering.read_numbered(spark, f"{folder}/tokens")
    corpus.check_unique(tokens)
    stats = corpus.corpus_stats(tokens).first()
    if buckets is None:
        buckets = default_buckets(stats.total_indexed_len)
    _write_by_term(
        index.local_postings(tokens), f"{folder}/postings", buckets, "term", "doc_id"
    )
    stored = spark.read.parquet(f"{folder}/postings")
    _write_by_term(index.term_stats(stored), f"{folder}/terms", buckets, "term")
    if biwords:
        pairs = corpus.distinct_biword_rows(tokens.drop("doc_no"))
        pairs = pairs.withColumnRenamed("biword", "term")
        _write_by_term(pairs, f"{folder}/biwords", buckets, "term", "doc_id")
    if block_max:
        average = F.lit(stats.total_indexed_len / max(stats.n_indexed, 1))
        rows = blocks.posting_blocks(stored, average)
        _write_by_term(rows, f"{folder}/blocks", buckets, "term", "block", dealt=True)
    if segments:
        rows = bitmaps.term_segments(stored.select("term", "doc_no"))
        _write_by_term(rows, f"{folder}/segments", buckets, "term", "segment")
    parts = {"biwords": biwords, "blocks": block_max, "segments": segments}
    _write_directory(
        spark, folder, ["postings", "terms", *[part for part, made in parts.items() if made]])
    made = spark.createDataFrame([stats], STATS_SCHEMA)
    made = made.withColumns({
        "biwords": F.lit(biwords), "block_max": F.lit(block_max), "segments": F.lit(segments),
        "buckets": F.lit(buckets), "directory": F.lit(True)})
    made.write.parquet(f"{folder}/corpus")
    number = (_versions(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    row = spark.createDataFrame([(number, folder.rsplit("/", 1)[1])], VERSION_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")


STATS_SCHEMA = "n_docs bigint, total_len bigint, n_indexed bigint, total_indexed_len bigint"
STATS_COLUMNS = [column.split()[0] for column in STATS_SCHEMA.split(", ")]
VERSION_SCHEMA = "number bigint, folder string"
DIRECTORY_SCHEMA = "table string, term_bucket int, file string"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/versions")


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the index that was completed last."""
    last = _versions(spark, path).orderBy(F.desc("number"), F.desc("folder")).first()
    if last is None:
        raise FileNotFoundError(f"no index at {path}")
    return f"{path}/{last.folder}"


def remove_old_versions(spark: SparkSession, path: str) -> None:
    """Delete all folders of the index but the current one, those of failed builds
    included. No build or search of an older version may be running."""
    current = current_folder(spark, path).rsplit("/", 1)[1]
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(base):
        name = status.getPath().getName()
        if name.startswith("version-") and name != current:
            store.delete(status.getPath(), True)


@dataclass(frozen=True)
class StoredIndex(Searchable):
    """A stored index as the scorers read it."""

    buckets: int = MIN_BUCKETS
    biwords: DataFrame | None = None
    blocks: DataFrame | None = None
    segments: DataFrame | None = None
    docs: DataFrame | None = None  # (doc_id, doc_no)
    folder: str | None = None
    directory: DataFrame | None = None  # (table, term_bucket, file); older indexes have none

    def _buckets_of(self, terms: list[str] | None, wanted: DataFrame) -> list[int]:
        """The buckets of the terms, never more than there are."""
        if terms is not None:  # a local table: the planner hashes it, without a job
            wanted = local_table(self.corpus.sparkSession, [(t,) for t in terms], TERM_SCHEMA)
        rows = wanted.select(term_bucket(F.col("term"), self.buckets).alias("bucket"))
        rows = rows if terms is not None else rows.distinct()
        return sorted({r.bucket for r in rows.collect()})

    def _opened(self, buckets: list[int], **tables: DataFrame) -> dict[str, DataFrame]:
        """The given tables, of each only the files and row groups of the buckets."""
        inside = F.col("term_bucket").isin(buckets)
        if self.directory is None:
            return {name: rows.where(inside) for name, rows in tables.items()}
        listed = self.directory.where(F.col("table").isin(list(tables)) & inside)
        files = listed.select("table", "file").distinct().limit(LISTED_FILES + 1).collect()
        if len(files) > LISTED_FILES:
            return {name: rows.where(inside) for name, rows in tables.items()}
        opened = {}
        for name, rows in tables.items():
            paths = sorted(f"{self.folder}/{name}/{r.file}" for r in files if r.table == name)
            if paths:
                rows = rows.sparkSession.read.schema(rows.schema).parquet(*paths)
            opened[name] = rows.where(inside if paths else "false")
        return opened

    def narrowed(
        self, terms: list[str] | None, wanted: DataFrame | None = None
    ) -> Searchable:
        """Also only the files of the terms, found in the directory before any is read."""
        if self.only is not None or terms is None and wanted is None:
            return super().narrowed(terms)
        opened = self._opened(
            self._buckets_of(terms, wanted), postings=self.postings, terms=self.terms)
        return super(StoredIndex, replace(self, **opened)).narrowed(terms)

    def boolean_search(self, queries: DataFrame) -> DataFrame:
        return boolean.search_index(
            lambda terms, wanted: self.narrowed(terms, wanted).postings, queries
        )

    def phrase_search(self, queries: DataFrame) -> DataFrame:
        """Phrases of two words from ``biwords``, longer ones from positions."""
        if self.biwords is None:
            raise ValueError("the index was built without biwords")
        clauses = check_size(clause_terms(queries, phrases=True), "term")
        buckets = self._buckets_of(clauses.literal(), clauses.df)
        found = self._opened(buckets, biwords=self.biwords)["biwords"].select("doc_id", "term")
        if boolean.phrase_lengths(clauses.df):
            words = check_size(
                clauses.df.select(F.explode(F.split("term", " ")).alias("term")).distinct(), "term")
            postings = self.narrowed(words.literal(), words.df).postings
            found = found.union(boolean.long_phrase_rows(postings, clauses.df))
        return boolean.evaluate(found, clauses)

    def _narrow(self, name: str, terms: list[str] | None, wanted: DataFrame) -> DataFrame:
        rows = self._opened(self._buckets_of(terms, wanted), **{name: getattr(self, name)})[name]
        return rows if terms is None else rows.where(in_list("term", terms))

    def top_k(self, query: QueryTerms, k: int = 10, seen=None) -> DataFrame:
        """The ``k`` best documents of each query by classic BM25, opening only blocks
        that can hold one. Equal to ``ranking.top_k(ranking.bm25(self, query), k)``."""
        if self.blocks is None:
            raise ValueError("the index was built without block_max")
        weights = classic_weights(self.narrowed(query.terms, query.bag.df), query)
        weights = F.broadcast(weights) if query.bag.small else weights
        rows = self._narrow("blocks", query.terms, query.bag.df)
        return blocks.block_max_top_k(rows, weights, k, seen)

    def bitmap_matches(self, queries: DataFrame) -> DataFrame:
        """``(query_id, segment, bits)`` of boolean queries."""
        if self.segments is None:
            raise ValueError("the index was built without segments")
        clauses = check_size(clause_terms(queries), "term")
        rows = self._narrow("segments", clauses.literal(), clauses.df)
        return bitmaps.matching_segments(rows, clauses)

    def bitmap_search(self, queries: DataFrame) -> DataFrame:
        """``boolean_search`` on whole segments; ids are looked up for the hits alone."""
        numbers = bitmaps.document_numbers(self.bitmap_matches(queries))
        return numbers.join(self.docs, "doc_no").select("query_id", "doc_id")


TERM_SCHEMA = T.StructType([T.StructField("term", T.StringType())])


def read_index(spark: SparkSession, path: str) -> StoredIndex:
    path = current_folder(spark, path)
    stats = spark.read.parquet(f"{path}/corpus")
    made = stats.first().asDict()
    has = {part for part in ("biwords", "block_max", "segments") if made.get(part)}
    return StoredIndex(
        postings=spark.read.parquet(f"{path}/postings"),
        terms=spark.read.parquet(f"{path}/terms"),
        corpus=stats.select(*STATS_COLUMNS),
        buckets=made["buckets"],
        biwords=spark.read.parquet(f"{path}/biwords") if "biwords" in has else None,
        blocks=spark.read.parquet(f"{path}/blocks") if "block_max" in has else None,
        segments=spark.read.parquet(f"{path}/segments") if "segments" in has else None,
        docs=numbering.read_numbered(spark, f"{path}/tokens").select("doc_id", "doc_no")
        if "segments" in has else None,
        folder=path,
        directory=spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{path}/directory")
        if made.get("directory") else None,
    )


def stored_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{current_folder(spark, path)}/tokens")
