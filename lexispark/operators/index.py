"""Inverted, biword and positional indexes.

The working form is flat: one row per (term, document). List forms group by
(term, segment), a segment being a range of document ids, so that a term found
in a third of all documents is many bounded rows and never one huge array. Where
documents have been numbered (``operators/numbering.py``) segments are ranges of these
numbers, so that there are no more lists than with dense ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.operators import corpus, runs
from lexispark.scale import local_table, segment_of

# 65,536 ids of 8 bytes are half a megabyte per list at most. Positional
# lists hold a document's positions too, so their segments are smaller.
ID_SEGMENT_BITS = 16
POSITION_SEGMENT_BITS = 12


def _segment(rows: DataFrame, bits: int) -> Column:
    return segment_of(F.col(corpus.id_columns(rows)[-1]), bits).alias("segment")


def _id_groups(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """One list of distinct ids per group; a null is none."""
    key, segment, ids = batch.columns
    kept = np.zeros(batch.num_rows, bool)
    kept[starts] = True
    kept[runs.changes(batch, ["doc_id"])] = True
    kept &= ids.is_valid().to_numpy(zero_copy_only=False)
    before = np.append(0, np.cumsum(kept))
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(starts)), segment.take(pa.array(starts)),
         runs.lists(ids.filter(pa.array(kept)), before[starts])],
        [batch.schema.names[0], "segment", "doc_ids"])


def _id_lists(rows: DataFrame, key: str, segment_bits: int) -> DataFrame:
    """Rows are shuffled as they are, which takes less than lists of one id each, as most
    are before a shuffle, and made lists where they are sorted."""
    segment = _segment(rows, segment_bits)
    dealt = rows.repartition(F.col(key), segment).select(key, segment, "doc_id")
    return runs.group_rows(
        dealt.sortWithinPartitions(key, "segment", "doc_id"), [key, "segment"], _id_groups,
        f"{key} string, segment bigint, doc_ids array<bigint>")


def inverted_index(tokens: DataFrame, segment_bits: int = ID_SEGMENT_BITS) -> DataFrame:
    """``(term, segment, doc_ids)``: distinct ids, ascending."""
    return _id_lists(corpus.distinct_term_rows(tokens), "term", segment_bits)


def biword_index(tokens: DataFrame, segment_bits: int = ID_SEGMENT_BITS) -> DataFrame:
    """``(biword, segment, doc_ids)``."""
    return _id_lists(corpus.distinct_biword_rows(tokens), "biword", segment_bits)


# Tokens of a partition that ``postings`` groups, see ``token_partitions``.
PARTITION_TOKENS = 1_000_000


def token_partitions(tokens: DataFrame) -> int:
    """How many partitions hold ``PARTITION_TOKENS`` tokens each. ``tokens`` is a written
    table, of which the lengths are read."""
    total = tokens.agg(F.sum(F.col("doc_len").cast("bigint"))).first()[0] or 0
    return max(total // PARTITION_TOKENS + 1,
               int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def postings(
    tokens: DataFrame, positions: bool = False, only: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``(term, doc_id, tf, doc_len, indexed_len)``, with ``positions`` if asked.

    The lengths ride along with each posting: scoring then needs no join of
    matched postings with a table of all documents.

    Documents are shuffled as token arrays, a third of the volume of exploded
    rows; grouping by (term, document) then needs no shuffle, nor does a later
    one by document. No term's rows meet in one task. ``only`` is a frame whose
    ``term`` column names the terms wanted. Token arrays are many times larger as rows,
    so partitions of the usual size need much memory; ``partitions`` sets another number.
    """
    tokens = tokens.repartition(*([partitions] if partitions else []), "doc_id")
    lengths = [F.max("doc_len").alias("doc_len"), F.max("indexed_len").alias("indexed_len")]
    if positions:
        rows = corpus.position_rows(tokens, "doc_len", "indexed_len")
        lists = [F.sort_array(F.collect_list("pos")).alias("positions")]
    else:
        rows = tokens.select(
            "doc_id",
            "doc_len",
            "indexed_len",
            F.explode(F.array_remove("tokens", "")).alias("term"),
        )
        lists = []
    if only is not None:
        rows = rows.join(only, "term", "left_semi")
    return rows.groupBy("term", "doc_id").agg(
        F.count("*").alias("tf"), *lengths, *lists
    )


# Tokens that ``local_postings`` takes at once, unless one document has more.
SLICE_TOKENS = 200_000


def _token_counts(rows: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(rows.column("tokens")), 0).to_numpy()


def _document_postings(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The occurrences of each document ordered by term and place, and cut where the
    document or the term changes."""
    lists = rows.column("tokens")
    lengths = _token_counts(rows)
    words = lists.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    blank = pc.index_in("", words.dictionary).as_py()
    codes = pc.fill_null(words.indices, -1).to_numpy()
    kept = codes >= 0 if blank is None else (codes >= 0) & (codes != blank)
    doc, pos, codes = doc[kept], pos[kept], codes[kept].astype(np.int64)
    many, n = max(len(words.dictionary), 1), max(len(doc), 1)
    order = np.sort((doc * many + codes) * n + np.arange(len(doc)))
    key, order = order // n, order % n
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    first = pa.array(doc[order[starts]])
    made = {
        "term": words.dictionary.take(pa.array(codes[order[starts]])),
        "tf": pa.array(np.diff(np.append(starts, len(key)))),
        "positions": runs.lists(pa.array(pos[order], pa.int32()), starts),
    }
    for name in rows.schema.names:
        if name != "tokens":
            made[name] = rows.column(name).take(first)
    names = [name for name in POSTING_COLUMNS if name in made]
    return pa.RecordBatch.from_arrays([made[name] for name in names], names)


POSTING_COLUMNS = {
    "term": "string", "doc_id": "bigint", "tf": "bigint", "doc_len": "int",
    "indexed_len": "int", "positions": "array<int>", "doc_no": "bigint"}


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in runs.slices(batch, _token_counts(batch), SLICE_TOKENS):
            yield _document_postings(rows)


def local_postings(tokens: DataFrame) -> DataFrame:
    """``postings`` with positions, made within each document's row by array operations
    over a slice of documents, so nothing is shuffled."""
    columns = [*corpus.id_columns(tokens), "doc_len", "indexed_len", "tokens"]
    schema = ", ".join(f"{name} {kind}" for name, kind in POSTING_COLUMNS.items()
                       if name != "doc_no" or "doc_no" in columns)
    return tokens.select(*columns).mapInArrow(_local, schema)


def term_stats(postings: DataFrame) -> DataFrame:
    """``(term, df, cf)``: documents with the term, and its occurrences."""
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


def document_frequencies(tokens: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(term, df)`` straight from tokens, deduplicated inside each row."""
    rows = corpus.distinct_term_rows(tokens)
    if only is not None:
        rows = rows.join(only, "term", "left_semi")
    return rows.groupBy("term").agg(F.count("*").alias("df"))


def indexed_doc_lengths(postings: DataFrame) -> DataFrame:
    """``(doc_id, doc_len)`` as the sum of term frequencies."""
    return postings.groupBy("doc_id").agg(F.sum("tf").alias("doc_len"))


def indexed_doc_count(postings: DataFrame) -> DataFrame:
    return postings.agg(F.count_distinct("doc_id").alias("n_docs"))


# Terms with more postings than this, and than one in so many of all, are dealt out by
# segment; all rows of another one meet in a task, which then knows how many they are.
FREQUENT_ROWS = 100_000
FREQUENT_SHARE = 10_000
COUNT_SLOTS = 1 << 16


def frequent_terms(postings: DataFrame) -> list[Row]:
    """``(term, n)`` of the terms that are dealt out, at most ``FREQUENT_SHARE``. Counts of
    hashes come first, so that of most terms none is kept."""
    least = max(postings.count() // FREQUENT_SHARE, FREQUENT_ROWS)
    slot = F.pmod(F.xxhash64("term"), F.lit(COUNT_SLOTS))
    full = postings.groupBy(slot.alias("slot")).count().where(F.col("count") > least)
    slots = [row.slot for row in full.collect()]
    if not slots:
        return []
    counts = postings.where(slot.isin(slots)).groupBy("term").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > least).collect()


def _positional_groups(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """One row per segment, with the size of its group or the count that is known."""
    n = batch.num_rows
    cuts = np.union1d(starts, runs.changes(batch, ["segment"]))
    sizes = np.diff(np.append(starts, n))
    group = np.searchsorted(starts, cuts, side="right") - 1
    at = pa.array(cuts)
    docs = pa.StructArray.from_arrays(
        [batch.column("doc_id"), batch.column("positions")], ["doc_id", "positions"])
    return pa.RecordBatch.from_arrays(
        [batch.column("term").take(at), batch.column("segment").take(at),
         pc.coalesce(batch.column("n").take(at), pa.array(sizes[group])),
         runs.lists(docs, cuts)],
        ["term", "segment", "df", "docs"])


def positional_index(
    postings: DataFrame, segment_bits: int = POSITION_SEGMENT_BITS
) -> DataFrame:
    """``(term, segment, df, docs)`` with ``docs`` an ascending array of
    ``(doc_id, positions)`` and ``df`` the term's count over all segments.

    ``postings`` is read several times, so pass a stored or materialized table. Rows are
    shuffled once, by term, and made lists where they are sorted: how many a term has is
    then known without a join. Only a term in very many documents, which would be too much
    for a task, is counted before and shuffled by segment.
    """
    known = local_table(
        postings.sparkSession, frequent_terms(postings),
        T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]))
    segment = _segment(postings, segment_bits)
    rows = postings.join(F.broadcast(known), "term", "left").select(
        "term", segment, "doc_id", "positions", "n")
    part = F.when(F.col("n").isNotNull(), F.col("segment"))
    dealt = rows.repartition(F.col("term"), part).withColumn("part", part)
    return runs.group_rows(
        dealt.sortWithinPartitions("term", "segment", "doc_id", "positions"),
        ["term", "part"], _positional_groups,
        "term string, segment bigint, df bigint,"
        " docs array<struct<doc_id: bigint, positions: array<int>>>",
    ).where(F.col("segment").isNotNull())
