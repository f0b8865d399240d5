"""Boolean retrieval on bitmaps.

For each term and each segment of 2**15 document numbers the index has one row: which
documents of the segment have the term, as a bitmap where they are many and as a
list of their places where they are few. AND and OR then work on whole segments, one row
per term and segment, not per posting. Segments in which a clause lacks a term, so all
in which its rarest one does not occur, are dropped by their keys alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.scale import Sized, check_size, in_list

SEGMENT_BITS = 15  # as many documents as Spark's bitmap functions hold bits
# A bitmap has 4,096 bytes, a place two.
LISTED = 2048


def _place():
    return F.col("doc_no").bitwiseAND((1 << SEGMENT_BITS) - 1).alias("place")


def term_segments(rows: DataFrame, listed: int = LISTED) -> DataFrame:
    """``(term, segment, n, places, bits)`` from distinct (term, doc_no): ``places`` for up
    to ``listed`` documents, else ``bits``. Both are aggregated before the shuffle."""
    lists = rows.groupBy(
        "term", F.shiftright("doc_no", SEGMENT_BITS).alias("segment")).agg(
        F.collect_set(_place().cast("smallint")).alias("places"))
    n = F.size("places")
    few = lists.where(n <= listed).select(
        "term", "segment", n.alias("n"), "places", F.lit(None).cast("binary").alias("bits"))
    many = lists.where(n > listed).select("term", "segment", F.explode("places").alias("place"))
    bits = many.groupBy("term", "segment").agg(
        F.count("*").cast("int").alias("n"), F.lit(None).cast("array<smallint>").alias("places"),
        F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))
    return few.union(bits)


def _as_bitmaps(segments: DataFrame) -> DataFrame:
    """All rows with ``bits``; those of lists are made here, a few per query term."""
    made = segments.where("bits IS NULL").select(
        "term", "segment", F.explode("places").alias("place")).groupBy("term", "segment").agg(
        F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))
    return segments.where("bits IS NOT NULL").select("term", "segment", "bits").union(made)


def matching_segments(segments: DataFrame, clauses: DataFrame | Sized) -> DataFrame:
    """``(query_id, segment, bits)`` of the documents that meet any clause of a query;
    ``clauses`` is (query_id, clause, term, n_terms)."""
    sized = clauses if isinstance(clauses, Sized) else check_size(clauses, "term")
    terms = sized.literal()
    if terms is not None:
        segments = segments.where(in_list("term", terms))
    keys = ["query_id", "clause", "segment"]
    whole = segments.select("term", "segment").join(sized.hinted(), "term").groupBy(
        *keys, "n_terms").agg(F.count("*").alias("n_met")).where("n_met = n_terms").select(*keys)
    rows = segments.join(sized.hinted(), "term").join(whole, keys, "left_semi")
    used = _as_bitmaps(segments.join(
        whole.select("segment").distinct(), "segment", "left_semi"))
    met = rows.select(*keys, "term").join(used, ["term", "segment"]).groupBy(*keys).agg(
        F.bitmap_and_agg("bits").alias("bits"))
    return met.groupBy("query_id", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            bits = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint8)
            at = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
            number = (batch.column(1)[i].as_py() << SEGMENT_BITS) + at
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64)),
                 pa.array(number)], ["query_id", "doc_no"])


def document_numbers(matches: DataFrame) -> DataFrame:
    """``(query_id, doc_no)`` of the bits that are set."""
    return matches.select("query_id", "segment", "bits").mapInArrow(
        _numbers, "query_id bigint, doc_no bigint")


def counts(matches: DataFrame) -> DataFrame:
    """``(query_id, n_hits)`` without looking at single documents."""
    return matches.groupBy("query_id").agg(F.sum(F.bitmap_count("bits")).alias("n_hits"))
