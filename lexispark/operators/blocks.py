"""Ranked search that does not score every posting.

A term's postings are stored in blocks of documents with neighboring numbers, each with
the largest saturation in it. Weighted and summed over a query's terms these are a bound
on the score of any document of the block. The blocks with the highest bounds are scored
first; the k-th best score among them is a score the final k-th best cannot be below.
Blocks whose bound does not reach it are never opened. As a term that few documents have
weighs most, blocks with only a query's common terms are mostly among these.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators import runs
from lexispark.operators.ranking import saturation, top_k
from lexispark.scale import LITERAL_TERMS, materialize, segment_of

BLOCK_BITS = 7  # a block covers so many bits of the document number
# Bounds and scores are sums of the same numbers in another order.
SLACK = 1e-9


def _blocks(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    at = pa.array(starts)
    most = batch.column("most").to_numpy(zero_copy_only=False)
    docs = pa.StructArray.from_arrays([batch.column(name) for name in DOC], list(DOC))
    return pa.RecordBatch.from_arrays(
        [batch.column("term").take(at), batch.column("block").take(at),
         pa.array(np.diff(np.append(starts, batch.num_rows))),
         pa.array(np.maximum.reduceat(most, starts)), runs.lists(docs, starts)],
        ["term", "block", "n", "most", "docs"])


DOC = ("doc_id", "tf", "indexed_len")


def posting_blocks(postings: DataFrame, average_length: Column,
                   block_bits: int = BLOCK_BITS) -> DataFrame:
    """``(term, block, n, most, docs)``: up to 2**block_bits postings a row, with their
    largest saturation.

    Nothing is shuffled: a stored table has a term's postings side by side. Where a block's
    postings are in two partitions it is two rows, whose bounds add up to one that still holds.
    """
    most = saturation(F.col("tf"), F.col("indexed_len"), average_length)
    order = [c for c in ("term_bucket",) if c in postings.columns]
    rows = postings.select(
        *order, "term", segment_of(F.col("doc_no"), block_bits).alias("block"),
        most.alias("most"), *DOC)
    return runs.group_rows(
        rows.sortWithinPartitions(*order, "term", "block", "doc_id").drop(*order),
        ["term", "block"], _blocks,
        "term string, block bigint, n bigint, most double,"
        " docs array<struct<doc_id: bigint, tf: bigint, indexed_len: int>>")


def block_bounds(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """``(query_id, block, bound)`` of all blocks with a term of a query. A term of
    negative weight adds nothing, as a document may be without it."""
    reach = F.greatest(F.col("weight") * F.col("most"), F.lit(0.0))
    return blocks.select("term", "block", "most").join(weights, "term").groupBy(
        "query_id", "block").agg(F.sum(reach).alias("bound"))


def _scores(blocks: DataFrame, wanted: DataFrame, weights: DataFrame) -> DataFrame:
    """Scores of all documents in the ``wanted`` blocks (query_id, block). A short list of
    blocks reaches the file scan."""
    numbers = wanted.select("block").distinct().limit(LITERAL_TERMS + 1).collect()
    if len(numbers) <= LITERAL_TERMS:
        listed = ", ".join(str(r.block) for r in numbers) or "NULL"
        blocks = blocks.where(f"block IN ({listed})")
        wanted = F.broadcast(wanted) if wanted.count() <= LITERAL_TERMS else wanted
    opened = blocks.join(weights, "term").join(wanted.select("query_id", "block"),
                                               ["query_id", "block"])
    found = opened.select("query_id", "weight", "average_length", F.explode("docs").alias("doc"))
    value = saturation(F.col("doc.tf"), F.col("doc.indexed_len"), F.col("average_length"))
    return found.groupBy("query_id", F.col("doc.doc_id").alias("doc_id")).agg(
        F.sum(value * F.col("weight")).alias("score"))


def candidate_blocks(blocks: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(query_id, block, bound)`` of the blocks that may hold one of a query's ``k`` best
    documents."""
    bounds = materialize(block_bounds(blocks, weights), "block-bounds")
    # k blocks hold k documents or more
    first = top_k(bounds.select(
        "query_id", F.col("block").alias("doc_id"), F.col("bound").alias("score")), k)
    first = materialize(first.select("query_id", F.col("doc_id").alias("block")), "first-blocks")
    best = top_k(_scores(blocks, first, weights), k)
    least = best.groupBy("query_id").agg(
        F.when(F.count("*") == k, F.min("score")).alias("least"))
    reached = F.col("least").isNull() | (
        F.col("bound") >= F.col("least") - SLACK * (1 + F.abs(F.col("least"))))
    return bounds.join(least, "query_id").where(reached).select("query_id", "block", "bound")


def block_max_top_k(blocks: DataFrame, weights: DataFrame, k: int = 10,
                    seen: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The ``k`` best documents of each query by classic BM25, as ``ranking.top_k`` gives
    them from all scores. ``weights`` is (query_id, term, weight, average_length); ``seen``
    is shown the blocks that were opened."""
    candidates = materialize(candidate_blocks(blocks, weights, k), "candidate-blocks")
    if seen is not None:
        seen(candidates)
    return top_k(_scores(blocks, candidates, weights), k)
