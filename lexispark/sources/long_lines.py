"""Text indexes whose lines are longer than a task should read.

An index with one line per term has lines of gigabytes for common terms. Read as lines,
each is one row of one task. Here the separator inside a line is what ends a record, so
Spark cuts files at any byte range and a line is read by many tasks. What a record
belongs to, the line's head, may then stand in an earlier range of the file. A first
pass keeps the last head of each range, one row per range; the second carries heads
forward within its ranges and takes the one before a range from these rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.scale import check_size

_RANGE = ("file", "block")
_FILLED = "file string, block bigint, head string, piece string"


def _records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, value): ``block`` is where the byte range starts in its file."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")


def _range_edges(file: pa.Array, block: pa.Array):
    """Where in a batch a byte range begins that is not that of the row before."""
    code = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    start = block.to_numpy()
    return np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1


def _own_heads(first_is_head: bool):
    """The last head of each byte range, one row per range. A task reads its ranges in
    order, so no more than the range at hand is remembered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, own = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            file, block, heads, pieces = batch.columns
            known = np.flatnonzero(heads.is_valid().to_numpy(zero_copy_only=False))
            edges = [0, *_range_edges(file, block).tolist(), batch.num_rows]
            done = []
            for begin, end in pairwise(edges):
                key = (file[begin].as_py(), block[begin].as_py())
                if key != where:
                    if where is not None:
                        done.append((*where, own))
                    opens = first_is_head and key[1] == 0
                    where, own = key, pieces[begin].as_py() if opens else None
                last = np.searchsorted(known, end) - 1
                if last >= 0 and known[last] >= begin:
                    own = heads[int(known[last])].as_py()
            if done:
                yield _as_rows(done)
        if where is not None:
            yield _as_rows([(*where, own)])

    return run


def _as_rows(ranges: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string())
    columns = zip(*ranges, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*_RANGE, "own"])


def _last_heads(rows: DataFrame, first_is_head: bool) -> DataFrame:
    """(file, block, before): the head that counts where a range begins."""
    opening = F.when((F.col("block") == 0) & F.lit(first_is_head), F.col("piece"))
    last = rows.select(*_RANGE, "head", opening.alias("piece")).mapInArrow(
        _own_heads(first_is_head), "file string, block bigint, own string")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    return last.select(*_RANGE, F.last("own", ignorenulls=True).over(earlier).alias("before"))


def _fill(first_is_head: bool):
    """Carry heads forward within each byte range; a task reads its ranges in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, head = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            file, block, heads, pieces = batch.columns
            codes = file.dictionary_encode()
            code = codes.indices.to_numpy(zero_copy_only=False)
            start = block.to_numpy()
            same = (code[1:] == code[:-1]) & (start[1:] == start[:-1])
            first = (file[0].as_py(), int(start[0])) != where
            begins = np.concatenate(([first], ~same))
            known = heads.is_valid().to_numpy(zero_copy_only=False).copy()
            heads, piece = heads.to_pylist(), pieces
            if first_is_head:
                opening = np.flatnonzero(begins & (start == 0) & ~known)
                for i in opening.tolist():
                    heads[i] = pieces[i].as_py()
                known[opening] = True
                gone = np.zeros(len(known), bool)
                gone[opening] = True
                piece = pc.if_else(pa.array(gone), pa.scalar(None, pa.string()), pieces)
            at = np.arange(len(known))
            last = np.maximum.accumulate(np.where(known, at, -1))
            group = np.maximum.accumulate(np.where(begins, at, 0))
            carried = last < group  # no head yet in this range and batch
            names = pa.array([*heads, head], pa.string())
            pick = np.where(carried, len(known), last)
            filled = names.take(pa.array(pick))
            # only the batch's first range may go on from an earlier batch
            lost = carried & ((np.cumsum(begins) > 1) | first)
            filled = pc.if_else(pa.array(lost), pa.scalar(None, pa.string()), filled)
            where, head = (file[len(known) - 1].as_py(), int(start[-1])), filled[-1].as_py()
            out = pa.RecordBatch.from_arrays(
                [file, block, filled, piece], ["file", "block", "head", "piece"])
            yield out.filter(piece.is_valid())

    return run


def _with_heads(rows: DataFrame, first_is_head: bool) -> DataFrame:
    """(head, piece) of all pieces; ``rows`` has a head where a line begins."""
    before = check_size(
        _last_heads(rows, first_is_head).where("before IS NOT NULL"), "before")
    filled = rows.mapInArrow(_fill(first_is_head), _FILLED)
    return filled.join(before.hinted(), [*_RANGE], "left").select(
        F.coalesce("head", "before").alias("head"), "piece")


def _after_line_end(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)^.*\n", "")


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """What ``index_text.read_positional`` reads, from lines of any length:
    ``(term, df, doc_id, tf, positions)``."""
    records = _records(spark, path, ";")
    ends = F.contains("value", F.lit("\n"))
    following = _after_line_end(F.col("value"))
    rows = records.select(
        *_RANGE, F.when(ends, following).alias("head"),
        F.when(~ends, F.col("value")).alias("piece"))
    pieces = _with_heads(rows, first_is_head=True).where(F.contains("piece", F.lit(":")))
    head = F.split("head", ":")
    piece = F.split("piece", ":")
    positions = F.split(F.trim(piece[1]), ",")
    return pieces.select(
        F.trim(head[0]).alias("term"), F.trim(head[1]).cast("bigint").alias("df"),
        F.trim(piece[0]).cast("bigint").alias("doc_id"), positions.alias("positions")).select(
        "term", "df", "doc_id", F.size("positions").cast("bigint").alias("tf"),
        F.col("positions").cast("array<int>").alias("positions"))


def read_id_rows(spark: SparkSession, path: str, key: str = "term") -> DataFrame:
    """``(key, doc_id)`` of an inverted text index with lines of any length. Keys hold
    no space."""
    records = _records(spark, path, " ")
    lines = F.split("value", "\n")  # the last id of a line and the head of the next

    def row(part: Column) -> Column:
        tab = F.contains(part, F.lit("\t"))
        return F.struct(
            F.when(tab, F.trim(F.substring_index(part, "\t", 1))).alias("head"),
            F.trim(F.substring_index(part, "\t", -1)).alias("piece"))

    rows = records.select(*_RANGE, F.explode(F.transform(lines, row)).alias("row")).select(
        *_RANGE, "row.head", F.when(F.col("row.piece") != "", F.col("row.piece")).alias("piece"))
    return _with_heads(rows, first_is_head=False).select(
        F.col("head").alias(key), F.col("piece").cast("bigint").alias("doc_id"))
