"""Exact deduplication: one document stays of each group of equal texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import BROADCAST_ROWS, join_groups, small_side
from lexispark.scale import materialize

WHITE = r"[\x20\x09-\x0D]+"


def normalized(text: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    content_hash: Callable[[Column], Column] = F.md5,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (the smallest id whose text is
    equal), group_size, kept (whether this row stays) and text_sha256.

    Rows meet by a 128-bit content hash; only hashes seen twice have their texts
    compared, byte by byte, by grouping on (hash, text). The grouping has a
    map-side part, so a group that holds a third of all rows shuffles one row per
    task. A hash that covers different texts is told apart by joining its texts.

    Null texts equal the empty text. Rows that repeat an id are treated alike: both
    stay or both go. A row without an id stays only if its group has no id at all.
    Other columns of ``docs`` are ignored.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), normalized(text).alias("norm"))
    hashed = source.withColumn("hash", content_hash(F.col("norm")))
    slim = materialize(
        hashed.select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256")), "exact-rows")
    repeated = materialize(
        slim.groupBy("hash").count().where("count > 1").select("hash"), "exact-hashes")
    # Without a small set of repeated hashes all texts are grouped: a join with
    # the hashes would shuffle all texts as well.
    few = repeated.limit(broadcast_rows + 1).count() <= broadcast_rows
    compared = hashed.join(F.broadcast(repeated), "hash", "left_semi") if few else hashed
    texts = materialize(_by_text(compared, "hash").drop("norm"), "exact-texts")
    collided = materialize(
        texts.groupBy("hash").count().where("count > 1").select("hash"), "exact-collided")
    groups = texts.where("group_size > 1")
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    if collided.isEmpty():
        joined = join_groups(slim, groups, "hash", "group_size", _row_text()).select(*columns)
    else:
        mixed = small_side(collided, broadcast_rows)
        clear = materialize(slim.join(mixed, "hash", "left_anti"), "exact-clear")
        single = materialize(groups.join(mixed, "hash", "left_anti"), "exact-single")
        joined = join_groups(clear, single, "hash", "group_size", _row_text()).select(*columns)
        apart = hashed.join(mixed, "hash", "left_semi").withColumn(
            "text_sha256", F.sha2("norm", 256))
        joined = joined.union(
            apart.join(_by_text(apart).drop("hash"), "norm").select(*columns))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def _by_text(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _row_text() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))


def drop_exact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose text equals that of a row with a smaller id."""
    dropped = exact_groups(docs, text, doc_id).where("not kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__text")).distinct()
    dropped = materialize(dropped, "exact-dropped")
    same = docs[doc_id].eqNullSafe(dropped["__id"]) & (
        F.sha2(normalized(text), 256) == dropped["__text"])
    return docs.join(small_side(dropped), same, "left_anti")
