"""Helpers shared by the operators: checked broadcasts, joins that survive hot
keys, and connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.scale import materialize

# A frame is broadcast only after its rows were counted and found below this
# bound. Rows here are a few numbers wide, unless a call states another bound.
BROADCAST_ROWS = 200_000
# Lists per row are broadcast if they hold no more numbers than this.
BROADCAST_NUMBERS = 1_000_000
# A key with more than one row in so many is hot; there are fewer such keys than this.
HOT_SHARE = 1000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, hinted for broadcast if it has no more than ``rows`` rows.

    ``df`` should be a written table, so that counting reads only its footers.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str,
                unique: Column) -> DataFrame:
    """Left join of ``rows`` with ``groups``, which holds one row per ``key`` and
    in ``size`` the number of its rows; the join survives hot keys.

    Groups with over a thousandth of all rows, fewer than a thousand of them, are
    broadcast. Rows they answer leave the shuffle join: their key is replaced by
    a text from ``unique``, which no key equals. ``groups`` should be a written table.
    """
    kept = [c for c in groups.columns if c != key]
    least = max(2, rows.count() // HOT_SHARE)
    hot = groups.where(F.col(size) > least).select(
        key, *[F.col(c).alias(f"__hot_{c}") for c in kept])
    rest = groups.where(F.col(size) <= least).withColumnRenamed(key, "__key")
    marked = rows.join(F.broadcast(hot), key, "left")
    cold = F.when(F.col(f"__hot_{size}").isNull() & F.col(key).isNotNull(), F.col(key))
    marked = marked.withColumn("__key", F.coalesce(cold, F.concat(F.lit("row:"), unique)))
    joined = marked.join(rest, "__key", "left")
    return joined.select(
        *rows.columns, *[F.coalesce(f"__hot_{c}", c).alias(c) for c in kept])


def join_lists(docs: DataFrame, lists: DataFrame, numbers: int | None, how: str,
               key: Sequence[str]) -> DataFrame:
    """Join ``lists``, one row per ``key`` with ``numbers`` numbers in all of them, to
    ``docs``: by broadcast if they are few, else, or if they have not been counted, by a
    shuffle. ``how`` is inner or left."""
    if numbers is not None and numbers <= BROADCAST_NUMBERS:
        return docs.join(F.broadcast(lists), [*key], how)
    if how == "inner":  # drop other documents before their texts are shuffled
        docs = docs.join(small_side(lists.select(*key)), [*key], "left_semi")
    return docs.join(lists, [*key], how)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b), by alternating large-
    and small-star steps: returns (node, component), the component being its
    smallest node; nodes without an edge to another node are left out.

    Each round is a written table, so no lineage grows and a lost executor costs
    a re-read. The number of rounds grows with the logarithm of a component's
    size; rows never outnumber the edges.
    """
    up = edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    up = materialize(up, f"{label}-edges")
    before = None
    while True:
        after = up.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before or after[0] == 0:
            break
        before = after
        # large star: larger neighbours of a node go to its smallest neighbour
        both = up.union(up.select("b", "a"))
        least = materialize(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), f"{label}-least")
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
        large = large.where("a <> b").distinct()
        large = materialize(large, f"{label}-large")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = materialize(
            large.groupBy("b").agg(F.min("a").alias("m")), f"{label}-least")
        small = large.join(least, "b").where("a <> m").select(
            F.col("m").alias("a"), F.col("a").alias("b"))
        up = materialize(
            small.union(least.select(F.col("m").alias("a"), "b")).distinct(), f"{label}-edges")
    return up.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        up.select("a", "a").distinct())
