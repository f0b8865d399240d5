"""Jaccard self-join on word shingles, with Bayesian pruning of candidate pairs.

Documents that share a band of MinHash values are candidates. Pairs compare their
MinHash values a few at a time, and go as soon as the posterior probability that
their similarity reaches the threshold falls below a tolerance. What is left forms
candidate groups, inside which every pair is verified exactly on its shingle sets.

Pairs are enumerated inside tasks only, block against block, and a task emits per
document its number of links and one edge towards its class: rows stay linear in
the number of documents, however large a group of near copies is.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import components, join_groups, small_side
from lexispark.llm.line_dedup import keyed
from lexispark.llm.text import (
    content_keys,
    flat,
    grams,
    list_array,
    mix,
    ranges,
    slices,
    span_hashes,
    word_hashes,
    word_spans,
)
from lexispark.scale import materialize

SHINGLE = 5
THRESHOLD = 0.8
# A pair at the threshold shares no band with probability (1 - 0.8**4)**25 < 2e-6.
BANDS, BAND_ROWS = 25, 4
HASHES = BANDS * BAND_ROWS
STEP = 20  # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-6
BLOCK = 1000  # documents of one block; pairs are taken block against block
BLOCK_SHINGLES = 1_000_000
PACK_ROWS = 4000  # rows of small groups that share a task call

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_FACTOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """Shingle hashes of all texts and each text's offset, and the texts' words: hash
    and offset. A text with fewer words than a shingle, but not none, has one shingle."""
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    _, hashes, at = grams(words, first, size)
    count = np.diff(at) if len(at) else np.zeros(len(offsets) - 1, np.int64)
    short = (np.diff(first) > 0) & (count == 0)
    whole = span_hashes(words, first[:-1][short], first[1:][short])
    count = count + short
    out = np.concatenate(([0], np.cumsum(count)))
    values = np.empty(int(out[-1]), dtype=np.uint64)
    long = ~short & (count > 0)
    values[ranges(out[:-1][long], count[long])] = hashes
    values[out[:-1][short]] = whole
    return values, out, words, first


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, one row per text; texts without shingles have zeros."""
    out = np.zeros((len(offsets) - 1, HASHES), dtype=np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        starts = offsets[:-1][filled]
        for i in range(HASHES):
            out[filled, i] = np.minimum.reduceat((values ^ _XOR[i]) * _FACTOR[i], starts)
    return out


def band_keys(minhashes: np.ndarray) -> np.ndarray:
    n = len(minhashes)
    starts = np.arange(n * BANDS) * BAND_ROWS
    keys = span_hashes(mix(minhashes).ravel(), starts, starts + BAND_ROWS).reshape(n, BANDS)
    return mix(keys ^ np.arange(BANDS, dtype=np.uint64))


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values, the matches below which a pair goes.

    With a uniform prior, the posterior probability that the similarity reaches t
    after c matches of n is that of at most c successes in n + 1 trials at t.
    """
    least = {}
    for n in [*range(STEP, HASHES, STEP), HASHES]:
        tail, c = 0.0, 0
        while c <= n:
            tail += comb(n + 1, c) * threshold**c * (1 - threshold) ** (n + 1 - c)
            if tail >= tolerance:
                break
            c += 1
        least[n] = c
    return least


def likely(left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which pairs of signature rows are not pruned."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    done = 0
    for n, c in least.items():
        a, b = left[alive, done:n], right[alive, done:n]
        matches = matches + (a == b).sum(axis=1)
        keep = matches >= c
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def _pairs(n: int, m: int, same: bool, limit: int = 50_000):
    """Index pairs of an n by m block, or of its upper half, a slice at a time."""
    step = max(1, limit // max(m, 1))
    for at in range(0, n, step):
        i = np.arange(at, min(at + step, n))
        if same:
            i, j = np.repeat(i, m - 1 - i), ranges(i + 1, m - 1 - i)
        else:
            i, j = np.repeat(i, m), np.tile(np.arange(m), len(i))
        yield i, j


def joined_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node reached over the edges a-b."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all() and (label[a] == label[b]).all():
            break
    return label


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal keys."""
    change = np.zeros(len(keys[0]), dtype=bool)
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.concatenate(([0], np.flatnonzero(change), [len(change)])) if len(change) else (
        np.zeros(1, np.int64))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _blocks(rows: DataFrame, group: str, blocks: str, node: str, packs: Column) -> DataFrame:
    """Add what assigns rows to task calls: a group of one block shares a call with
    others; one of several blocks sends each row to all block pairs of its block."""
    block = F.pmod(F.xxhash64(node, F.lit(1)), F.col(blocks)).cast("int")
    rows = rows.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    rows = rows.withColumn("__other", other)
    return rows.select(
        "*",
        F.when(F.col(blocks) > 1, F.col(group)).otherwise(
            F.pmod(F.xxhash64(group, F.lit(2)), packs)).alias("pack"),
        (F.col(blocks) > 1).alias("large"),
        F.least("block", "__other").alias("low"),
        F.greatest("block", "__other").alias("high"),
    ).drop("__other", blocks)


_CALL = ("large", "pack", "low", "high")


def _candidate_edges(least: dict[int, int]):
    def run(table: pa.Table) -> pa.Table:
        key, node, block = (_column(table, c) for c in ("key", "node", "block"))
        order = np.lexsort((node, block, key))
        key, node, block = key[order], node[order], block[order]
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16)
        sig = sig.reshape(len(key), HASHES)[order]
        large, low, high = (table.column(c)[0].as_py() for c in ("large", "low", "high"))
        left, right = [], []
        at = _runs(key)
        for s, e in zip(at[:-1], at[1:], strict=True):
            split = s + int((block[s:e] == low).sum()) if large and low != high else None
            rows, columns = (slice(s, e), slice(s, e)) if split is None else (
                slice(s, split), slice(split, e))
            found_a, found_b = [], []
            for i, j in _pairs(rows.stop - rows.start, columns.stop - columns.start,
                               split is None):
                alive = likely(sig[rows][i], sig[columns][j], least)
                found_a.append(i[alive] + rows.start - s)
                found_b.append(j[alive] + columns.start - s)
            if not found_a:
                continue
            label = joined_labels(e - s, np.concatenate(found_a), np.concatenate(found_b))
            linked = np.flatnonzero(label != np.arange(e - s))
            left.append(node[s + label[linked]])
            right.append(node[s + linked])
        empty = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(left or empty), "b": np.concatenate(right or empty)})

    return run


def _verified(threshold: Fraction):
    def links(sets: list[np.ndarray], split: int | None):
        """Pairs of sets whose Jaccard similarity reaches the threshold."""
        size = np.array([len(s) for s in sets])
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        at = _runs(values)
        count = np.diff(at)
        shared = np.repeat(count > 1, count)
        column = np.repeat(np.cumsum(count > 1) - 1, count)[shared]
        owner = owner[shared]
        lefts = len(sets) if split is None else split
        others = split or 0  # with a split, the sets before it meet those after it only
        common = np.zeros((lefts, len(sets) - others), dtype=np.int32)
        width = max(1, 4_000_000 // len(sets))
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (first, first + width))
            part = np.zeros((len(sets), width), dtype=np.float32)
            part[owner[a:b], column[a:b] - first] = 1
            common += np.rint(part[:lefts] @ part[others:].T).astype(np.int32)
        found = [(np.zeros(0, np.int64),) * 2]
        for at in range(0, lefts, 256):  # some rows at a time, for memory
            some = common[at:at + 256].astype(np.int64)
            union = size[at:at + len(some), None] + size[None, others:] - some
            near = some * threshold.denominator >= threshold.numerator * union
            i, j = np.nonzero(near & (some > 0))
            i, j = i + at, j + others
            found.append((i[i < j], j[i < j]))
        a, b = zip(*found, strict=True)
        return np.concatenate(a), np.concatenate(b)

    def run(table: pa.Table) -> pa.Table:
        names = ("component", "node", "block", "copies")
        component, node, block, copies = (_column(table, c) for c in names)
        order = np.lexsort((node, block, component))
        fresh = np.ones(len(order), dtype=bool)  # a repeated id counts once
        fresh[1:] = (node[order][1:] != node[order][:-1]) | (
            component[order][1:] != component[order][:-1])
        order = order[fresh]
        component, node, block, copies = (
            c[order] for c in (component, node, block, copies))
        lists = table.column("shingles").combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        large, low, high = (table.column(c)[0].as_py() for c in ("large", "low", "high"))
        count = np.zeros(len(node), dtype=np.int64)
        towards = node.copy()
        at = _runs(component)
        for s, e in zip(at[:-1], at[1:], strict=True):
            sets = [values[ends[i]:ends[i + 1]] for i in order[s:e]]
            split = int((block[s:e] == low).sum()) if large and low != high else None
            a, b = links(sets, split)
            np.add.at(count, s + a, copies[s + b])
            np.add.at(count, s + b, copies[s + a])
            label = joined_labels(e - s, a, b)
            towards[s:e] = node[s + label]
        return pa.table({"node": node, "links": count, "towards": towards})

    return run


def _shingle_rows(rows: DataFrame, size: int) -> DataFrame:
    """The text of each row replaced by its sorted distinct shingles."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values, at, _, _ = shingles(*flat(part.column(part.schema.get_field_index("text"))),
                                        size)
            sets = [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            ends = np.cumsum([0, *map(len, sets)])
            flat_sets = np.concatenate(sets).view(np.int64)
            columns = [part.column(part.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, list_array(flat_sets, ends, pa.int64())], [*kept, "shingles"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{kinds}, shingles array<bigint>")


def _signature_rows(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values, at, words, first = shingles(*flat(part.column(2)), size)
            minhash = signatures(values, at)
            sig = (mix(minhash) & np.uint64(0xFFFF)).astype(np.uint16)
            count = np.diff(at)
            has = count > 0
            keys = band_keys(minhash[has]).view(np.int64)
            copy = pa.array(content_keys(words, first), pa.string())
            ends = np.concatenate(([0], np.cumsum(has))) * BANDS
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), copy, pa.array(count.astype(np.int64)),
                 pa.array([r.tobytes() for r in sig], pa.binary()),
                 list_array(keys.ravel(), ends, pa.int64())],
                ["doc_id", "version", "copy", "size", "sig", "bands"])

    return docs.mapInArrow(
        run, "doc_id bigint, version bigint, copy string, size bigint, sig binary, "
             "bands array<bigint>")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id and n_links.

    Words are the runs of characters other than ASCII white space, unchanged. Two
    documents are linked if the Jaccard similarity of their sets of ``shingle``-word
    shingles is at least ``threshold``; n_links counts a document's links to other
    documents, copies included, and class_id is the smallest id among those it
    reaches over links. Shingles are compared by 64-bit hashes, copies (equal word
    sequences) by 128-bit ones; copies are collapsed before the join.

    A text with fewer words than a shingle is one shingle. A text without words,
    null included, has no links and a class of its own. Rows that share an id are told
    apart by their texts; copies that share one count as one document, and so do copies
    with a null id, which do not count beside copies that have one. The class of a row
    without an id is that of the rows it reaches that have one, else null. Other columns
    are ignored.
    """
    return _classified(docs, threshold, shingle, doc_id, text, block).select(
        "doc_id", "class_id", "n_links")


def _classified(docs, threshold, shingle, doc_id, text, block) -> DataFrame:
    """(doc_id, version, row, first, class_id, n_links) per row of ``docs``: its number,
    the place (id with nulls last, version, row) of the first row of its class, null for
    a text without words, and what ``near_duplicates`` tells. A node is the number of
    the first row of a group of copies."""
    order, version = keyed(doc_id, text)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), version,
                         F.col(text).alias("text"), order.alias("order"))
    rows = _signature_rows(source.select("doc_id", "version", "text"), shingle)
    rows = materialize(
        rows.withColumn("row", F.monotonically_increasing_id()), "ngram-signatures")
    place = F.struct(keyed("doc_id", "copy")[0].alias("order"), "version", "row")
    copies = rows.where("copy is not null").groupBy("copy").agg(
        F.min(place).alias("first"), F.min("doc_id").alias("least"),
        F.count_distinct("doc_id").alias("copies"), F.count("*").alias("rows"))
    copies = materialize(
        copies.withColumn("copies", F.greatest("copies", F.lit(1)))
        .withColumn("node", F.col("first.row")), "ngram-copies")
    nodes = rows.join(copies, rows.row == copies.node).select(
        "node", "size", "sig", "bands", "copies", "rows", "first.order", copies["first.version"])
    nodes = materialize(nodes, "ngram-nodes")
    candidates = _candidates(nodes, threshold, block)
    verified = _verify(source, nodes, candidates, threshold, shingle, block)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(
        verified.select(F.col("node").alias("a"), F.col("towards").alias("b")), "ngram-classes")
    members = materialize(
        classes.join(copies.select("node", "first", "least"), "node"), "ngram-class-members")
    best = materialize(members.groupBy("component").agg(
        F.min("first").alias("best"), F.min("least").alias("class_id")), "ngram-class-firsts")
    found = members.select("node", "component").join(small_side(best), "component")
    groups = copies.join(links, "node", "left").join(found, "node", "left").select(
        "copy", "rows", F.coalesce("best", "first").alias("first"),
        F.when(F.col("best").isNull(), F.col("least")).otherwise(F.col("class_id"))
        .alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    groups = materialize(groups, "ngram-groups")
    joined = join_groups(rows.select("doc_id", "version", "row", "copy"), groups, "copy",
                         "rows", F.col("row").cast("string"))
    return joined.select(
        "doc_id", "version", "row", "first",
        F.when(F.col("copy").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce(F.greatest("n_links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"))


def _candidates(nodes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, component): groups of nodes connected by pairs that were not pruned."""
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    buckets = materialize(
        banded.groupBy("key").count().where("count > 1").select(
            "key", F.ceil(F.col("count") / block).alias("blocks"), "count"), "ngram-buckets")
    total = buckets.agg(F.sum("count")).first()[0] or 0
    members = banded.join(buckets.drop("count"), "key")
    members = members.join(nodes.select("node", "sig"), "node")
    dealt = _blocks(members, "key", "blocks", "node", F.lit(total // PACK_ROWS + 1))
    least = least_matches(threshold, TOLERANCE)
    edges = dealt.groupBy(*_CALL).applyInArrow(_candidate_edges(least), "a bigint, b bigint")
    return components(edges, "ngram-candidates")


def _verify(source, nodes, candidates, threshold, shingle, block) -> DataFrame:
    """A written table (node, links, towards): links counted per block pair."""
    members = materialize(
        candidates.join(nodes.drop("sig", "bands"), "node"), "ngram-members")
    sizes = materialize(members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_SHINGLES))
        .alias("blocks")), "ngram-sizes")
    members = materialize(members.join(sizes, "component").drop("size"), "ngram-members")
    several = members.where("rows > copies").limit(1).count() > 0
    texts = source.drop("doc_id").join(
        small_side(members.drop("rows")), ["order", "version"]).drop("order", "version")
    if several:  # rows repeated whole: the text of a node once
        texts = texts.dropDuplicates(["node"])
    dealt = _blocks(
        _shingle_rows(texts, shingle), "component", "blocks", "node",
        F.lit(members.count() // (PACK_ROWS // 8) + 1))
    exact = Fraction(threshold).limit_denominator(10_000)
    return materialize(
        dealt.groupBy(*_CALL).applyInArrow(
            _verified(exact), "node bigint, links bigint, towards bigint"), "ngram-links")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are first in their class, by id, nulls last, then by a
    hash of the text, unchanged. Of rows with equal id and text any one stays. A text
    without words is a class of its own."""
    rows = _classified(docs, THRESHOLD, SHINGLE, doc_id, text, BLOCK)
    order = keyed("doc_id", "version")[0]
    others = materialize(
        rows.where("row <> first.row").select(
            order.alias("__order"), F.col("version").alias("__of"),
            ((order != F.col("first.order")) | (F.col("version") != F.col("first.version")))
            .alias("__goes")).distinct(), "ngram-dropped")
    order, version = keyed(doc_id, text)

    def same(df):
        return (order == df["__order"]) & (version == df["__of"])

    gone = others.where("__goes").drop("__goes")
    kept = docs.join(small_side(gone), same(gone), "left_anti")
    repeated = others.where("not __goes").drop("__goes")
    if repeated.limit(1).count() == 0:
        return kept
    few = small_side(repeated)
    once = kept.join(few, same(repeated), "left_semi").withColumns(
        {"__order": order, "__of": version}).dropDuplicates(["__order", "__of"])
    return kept.join(few, same(repeated), "left_anti").unionByName(once.drop("__order", "__of"))
