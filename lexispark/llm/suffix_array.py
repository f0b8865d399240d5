"""Suffix-array deduplication: remove byte strings of some length that occur elsewhere.

In the order of suffixes, the nearest neighbors at smaller positions are the earlier
places where most of a suffix was seen before; how much of it that is, is the
longest previous factor. A position whose previous factor reaches the window
starts a later copy. The same with larger positions finds the first ones.

One suffix array of a corpus would not fit a task, so its windows are dealt to shards
such that equal windows meet. The smallest hash among the short strings in a window
is its anchor. A piece is a run of windows of one document with one anchor, as the bytes
they cover; where an anchor occurs once, nothing repeats. Of equal pieces, known by 128 bits
and their length, the first goes to the shard: it is the previous factor of all others.

A short string may be common while what surrounds it differs. An anchor with more
different pieces than a shard holds is extended: windows with more of themselves before
the anchor take half of all that is left along on that side, others behind it, and the
extended string is their anchor. Anchors grow until their pieces fit or are whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import join_lists, small_side
from lexispark.llm.text import byte_hasher, flat, ranges, slices
from lexispark.scale import materialize

WINDOW = 400
ANCHOR = 64  # bytes hashed for an anchor
PIECE_WINDOWS = 1024  # windows of a piece
SHARD_BYTES = 700_000  # bytes of the pieces of one suffix array, on average
ANCHOR_PIECES = 1100  # different pieces with one anchor; more than PIECE_WINDOWS
LAST_ID = (1 << 63) - 1
DOCUMENT = ("doc_id", "version")
DOCUMENT_TYPE = "doc_id bigint, version bigint"
# What tells pieces apart.
PIECE = ("anchor", "piece1", "piece2", "windows")
PIECE_TYPE = "anchor bigint, piece1 bigint, piece2 bigint, windows int"

_U = np.uint64


# --- suffix arrays


class Suffixes:
    """Order of the suffixes at ``starts`` of ``data`` by their first ``window`` bytes.

    The first ranks are those of as many bytes as fit 64 bits, each as its number among the
    bytes that occur. Ranks of three times the length come from three neighboring ranks (of
    two in over two million bytes), those of the window from strings that overlap.
    ``starts`` leave room for a window before the end of ``data``.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, window: int):
        self.window, self.starts = window, starts
        used, numbers = np.unique(data, return_inverse=True)
        bits = max(int(len(used) - 1).bit_length(), 1)
        length = min(64 // bits, window)
        keys = np.zeros(max(len(data) - length + 1, 0), np.uint64)
        for i in range(length):
            keys = (keys << _U(bits)) | numbers[i:i + len(keys)].astype(np.uint64)
        ranks = _ranked(keys)
        self.levels: list[tuple[int, np.ndarray]] = [(1, numbers), (length, ranks)]
        many, width = (3, 21) if len(data) <= 1 << 21 else (2, 32)
        while length * many <= window:
            n = max(len(ranks) - (many - 1) * length, 0)
            places = [slice(i * length, i * length + n) for i in range(many)]
            ranks = _ranked(_joined(ranks, places, width))
            length *= many
            self.levels.append((length, ranks))
        last = window - length
        steps = [0, last] if last <= length else [0, length, last]
        self.classes = _ranked(_joined(ranks, [starts + i for i in steps], width))
        self.order = np.argsort(self.classes, kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes of ``starts[a]`` and ``starts[b]`` share, up to
        the window; -1 means no suffix and shares none."""
        none = (a < 0) | (b < 0)
        same = (self.classes[a] == self.classes[b]) & ~none
        x, y = self.starts[a], self.starts[b]
        shared = np.zeros(len(x), np.int64)
        levels = [(length, ranks) for length, ranks in reversed(self.levels)
                  for _ in range(2 if length > 1 else 64)]  # a level may fit twice
        for length, ranks in levels:
            here = np.flatnonzero((shared + length <= self.window) & ~same)
            i, j = x[here] + shared[here], y[here] + shared[here]
            inside = np.maximum(i, j) < len(ranks)
            here, i, j = here[inside], i[inside], j[inside]
            shared[here[ranks[i] == ranks[j]]] += length
        return np.where(none, 0, np.where(same, self.window, shared))


def _joined(ranks: np.ndarray, places: list, bits: int) -> np.ndarray:
    """The ranks at some places, of so many bits each, as one number."""
    out = ranks[places[0]].astype(np.uint64)
    for place in places[1:]:
        out = (out << _U(bits)) | ranks[place].astype(np.uint64)
    return out


def _ranked(keys: np.ndarray) -> np.ndarray:
    """Their ranks, equal ones sharing one."""
    order = np.argsort(keys)
    keys = keys[order]
    ranks = np.empty(len(order), np.uint32)
    ranks[order] = np.cumsum(np.concatenate(([False], keys[1:] != keys[:-1]))[:len(keys)])
    return ranks


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value; -1 if none."""
    found = np.arange(len(values)) - 1
    wrong = np.flatnonzero(found >= 0)
    wrong = wrong[values[found[wrong]] > values[wrong]]
    while len(wrong):  # what lies between a place and its candidate is larger
        found[wrong] = found[found[wrong]]
        wrong = wrong[found[wrong] >= 0]
        wrong = wrong[values[found[wrong]] > values[wrong]]
    return found


def previous_factors(suffixes: Suffixes, positions: np.ndarray) -> np.ndarray:
    """For each suffix how many of its first bytes, up to the window, also start at a
    smaller of ``positions``: the more of what it shares with the previous and with the
    next smaller position in the order of suffixes."""
    order = suffixes.order
    place = positions[order]
    before = nearest_smaller(place)
    after = nearest_smaller(place[::-1])[::-1]
    after = np.where(after < 0, -1, len(order) - 1 - after)
    best = np.zeros(len(order), np.int64)
    for other in (before, after):
        shared = suffixes.common(order, np.where(other < 0, -1, order[other]))
        np.maximum(best, shared, out=best)
    out = np.empty(len(order), np.int64)
    out[order] = best
    return out


def reaching(suffixes: Suffixes, positions: np.ndarray) -> np.ndarray:
    """Where ``previous_factors`` are the whole window. Suffixes that share their window
    with no other need not be looked at: they are nobody's factor of that length."""
    order, classes = suffixes.order, suffixes.classes
    ordered = classes[order]
    same = ordered[1:] == ordered[:-1]
    some = order[np.append(same, False) | np.append(False, same)]
    place, kind = positions[some], classes[some]
    out = np.zeros(len(order), bool)
    for step in (1, -1):
        found = nearest_smaller(place[::step])
        out[some[::step]] |= (found >= 0) & (kind[::step][found] == kind[::step])
    return out


# --- pieces


def extensions(window: int, anchor: int) -> list[int]:
    """The lengths an anchor takes: half of what is left is added each time."""
    sizes = [anchor]
    while sizes[-1] < window:
        sizes.append(sizes[-1] + max(1, (window - sizes[-1]) // 2))
    return sizes


def _window_anchors(data: np.ndarray, window: int, sizes: list[int]):
    """The anchor of the window at each byte, extended to the last of ``sizes``, and where
    it starts."""
    hasher = byte_hasher(data)
    every = np.arange(len(data) - sizes[0] + 1)
    low, width, have = hasher(every, every + sizes[0]), window - sizes[0] + 1, 1
    place = every.astype(np.int32)
    while have < width:  # smallest of ``have`` neighbors, and where the first such is
        step = min(have, width - have)
        left, right = low[:len(low) - step], low[step:]
        place = np.where(right < left, place[step:], place[:len(place) - step])
        low, have = np.minimum(left, right), have + step
    if len(sizes) == 1:
        return low, place
    at = every[:len(low)]
    for size, longer in zip(sizes[:-1], sizes[1:], strict=True):
        before, behind = place - at, at + window - place - size
        place = np.where(before > behind, place - (longer - size), place)
    return hasher(place, place + sizes[-1]), place


def _piece_rows(docs: DataFrame, window: int, sizes: list[int], longest: int) -> DataFrame:
    """(anchor, piece1, piece2, windows, doc_id, version, start, places): the pieces of all
    windows, or of those in the list ``runs`` of (start, windows) if ``docs`` has one. The
    anchor lies in one place of the piece, or else ``places`` is 2."""
    listed = "runs" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offs = flat(part.column(2))
            if len(data) < window:
                continue
            anchors, place = _window_anchors(data, window, sizes)
            doc = np.repeat(np.arange(part.num_rows), np.diff(offs))[:len(anchors)]
            at = np.flatnonzero(np.arange(len(anchors)) + window <= offs[doc + 1])
            if listed:
                starts, count, row = _list_fields(part.column(3), "start", "windows")
                wanted = np.zeros(len(anchors), bool)
                wanted[ranges(offs[row] + starts, count)] = True
                at = at[wanted[at]]
            if not len(at):
                continue
            anchors, place, doc = anchors[at], place[at], doc[at]
            first = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (
                np.diff(at) != 1) | (doc[1:] != doc[:-1]))))
            count = np.diff(np.append(first, len(at)))
            parts = -(-count // longest)  # long runs are cut, from their start
            index = ranges(np.zeros(len(first), np.int64), parts)
            first = np.repeat(first, parts) + index * longest
            count = np.minimum(np.repeat(count, parts) - index * longest, longest)
            begin, doc = at[first], doc[first]
            places = 1 + (place[first + count - 1] != place[first])
            end = begin + count + window - 1
            one, two = byte_hasher(data)(begin, end), byte_hasher(data ^ np.uint8(0xA5))(begin, end)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.view(np.int64)) for x in (anchors[first], one, two)),
                 pa.array(count.astype(np.int32)),
                 part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)),
                 pa.array((begin - offs[doc]).astype(np.int64)),
                 pa.array(places.astype(np.int32))],
                [*PIECE, *DOCUMENT, "start", "places"])

    return docs.mapInArrow(run, f"{PIECE_TYPE}, {DOCUMENT_TYPE}, start bigint, places int")


def _list_fields(lists: pa.Array, *names: str):
    """Fields of a column of lists of structs, flat, and the row of each."""
    items = lists.flatten()
    fields = {f.name: i for i, f in enumerate(items.type)}
    size = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return (*(items.field(fields[n]).to_numpy(zero_copy_only=False) for n in names),
            np.repeat(np.arange(len(lists)), size))


def _per_document(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """The fields of all rows of a document as a set."""
    return materialize(rows.groupBy(*DOCUMENT).agg(
        F.collect_set(F.struct(*fields)).alias(name)), f"suffix-{name}")


def _settled(source: DataFrame, window: int, anchor: int, longest: int,
             anchor_pieces: int) -> tuple[DataFrame, DataFrame]:
    """All pieces whose anchor occurs twice, with anchors extended as far as needed; and
    of equal ones the first, with their number ``n``."""
    sizes = extensions(window, anchor)
    pieces, kept, firsts = source, [], []
    for level in range(len(sizes)):
        rows = materialize(_piece_rows(pieces, window, sizes[:level + 1], longest),
                           "suffix-pieces")
        counted = rows.groupBy("anchor").agg(F.sum("places").alias("places"))
        shared = small_side(materialize(
            counted.where("places > 1").select("anchor"), "suffix-anchors"))
        rows = materialize(
            rows.drop("places").join(shared, "anchor", "left_semi"), "suffix-shared")
        first = materialize(rows.groupBy(*PIECE).agg(
            F.count("*").alias("n"), F.min(F.struct(*DOCUMENT, "start")).alias("first"))
            .select(*PIECE, "n", "first.*"), "suffix-first")
        large = materialize(
            first.groupBy("anchor").agg(F.count("*").alias("pieces"))
            .where(F.col("pieces") > anchor_pieces).select("anchor"), "suffix-large")
        if level == len(sizes) - 1 or large.isEmpty():
            kept.append(rows)
            firsts.append(first)
            break
        large = small_side(large)
        kept.append(rows.join(large, "anchor", "left_anti"))
        firsts.append(first.join(large, "anchor", "left_anti"))
        lists = _per_document(
            rows.join(large, "anchor", "left_semi"), "runs", "start", "windows")
        pieces = join_lists(source, lists, None, "inner", DOCUMENT).select(
            *DOCUMENT, "text", "runs")
    every, one = kept[0], firsts[0]
    for more, first in zip(kept[1:], firsts[1:], strict=True):
        every, one = every.union(more), one.union(first)
    return every, one


# --- shards


def _piece_texts(docs: DataFrame, window: int) -> DataFrame:
    """The pieces in the list ``firsts`` of each document, with their bytes."""
    names = (*PIECE, "n", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offs = flat(part.column(2))
            *fields, row = _list_fields(part.column(3), *names)
            size = fields[3].astype(np.int64) + window - 1
            cut = data[ranges(offs[row] + fields[5], size)]
            where = np.concatenate(([0], np.cumsum(size)))
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer(where), pa.py_buffer(cut)])
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, fields), *(part.column(i).take(pa.array(row)) for i in (0, 1)),
                 texts.cast(pa.binary())], [*names, *DOCUMENT, "bytes"])

    return docs.mapInArrow(
        run, f"{PIECE_TYPE}, n bigint, start bigint, {DOCUMENT_TYPE}, bytes binary")


def _judged(window: int, first_stays: bool):
    """For the pieces of one shard the spans of bytes that go: of ``place`` 0, the first
    piece among equal ones, and of 1, all others of them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in (*DOCUMENT, "start")])
        place = [table.column(c).to_numpy() for c in (*DOCUMENT, "start")]
        again = np.logical_and.reduce([c[1:] == c[:-1] for c in place])
        table = table.filter(pa.array(np.concatenate(([True], ~again)))).combine_chunks()
        wide = table.column("bytes").chunk(0).cast(pa.large_binary())
        offs = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
        data = np.frombuffer(wide.buffers()[2], np.uint8)[offs[0]:offs[-1]]
        begin, count = offs[:-1] - offs[0], table.column("windows").to_numpy().astype(np.int64)
        starts = ranges(begin, count)
        suffixes = Suffixes(data, starts, window)
        gone = reaching(suffixes, starts)
        if not first_stays:
            gone |= reaching(suffixes, -starts)
        piece = np.repeat(np.arange(len(count)), count)
        copied = table.column("n").to_numpy() > 1
        if not first_stays:
            gone |= copied[piece]
        edge = piece[1:] != piece[:-1]
        low = np.flatnonzero(gone & np.concatenate(([True], edge | ~gone[:-1])))
        high = np.flatnonzero(gone & np.concatenate((edge | ~gone[1:], [True])))
        others = np.flatnonzero(copied)
        of = np.concatenate((piece[low], others))
        at = starts - begin[piece]
        return pa.table({
            **{c: table.column(c).take(pa.array(of)) for c in (*PIECE, *DOCUMENT, "start")},
            "place": pa.array(np.repeat(np.arange(2), (len(low), len(others))).astype(np.int32)),
            "begin": pa.array(np.concatenate((at[low], np.zeros(len(others)))).astype(np.int32)),
            "end": pa.array(np.concatenate(
                (at[high] + window, count[others] + window - 1)).astype(np.int32))})

    return run


def repeated_spans(source: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   first_stays: bool = True, shard_bytes: int = SHARD_BYTES,
                   piece_windows: int = PIECE_WINDOWS,
                   anchor_pieces: int = ANCHOR_PIECES) -> DataFrame:
    """A written table (doc_id, version, spans): for each document of ``source``
    (doc_id, version, text) with bytes to remove the spans [begin, end) of them."""
    rows, first = _settled(source, window, anchor, piece_windows, anchor_pieces)
    total = first.agg(F.sum(F.col("windows") + window - 1)).first()[0] or 0
    lists = _per_document(first, "firsts", *PIECE, "n", "start")
    texts = _piece_texts(
        join_lists(source, lists, None, "inner", DOCUMENT).select(*DOCUMENT, "text", "firsts"),
        window)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(total // shard_bytes + 1))
    judged = materialize(
        texts.withColumn("shard", shard).groupBy("shard").applyInArrow(
            _judged(window, first_stays),
            f"{PIECE_TYPE}, {DOCUMENT_TYPE}, start bigint, place int, begin int, end int")
        .select(*PIECE, *[F.col(c).alias(f"first_{c}") for c in (*DOCUMENT, "start")],
                "place", "begin", "end"), "suffix-judged")
    is_first = F.lit(True)
    for c in (*DOCUMENT, "start"):
        is_first &= F.col(c) == F.col(f"first_{c}")
    spans = rows.join(judged, [*PIECE]).where(
        F.when(is_first, 0).otherwise(1) == F.col("place")).select(
        *DOCUMENT, (F.col("start") + F.col("begin")).alias("begin"),
        (F.col("start") + F.col("end")).alias("end"))
    return _per_document(spans, "spans", "begin", "end")


def without_repeats(docs: DataFrame, window: int = WINDOW, first_stays: bool = True,
                    doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (runs of removed
    bytes) and kept (the bytes that stay).

    Texts are taken as UTF-8 bytes. A byte is removed if a string of ``window`` bytes
    covers it that also starts in an earlier place, or with ``first_stays`` unset in any
    other; strings may overlap, lie within one document and are judged on the input. What
    is kept may cut a character apart. Places are ordered by id, a null id last, then by a
    hash of the text, then within it. Rows that repeat an id and a text count as others of each
    other, but share what stays of the first. A null text is empty. A long text takes part in many
    shards and one row of numbers per piece of it. Other columns are ignored.
    """
    order = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID))
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        order.alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("text"))
    spans = repeated_spans(source, window, first_stays=first_stays, **options)
    joined = join_lists(source, spans, None, "left", DOCUMENT).select("doc_id", "text", "spans")
    kept = joined.mapInArrow(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return kept.withColumn("doc_id", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        data, offs = flat(part.column(1))
        begin, end, row = _list_fields(part.column(2), "begin", "end")
        step = np.zeros(len(data) + 1, np.int64)
        np.add.at(step, offs[row] + begin, 1)
        np.add.at(step, offs[row] + end, -1)
        gone = np.cumsum(step)[:-1] > 0
        head = np.zeros(len(data) + 1, bool)
        head[offs] = True
        starts = gone & np.concatenate(([True], ~gone[:-1]))[:len(gone)] | gone & head[:-1]
        removed, spans = (np.concatenate(([0], np.cumsum(x))) for x in (gone, starts))
        removed, spans = removed[offs], np.diff(spans[offs])
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), part.num_rows,
            [None, pa.py_buffer(offs - removed), pa.py_buffer(data[~gone])])
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(offs)), pa.array(np.diff(removed)),
             pa.array(spans), kept.cast(pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
