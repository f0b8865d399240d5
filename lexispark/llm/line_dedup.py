"""Line deduplication within an edit distance, by a segment-partition join.

Each line is cut into one segment more than the edits allowed, so a line within
that distance holds at least one of them unchanged, at nearly the same place. Lines
are indexed by (length, segment number, segment) and probed with the substrings of
equal place and length; pairs that meet are verified by a banded bit-parallel
edit distance. Distances count UTF-8 bytes.

Equal lines, of any length, need no such join: they meet by 128 bits of their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import components, small_side
from lexispark.llm.text import byte_hasher, flat, mix, slices
from lexispark.scale import materialize

EDITS = 2
MIN_BYTES = 20  # shorter lines are not linked by edits; equal ones are, however short
BROADCAST_LINES = 1_000_000  # numbers of lines to drop that may be broadcast, with their ids

DOCUMENT = ("doc_id", "version")
PLACE = (*DOCUMENT, "line")
LINE = ("lid", "more")  # 128 bits that stand for a line; the first 64 find candidates

_SPACES = np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8)
_U = np.uint64
_PAIR_BIT = _U(1) << np.random.default_rng(11).integers(0, 64, 1 << 16, dtype=np.uint64)


def keyed(doc_id: str, text: str) -> list[Column]:
    """What tells documents apart and orders them: id, nulls last, and a text hash."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit((1 << 63) - 1)).alias("doc_id"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("version")]


def line_spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all lines, line feeds left out, and each text's first line.
    A text has one line more than line feeds, so an empty text has one empty line."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((feeds, offsets[1:])), kind="stable")
    before = np.searchsorted(feeds, offsets)
    return starts, ends, before + np.arange(len(offsets))


def segment(length: np.ndarray, i: int, edits: int):
    """Start and length of segment ``i`` of ``edits + 1`` even ones, longer ones last."""
    base, longer = np.divmod(length, edits + 1)
    first_longer = edits + 1 - longer
    return i * base + np.maximum(i - first_longer, 0), base + (i >= first_longer)


def shifts(i: int, shorter: int, edits: int) -> range:
    """Where, relative to its own place, segment ``i`` of a line may stand in a line
    that is ``shorter`` bytes longer: what lies left of it bounds the shift by ``i``
    edits, what lies right of it by the others."""
    left, right = i, edits - i
    return range(max(-left, shorter - right), min(left, shorter + right) + 1)


def _key(content: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
    return mix(content ^ mix((length * 16 + i).astype(np.uint64))).view(np.int64)


def pair_sketch(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 parities of byte-pair counts per span. One edit flips at most four."""
    if len(data) < 2:
        return np.zeros(len(starts), dtype=np.int64)
    pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
    parity = np.zeros(len(data), dtype=np.uint64)
    np.bitwise_xor.accumulate(_PAIR_BIT[pairs], out=parity[1:])
    inner = np.maximum(ends - 1, starts)
    return (parity[np.minimum(inner, len(data) - 1)]
            ^ parity[np.minimum(starts, len(data) - 1)]).view(np.int64)


def within(left: list[bytes], right: list[bytes], edits: int) -> np.ndarray:
    """Whether each pair is within ``edits`` edits, all pairs side by side.

    For each number of errors e, a bit per diagonal of the band tells whether that
    diagonal is reached with e errors. On the next byte a match or a replacement
    stays on the diagonal, an insertion moves down one and a deletion up one.
    """
    n, m = (np.array([len(x) for x in side]) for side in (left, right))
    result = np.zeros(len(left), dtype=bool)
    order = np.argsort(np.maximum(n, m), kind="stable")
    at = 0
    while at < len(order):
        width = max(int(max(n[order[at]], m[order[at]])), 1)
        count = max(1, min(4096, 2_000_000 // width))
        some = order[at:at + count]
        result[some] = _within([left[i] for i in some], [right[i] for i in some],
                               n[some], m[some], edits)
        at += count
    return result


def _within(left, right, n, m, edits):
    rows, width, band = len(left), int(max(n.max(), m.max())), 2 * edits + 1
    a = np.full((rows, width + 2 * edits), 256, dtype=np.uint16)  # with room for the band
    b = np.full((rows, width), 257, dtype=np.uint16)
    for i in range(rows):
        a[i, edits:edits + n[i]] = np.frombuffer(left[i], dtype=np.uint8)
        b[i, :m[i]] = np.frombuffer(right[i], dtype=np.uint8)
    full = (1 << band) - 1
    reached = [np.full(rows, ((1 << e + 1) - 1) << edits & full) for e in range(edits + 1)]
    goal = n - m + edits
    found = np.zeros(rows, dtype=bool)
    possible = (goal >= 0) & (goal < band)
    bits = 1 << np.arange(band)
    for j in range(width + 1):
        ended = possible & (m == j)
        if ended.any():
            found |= ended & ((reached[edits] >> np.clip(goal, 0, band)) & 1).astype(bool)
        if j == width or not (reached[edits] * (m > j)).any():
            break
        same = (a[:, j:j + band] == b[:, j, None]) @ bits
        before = None
        following = []
        for e in range(edits + 1):
            now = reached[e] & same
            if e:
                less = reached[e - 1]
                now = (now | less | less >> 1 | before << 1) & full
            following.append(now)
            before = now
        reached = following
    return found


def not_blank(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which spans hold a byte other than ASCII white space."""
    seen = np.concatenate(([0], np.cumsum(~np.isin(data, _SPACES))))
    return seen[ends] > seen[starts]


def _rows(docs: DataFrame, emit, schema: str, least: int) -> DataFrame:
    """Run ``emit(data, starts, ends, document, line, part)`` over the lines of
    ``docs`` (doc_id, version, text, skip) that are not blank, have ``least`` bytes and are
    not to be skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = flat(part.column(2))
            starts, ends, first = line_spans(data, offsets)
            document = np.repeat(np.arange(part.num_rows), np.diff(first))
            line = np.arange(len(starts)) - first[document]
            keep = (ends - starts >= least) & not_blank(data, starts, ends)
            for i, skip in enumerate(part.column(3).to_pylist()):
                if skip:
                    keep[first[i] + np.array(skip)] = False
            at = np.flatnonzero(keep)
            yield emit(data, starts[at], ends[at], document[at], line[at], part)

    return docs.mapInArrow(run, schema)


def _occurrences(data, starts, ends, document, line, part):
    keys = (byte_hasher(x)(starts, ends) for x in (data, data ^ np.uint8(0xA5)))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(k.view(np.int64)) for k in keys),
         part.column(0).take(pa.array(document)), part.column(1).take(pa.array(document)),
         pa.array(line.astype(np.int32))],
        [*LINE, *PLACE])


def _joined(keys, ids, sketches):
    if not keys:
        keys, ids, sketches = ([np.zeros(0, np.int64)] for _ in range(3))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in (keys, ids, sketches)], ["key", "lid", "sketch"])


def _index(edits: int):
    def emit(data, starts, ends, document, line, part):
        hasher, length = byte_hasher(data), ends - starts
        lid, sketch = hasher(starts, ends).view(np.int64), pair_sketch(data, starts, ends)
        keys = []
        for i in range(edits + 1):
            at, size = segment(length, i, edits)
            keys.append(_key(hasher(starts + at, starts + at + size), length, i))
        return _joined(keys, [lid] * len(keys), [sketch] * len(keys))

    return emit


def _probe(edits: int):
    def emit(data, starts, ends, document, line, part):
        hasher, length = byte_hasher(data), ends - starts
        lid, sketch = hasher(starts, ends).view(np.int64), pair_sketch(data, starts, ends)
        keys, ids, sketches = [], [], []
        for shorter in range(edits + 1):
            other = length - shorter
            for i in range(edits + 1):
                at, size = segment(other, i, edits)
                for shift in shifts(i, shorter, edits):
                    ok = (other >= MIN_BYTES) & (at + shift >= 0) & (at + shift + size <= length)
                    begin = (starts + at + shift)[ok]
                    keys.append(_key(hasher(begin, begin + size[ok]), other[ok], i))
                    ids.append(lid[ok])
                    sketches.append(sketch[ok])
        return _joined(keys, ids, sketches)

    return emit


def _wanted_lines(docs: DataFrame) -> DataFrame:
    """(lid, more, bytes) of the lines named in ``wanted``, a list of (line, lid, more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, more, lines = [], [], []
            texts = part.column(0).to_pylist()
            for text, wanted in zip(texts, part.column(1).to_pylist(), strict=True):
                cut = text.encode().split(b"\n")
                for w in wanted:
                    if w["line"] < len(cut):
                        ids.append(w["lid"])
                        more.append(w["more"])
                        lines.append(cut[w["line"]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(more, pa.int64()),
                 pa.array(lines, pa.binary())], [*LINE, "bytes"])

    return docs.mapInArrow(run, "lid bigint, more bigint, bytes binary")


def _verified(pairs: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "left"):
            near = within(part.column(2).to_pylist(), part.column(3).to_pylist(), edits)
            yield part.select(["a", "b"]).filter(pa.array(near))

    return pairs.mapInArrow(run, "a string, b string")


def dropped_lines(docs: DataFrame, edits: int = EDITS, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """A written table (doc_id, version, lines, n_exact, n_near): for each document
    with lines to drop their numbers, from 0. ``keyed`` gives ids and versions.

    Two lines are linked if they are equal or, both having ``MIN_BYTES`` bytes, within
    ``edits`` edits; of the lines reached over links the first stays, by document id, then
    line number. Blank lines take no part. n_exact counts lines equal to an earlier
    one; equal lines are known by 128-bit hashes, others are compared byte by byte.

    A null text is empty, a null id comes last. Rows that share an id are told apart
    by their texts; repeated rows are one document. A very long text is a task's slice of
    its own; a line of any length is one row of numbers per segment and probe.
    """
    source = docs.select(*keyed(doc_id, text), F.coalesce(text, F.lit("")).alias("text"))
    none = F.lit(None).cast("array<int>").alias("skip")
    seen = materialize(
        _rows(source.select("*", none), _occurrences,
              "lid bigint, more bigint, doc_id bigint, version bigint, line int", 1),
        "line-occurrences")
    firsts = materialize(seen.groupBy(*LINE).agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count("*").alias("copies")),
        "line-firsts")
    repeated = materialize(
        firsts.where("copies > 1").select(*LINE, "first"), "line-repeated")
    exact = seen.join(small_side(repeated), [*LINE]).where(
        F.struct(*PLACE) != F.col("first")).select(*PLACE)
    exact = materialize(exact.distinct(), "line-exact")
    near = _near_lines(source, firsts, exact, edits)
    both = exact.withColumn("exact", F.lit(1)).union(near.withColumn("exact", F.lit(0)))
    return materialize(both.groupBy(*DOCUMENT).agg(
        F.array_sort(F.collect_list("line")).alias("lines"),
        F.sum("exact").alias("n_exact"), F.sum(1 - F.col("exact")).alias("n_near")),
        "line-dropped")


def _with_skips(source: DataFrame, exact: DataFrame) -> DataFrame:
    few = exact.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    skips = exact.groupBy(*DOCUMENT).agg(F.collect_list("line").alias("skip"))
    return source.join(F.broadcast(skips) if few else skips, [*DOCUMENT], "left").select(
        *DOCUMENT, "text", "skip")


def _near_lines(source, firsts, exact, edits) -> DataFrame:
    """Places of the distinct lines with an earlier one in their class."""
    rest = _with_skips(source, exact)
    schema = "key bigint, lid bigint, sketch bigint"
    index = _rows(rest, _index(edits), schema, MIN_BYTES)
    probe = _rows(rest, _probe(edits), schema, MIN_BYTES).withColumnsRenamed(
        {"lid": "other", "sketch": "other_sketch"})
    close = F.bit_count(F.col("sketch").bitwiseXOR(F.col("other_sketch"))) <= 4 * edits
    met = index.join(probe, (index.key == probe.key) & (F.col("lid") != F.col("other")) & close)
    pairs = materialize(met.select(
        F.least("lid", "other").alias("a"), F.greatest("lid", "other").alias("b")).distinct(),
        "line-pairs")
    places = firsts.select(*LINE, "first.*")
    ids = materialize(pairs.select("a").union(pairs.select("b")).distinct()
                      .withColumnRenamed("a", "lid"), "line-ids")
    wanted = materialize(places.join(small_side(ids), "lid"), "line-wanted")
    grouped = wanted.groupBy(*DOCUMENT).agg(
        F.collect_list(F.struct("line", *LINE)).alias("wanted"))
    few = wanted.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES
    lines = _wanted_lines(source.join(
        F.broadcast(grouped) if few else grouped, [*DOCUMENT]).select("text", "wanted"))
    lines = materialize(lines.groupBy(*LINE).agg(F.first("bytes").alias("bytes")), "line-bytes")
    line = F.concat_ws(":", *LINE)
    sides = [lines.select(F.col("lid").alias(x), line.alias(f"line_{x}"), F.col("bytes").alias(y))
             for x, y in (("a", "left"), ("b", "right"))]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    links = _verified(joined.select(
        F.col("line_a").alias("a"), F.col("line_b").alias("b"), "left", "right"), edits)
    classes = components(links, "line-classes")
    members = materialize(classes.join(wanted.withColumn("node", line), "node"), "line-members")
    best = members.groupBy("component").agg(F.min(F.struct(*PLACE)).alias("best"))
    return members.join(best, "component").where(
        F.struct(*PLACE) != F.col("best")).select(*PLACE).distinct()


def deduplicated(docs: DataFrame, edits: int = EDITS, doc_id: str = "doc_id",
                 text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with repeated lines cut from the texts; see ``dropped_lines``. What
    stays is joined by line feeds; a text that loses no line is unchanged. With
    ``counts`` the columns n_lines, n_exact and n_near are added, in place of any so named."""
    dropped = dropped_lines(docs, edits, doc_id, text).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__of"), F.col("lines").alias("__drop"),
        F.col("n_exact").alias("__exact"), F.col("n_near").alias("__near"))
    n = dropped.agg(F.sum(F.size("__drop"))).first()[0] or 0
    order, version = keyed(doc_id, text)
    joined = docs.withColumns({"__order": order, "__version": version}).join(
        F.broadcast(dropped) if n <= BROADCAST_LINES else dropped,
        (F.col("__order") == F.col("__id")) & (F.col("__version") == F.col("__of")), "left")
    joined = joined.withColumn("__lines", F.split(F.coalesce(text, F.lit("")), "\n", -1))
    kept = F.expr("array_join(transform("
                  "array_except(sequence(0, size(__lines) - 1), __drop), i -> __lines[i]), '\n')")
    columns = [F.when(F.col("__id").isNull(), F.col(c)).otherwise(kept).alias(c) if c == text
               else F.col(c) for c in docs.columns
               if not (counts and c in ("n_lines", "n_exact", "n_near"))]
    if counts:
        columns += [F.size("__lines").cast("long").alias("n_lines"),
                    F.coalesce("__exact", F.lit(0)).cast("long").alias("n_exact"),
                    F.coalesce("__near", F.lit(0)).cast("long").alias("n_near")]
    return joined.select(*columns)
