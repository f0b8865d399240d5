"""Periodic runs: stretches of words that repeat themselves four times or more.

Periods are taken by octaves, those from 2**j to 2**(j + 1) - 1. For an octave a
document is cut into tiles that overlap by four of its longest periods and more, so a
run lies in one tile or its part in each is long enough to be found there. Octaves
whose tiles would be short share them, and a document of a few thousand words is one
tile. Tiles are solved on their own, wherever they are.

Within a tile there is a boundary every 2**j words. Where the text from a boundary
repeats itself q words later, for how long is the Z-function of the text from there at
q, and the same backwards. A run of an octave's period holds a boundary from which the
forward value is more than twice 2**j. That is looked for at all boundaries and periods of
many tiles at once by hashes of so many words; the few that pass are then extended to
both sides, word by word.

What a tile finds are intervals of words per document and period. They are shuffled by
these two, and intervals that meet become one run. A run of the same bounds as one of a
smaller period has that period too and goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.common import join_lists
from lexispark.llm.text import SpanHasher, flat, mix, ranges, slices, word_spans
from lexispark.scale import materialize

REPEATS = 4  # a run is at least so many periods long
LEAST = 6  # and so many words
TILE_WORDS = 16_384
TILE_PERIODS = 32  # a tile is at least so many times an octave's first period
PAIRS = 1 << 20  # boundaries times periods looked at together
LAST_ID = (1 << 63) - 1
DOCUMENT = ("key", "version")
_TILE = "key bigint, version bigint, start bigint, low int, high int, whole boolean, text binary"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# --- one batch of tiles


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    size = ends - starts
    where = np.concatenate(([0], np.cumsum(size)))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size),
        [None, pa.py_buffer(where), pa.py_buffer(data[ranges(starts, size)])])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _candidates(hasher: SpanHasher, begin: np.ndarray, end: np.ndarray, octave: int):
    """(tile, boundary, period) where the text from a boundary goes on, for more than two
    first periods of the octave, as it does one period later."""
    step = 1 << octave
    width = 2 * step + 1
    at = ranges(begin, np.maximum(end - begin - width + 1, 0))
    hashes = np.zeros(len(hasher.total), np.uint64)
    hashes[at] = hasher(at, at + width)
    count = np.maximum((end - begin - width - step) // step + 1, 0)
    tile = np.repeat(np.arange(len(begin)), count)
    bound = begin[tile] + ranges(np.zeros(len(count), np.int64), count) * step
    found = []
    for low in range(0, len(bound), max(1, PAIRS // step)):
        b, t = bound[low:low + max(1, PAIRS // step)], tile[low:low + max(1, PAIRS // step)]
        later = b[:, None] + np.arange(step, 2 * step)
        inside = later + width <= end[t][:, None]
        np.minimum(later, len(hashes) - 1, out=later)
        i, q = np.nonzero((hashes[later] == hashes[b][:, None]) & inside)
        found.append((t[i], b[i], q + step))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def tile_runs(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray,
              high: np.ndarray, whole: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(tile, period, first word, end) of the runs within tiles, ids[begin:end] each.
    Of a ``whole`` tile, runs whose bounds are those of a smaller period may be left out."""
    out = []
    known: list[list[tuple[int, int, int]]] = [[] for _ in begin]
    hasher = SpanHasher(mix(ids.astype(np.uint64) + np.uint64(1)))
    octave = 0
    while True:
        size = end - begin
        fit = size >= max(LEAST, REPEATS << octave)
        if not fit.any():
            return out
        pick = np.flatnonzero(fit & (low <= octave) & (octave <= high))
        tile, bound, period = _candidates(hasher, begin[pick], end[pick], octave)
        order = np.lexsort((bound, period, tile))
        tile, bound, period = pick[tile[order]], bound[order], period[order]
        cut = np.flatnonzero((np.diff(tile) != 0) | (np.diff(period) != 0)) + 1
        for a, b in zip([0, *cut], [*cut, len(tile)], strict=True):
            if a == b:
                continue
            t, q = int(tile[a]), int(period[a])
            left = bound[a:b]
            if whole[t]:
                for s, e, p in known[t]:
                    if q % p == 0:
                        left = left[(left < s) | (left + 2 * q > e)]
            if not len(left):
                continue
            base, stop = int(begin[t]), int(end[t])
            same = np.zeros(stop - base - q + 2, np.int8)
            same[1:-1] = ids[base:stop - q] == ids[base + q:stop]
            edge = np.diff(same)
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            long = last - first + q >= max(LEAST, REPEATS * q)
            for s, e in zip(first[long] + base, last[long] + base + q, strict=True):
                out.append((t, q, int(s), int(e)))
                known[t].append((int(s), int(e), q))
        octave += 1


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals (key, version, period, begin, end) of tiles, in words of the document."""
    for part in slices(batches, "text"):
        data, offs = flat(part.column(6).cast(pa.large_binary()))
        starts, ends, first = word_spans(data, offs)
        ids = word_ids(data, starts, ends)
        start, low, high = (part.column(i).to_numpy() for i in (2, 3, 4))
        whole = part.column(5).to_numpy(zero_copy_only=False)
        runs = tile_runs(ids, first[:-1], first[1:], low, high, whole)
        tile, period, begin, end = np.array(runs, np.int64).reshape(-1, 4).T
        shift = start[tile] - first[tile]
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(tile)), part.column(1).take(pa.array(tile)),
             pa.array(period), pa.array(begin + shift), pa.array(end + shift)],
            [*DOCUMENT, "period", "begin", "end"])


def tiles_of(n: int, tile: int) -> list[tuple[int, int, int, int]]:
    """(start, end, first octave, last octave) of the tiles of ``n`` words."""
    out, octave = [], 0
    while REPEATS << octave <= n or octave == 0:
        size = max(tile, TILE_PERIODS << octave)
        last = max(octave, (size // TILE_PERIODS).bit_length() - 1)
        if size >= n:
            return [*out, (0, n, octave, 62)]
        step = size - 2 * REPEATS * (1 << last) - LEAST
        start = 0
        while True:
            out.append((start, min(start + size, n), octave, last))
            if start + size >= n:
                break
            start += step
        octave = last + 1
    return out


def _cut_tiles(tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offs = flat(part.column(2))
            starts, ends, first = word_spans(data, offs)
            for i in range(part.num_rows):
                for a, b, low, high in tiles_of(int(first[i + 1] - first[i]), tile):
                    if a == b:
                        continue
                    text = data[starts[first[i] + a]:ends[first[i] + b - 1]].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(i, 1), part.column(1).slice(i, 1),
                         pa.array([a]), pa.array([low], pa.int32()), pa.array([high], pa.int32()),
                         pa.array([high == 62 and low == 0]), pa.array([text], pa.binary())],
                        [x.split()[0] for x in _TILE.split(", ")])

    return run


# --- documents


def _tiles(source: DataFrame, tile: int) -> DataFrame:
    """Texts of at most twice as many bytes as a tile has words are one tile; tiles of
    longer ones are dealt out anew."""
    short = F.octet_length("text") <= 2 * tile
    one = source.where(short).select(
        *DOCUMENT, F.lit(0).cast("bigint").alias("start"), F.lit(0).alias("low"),
        F.lit(62).alias("high"), F.lit(True).alias("whole"),
        F.col("text").cast("binary").alias("text"))
    many = source.where(~short).select(*DOCUMENT, "text").mapInArrow(_cut_tiles(tile), _TILE)
    return one.union(many.repartition(*DOCUMENT, "low", "start"))


def runs_of(source: DataFrame, tile: int = TILE_WORDS) -> DataFrame:
    """(key, version, start, length, period) of all runs in ``source`` (key, version, text)."""
    parts = _tiles(source, tile).mapInArrow(
        _solved, "key bigint, version bigint, period bigint, begin bigint, end bigint")
    parts = materialize(parts, "runs-parts")
    before = Window.partitionBy(*DOCUMENT, "period").orderBy("begin", "end")
    reach = F.max(F.col("end") - F.col("period")).over(
        before.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("begin") <= F.col("reach"), 0).otherwise(1)
    stitched = (
        parts.withColumn("reach", reach).withColumn("new", new)
        .withColumn("run", F.sum("new").over(before))
        .groupBy(*DOCUMENT, "period", "run").agg(
            F.min("begin").alias("start"), F.max("end").alias("end")))
    return stitched.groupBy(*DOCUMENT, "start", "end").agg(F.min("period").alias("period")).select(
        *DOCUMENT, "start", (F.col("end") - F.col("start")).alias("length"), "period")


def collapsed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              tile: int = TILE_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (an array of start, length and period, in
    words, by start and period) and collapsed, the words without the repetitions: each
    run keeps its first period.

    Words are the runs of characters other than ASCII white space. A run is a stretch of
    words with a smallest period of q words, at least ``REPEATS`` periods and ``LEAST`` words
    long, which cannot be extended. A null or blank text has no words, no runs and an empty
    result. Rows that share an id, or have none, are told apart by their texts. Texts
    of many words are cut into tiles that any task may take. Other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("key"),
        F.xxhash64("text").alias("version"), "text")
    lists = materialize(runs_of(source, tile).groupBy(*DOCUMENT).agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs")),
        "runs-lists")
    numbers = (lists.agg(F.sum(F.size("runs"))).first()[0] or 0) * 3
    joined = join_lists(source, lists, numbers, "left", DOCUMENT).select(
        "doc_id", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), "text")
    return joined.mapInArrow(_collapse, f"doc_id bigint, runs {RUNS}, collapsed string")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        data, offs = flat(part.column(2))
        starts, ends, first = word_spans(data, offs)
        keep = np.ones(len(starts), bool)
        items = part.column(1).flatten()
        row = np.repeat(np.arange(part.num_rows), np.diff(part.column(1).offsets.to_numpy()))
        start, length, period = (items.field(i).to_numpy() for i in range(3))
        for r, s, n, q in zip(row, start, length, period, strict=True):
            keep[first[r] + s + q:first[r] + s + n] = False
        doc = np.repeat(np.arange(part.num_rows), np.diff(first))[keep]
        starts, ends = starts[keep], ends[keep]
        between = ends[:-1][doc[1:] == doc[:-1]]  # white space stands there
        step = np.zeros(len(data) + 1, np.int64)
        step[starts] += 1
        step[ends] -= 1
        stay = np.cumsum(step)[:-1] > 0
        stay[between] = True
        data = data.copy()
        data[between] = 32
        where = np.concatenate(([0], np.cumsum(stay)))[offs]
        texts = pa.LargeStringArray.from_buffers(
            part.num_rows, pa.py_buffer(where), pa.py_buffer(data[stay]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), texts.cast(pa.string())],
            ["doc_id", "runs", "collapsed"])


def with_periods(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) where every tenth document, by the checksum of its id, goes on
    periodically from some word on; others, and those without an id, are unchanged.
    The new texts are written, as a plan that reads them twice would make them twice."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col(text).rlike(r"[^\x20\x09-\x0D]")
    chosen = F.coalesce(chosen, F.lit(False))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def planted(of: Column) -> Column:
        n = F.size(of["words"]).cast("bigint")
        a = of["g"] % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + of["g"] % 8))
        place = F.sequence(F.lit(0).cast("bigint"), n - 1)
        return F.array_join(F.transform(place, lambda i: F.get(of["words"], F.when(
            i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # as a variable of a lambda the words are found once
    one = F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g")))
    new = docs.where(chosen).select(
        F.col(doc_id).alias("doc_id"), F.transform(one, planted)[0].alias("text"))
    rest = docs.where(~chosen).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rest.union(materialize(new, "runs-planted"))


def digests(found: DataFrame) -> DataFrame:
    """The numbers of the runs of each document and digests of them and of the rest."""
    best = F.reduce(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r)
        .otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
