"""Substring deduplication: remove long word sequences seen in an earlier document.

Reference shards hold each repeated passage once, as it stands in the first document
that has it, and each shard becomes a suffix automaton in the tasks of its queries.
Documents are streamed through the automata of the shards they share passages with;
the matching statistics, restricted to earlier documents, give the maximal spans to
remove.

What to put into the shards comes from hashes. The smallest hash among the short runs
of words inside a window is its anchor; equal windows have equal anchors, and only
windows whose anchor occurs in two documents are compared by hash themselves. The
automata then compare words, so nothing is removed for a hash of a window, though two
windows of one 64-bit hash could hide a repeat. Whole copies of a document are told by 128
bits of their words and go without an automaton.

A shard takes so many windows of a document at most, by where they first stand in it:
a long document is cut, each part with the words its last window reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import join_groups, small_side
from lexispark.llm.text import (
    content_keys,
    flat,
    grams,
    list_array,
    mix,
    slices,
    word_hashes,
    word_spans,
)
from lexispark.scale import materialize

WINDOW = 50
ANCHOR = 20  # words hashed for an anchor
SHARD_WINDOWS = 50_000  # windows of one reference shard
QUERY_WORDS = 400_000  # words streamed by one task call
BROADCAST_NUMBERS = 1_000_000  # numbers in lists per document that may be broadcast
LAST_ID = (1 << 63) - 1
# What tells documents apart: the id, and a text hash for rows that share one.
DOCUMENT = ("doc_id", "version")
DOCUMENT_TYPE = "doc_id bigint, version bigint"


class SuffixAutomaton:
    """All substrings of some word sequences, each with the smallest label of the
    sequences that hold it."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.label = [LAST_ID + 1]

    def _state(self, length: int, following: dict, link: int, label: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.label.append(label)
        return len(self.link) - 1

    def _copy(self, p: int, word, q: int) -> int:
        """Split state ``q``: the part that is one longer than ``p``."""
        part = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], LAST_ID + 1)
        self.link[q] = part
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def add(self, words: list, label: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                if self.length[q] != self.length[last] + 1:
                    q = self._copy(last, word, q)
                last = q
                self.label[q] = min(self.label[q], label)
                continue
            new = self._state(self.length[last] + 1, {}, 0, label)
            p = last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                if self.length[q] != self.length[p] + 1:
                    q = self._copy(p, word, q)
                self.link[new] = q
            last = new

    def finish(self) -> None:
        """Give each state the smallest label of all sequences that hold it."""
        order = np.argsort(np.array(self.length), kind="stable")[::-1].tolist()
        for v in order:
            up = self.link[v]
            if up > 0 and self.label[v] < self.label[up]:
                self.label[up] = self.label[v]

    def spans(self, words: list, label: int, least: int) -> list[tuple[int, int]]:
        """The maximal spans of ``words`` covered by matches of ``least`` words or more
        with sequences of a smaller label."""
        found: list[tuple[int, int]] = []
        state = matched = 0
        for at, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            following = self.next[state].get(word)
            if following is None:
                continue
            state, matched = following, matched + 1
            s, m = state, matched
            while m >= least and self.label[s] >= label:
                s = self.link[s]
                m = self.length[s]
            if m >= least:
                begin = at - m
                while found and found[-1][1] >= begin:
                    begin = min(begin, found.pop()[0])
                found.append((begin, at))
        return found


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` neighbors."""
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:len(low) - (width - have)], low[width - have:])


def _window_anchors(words: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """Starts of all windows, their anchors, and for each text its first window."""
    starts, _, at = grams(words, first, window)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), at
    every = np.concatenate(([0], np.cumsum(np.full(1, len(words)))))
    short = grams(words, every, anchor)[1]
    return starts, _lowest(short, window - anchor + 1)[starts], at


def _read(part: pa.RecordBatch, column: int):
    data, offsets = flat(part.column(column))
    starts, ends, first = word_spans(data, offsets)
    return data, starts, ends, first, word_hashes(data, starts, ends)


def _document_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            _, _, _, first, words = _read(part, 2)
            _, anchors, at = _window_anchors(words, first, window, anchor)
            sets = [np.unique(anchors[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array(content_keys(words, first), pa.string()),
                 pa.array(np.diff(first).astype(np.int64)),
                 list_array(np.concatenate(sets).view(np.int64),
                            np.cumsum([0, *map(len, sets)]), pa.int64())],
                [*DOCUMENT, "copy", "words", "anchors"])

    return docs.mapInArrow(
        run, f"{DOCUMENT_TYPE}, copy string, words bigint, anchors array<bigint>")


def _window_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(hash, doc_id, version, start) of the windows whose anchor is in the list ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            _, _, _, first, words = _read(part, 2)
            starts, anchors, at = _window_anchors(words, first, window, anchor)
            hashes = grams(words, first, window)[1]
            lists = part.column(3)
            ends, wanted = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            keep = np.zeros(len(starts), dtype=bool)
            for i in range(part.num_rows):
                a, b = at[i], at[i + 1]
                keep[a:b] = np.isin(anchors[a:b], wanted[ends[i]:ends[i + 1]])
            text = np.repeat(np.arange(part.num_rows), np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[keep].view(np.int64)),
                 part.column(0).take(pa.array(text[keep])),
                 part.column(1).take(pa.array(text[keep])),
                 pa.array((starts - first[text])[keep].astype(np.int32))],
                ["hash", *DOCUMENT, "start"])

    return docs.mapInArrow(run, f"hash bigint, {DOCUMENT_TYPE}, start int")


def _pieces(docs: DataFrame, window: int, shards: int) -> DataFrame:
    """Cut documents at their repeated windows, given as (start, first document, part of
    it), into references (windows first seen here) and queries (seen earlier) per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out: list[list] = [[] for _ in range(6)]
            for doc_id, version, text, places in zip(
                    *(part.column(i).to_pylist() for i in range(4)), strict=True):
                words = text.encode().split()
                start, first, slot = np.array(
                    sorted({(p["start"], p["first"], p["slot"]) for p in places}),
                    dtype=np.int64).T
                shard = (mix(mix(first.astype(np.uint64)) + slot.astype(np.uint64))
                         % np.uint64(shards)).astype(np.int64)
                own = first == doc_id
                cut = np.flatnonzero(
                    (np.diff(start) != 1) | (np.diff(shard) != 0) | (np.diff(slot) != 0)
                    | (own[1:] != own[:-1])) + 1
                for a, b in zip([0, *cut], [*cut, len(start)], strict=True):
                    begin, end = int(start[a]), int(start[b - 1]) + window
                    row = (int(shard[a]), bool(own[a]), doc_id, version, begin,
                           b" ".join(words[begin:end]))
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                ["shard", "reference", *DOCUMENT, "start", "words"])

    return docs.mapInArrow(
        run, f"shard bigint, reference boolean, {DOCUMENT_TYPE}, start int, words binary")


def _matched(window: int):
    def run(table: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton()
        rows = list(zip(*(table.column(c).to_pylist() for c in (
            "reference", *DOCUMENT, "start", "words")), strict=True))
        for reference, doc_id, _, _, words in rows:
            if reference:
                automaton.add(words.split(), doc_id)
        automaton.finish()
        out = [(doc_id, version, start + a, start + b)
               for reference, doc_id, version, start, words in rows if not reference
               for a, b in automaton.spans(words.split(), doc_id, window)]
        doc, version, begin, end = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"doc_id": pa.array(doc, pa.int64()),
                         "version": pa.array(version, pa.int64()),
                         "begin": pa.array(begin, pa.int32()), "end": pa.array(end, pa.int32())})

    return run


def _listed(docs: DataFrame, lists: DataFrame, numbers: int, how: str) -> DataFrame:
    """Join lists per document to ``docs``, by broadcast if they hold few numbers."""
    if numbers <= BROADCAST_NUMBERS:
        return docs.join(F.broadcast(lists), [*DOCUMENT], how)
    if how == "inner":  # drop other documents before their texts are shuffled
        docs = docs.join(small_side(lists.select(*DOCUMENT)), [*DOCUMENT], "left_semi")
    return docs.join(lists, [*DOCUMENT], how)


def repeated_spans(source: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   shard_windows: int | None = None) -> DataFrame:
    """A written table (doc_id, version, spans): for each document of ``source``
    (doc_id, version, text) with words to remove the spans [begin, end) of them, in words."""
    shard_windows = shard_windows or SHARD_WINDOWS
    rows = materialize(_document_rows(source, window, anchor), "substring-documents")
    copies = materialize(
        rows.where(F.col("words") >= window).groupBy("copy").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("rows")), "substring-copies")
    # Of copies only the first is looked into: the others go as a whole.
    whole = join_groups(
        rows.where(F.col("words") >= window).select(*DOCUMENT, "copy", "words"), copies,
        "copy", "rows", F.col("doc_id").cast("string")).where("doc_id > first").select(
        *DOCUMENT, F.array(F.struct(F.lit(0).alias("begin"),
                                   F.col("words").cast("int").alias("end"))).alias("spans"))
    firsts = rows.join(
        copies.where("first is not null"),
        (rows.doc_id == copies["first"]) & (rows.copy == copies.copy)).select(*DOCUMENT, "anchors")
    anchors = materialize(
        firsts.select(*DOCUMENT, F.explode("anchors").alias("anchor")), "substring-anchors")
    shared = materialize(
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b").select("anchor"), "substring-shared")
    lists = anchors.join(small_side(shared), "anchor", "left_semi").groupBy(*DOCUMENT).agg(
        F.collect_list("anchor").alias("anchors"))
    lists = materialize(lists, "substring-lists")
    numbers = lists.agg(F.sum(F.size("anchors"))).first()[0] or 0
    windows = materialize(_window_rows(
        _listed(source, lists, numbers, "inner").select(*DOCUMENT, "text", "anchors"),
        window, anchor), "substring-windows")
    slot = F.floor(F.col("at.start") / shard_windows).cast("int").alias("slot")
    first = materialize(
        windows.groupBy("hash").agg(
            F.min(F.struct("doc_id", "start")).alias("at"), F.max("doc_id").alias("last"))
        .where("at.doc_id < last").select("hash", F.col("at.doc_id").alias("first"), slot),
        "substring-firsts")
    places = windows.join(first, "hash").groupBy(*DOCUMENT).agg(
        F.collect_list(F.struct("start", "first", "slot")).alias("places"))
    places = materialize(places, "substring-places")
    shards = first.count() // shard_windows + 1
    numbers = (places.agg(F.sum(F.size("places"))).first()[0] or 0) * 3
    pieces = materialize(_pieces(
        _listed(source, places, numbers, "inner").select(*DOCUMENT, "text", "places"),
        window, shards), "substring-pieces")
    # A shard with many queries gives its automaton to several calls.
    loads = materialize(pieces.where("not reference").groupBy("shard").agg(
        F.ceil(F.sum(F.length("words")) / (8 * QUERY_WORDS)).cast("int").alias("calls")),
        "substring-loads")
    dealt = pieces.join(small_side(loads), "shard")
    every = F.sequence(F.lit(0), F.col("calls") - 1)
    one = F.array(F.pmod(F.xxhash64("doc_id", "start"), F.col("calls")).cast("int"))
    dealt = dealt.withColumn("call", F.explode(F.when(F.col("reference"), every).otherwise(one)))
    found = dealt.drop("calls").groupBy("shard", "call").applyInArrow(
        _matched(window), f"{DOCUMENT_TYPE}, begin int, end int")
    parts = found.groupBy(*DOCUMENT).agg(
        F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    return materialize(parts.union(whole.distinct()), "substring-spans")


def without_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                    text: str = "text", anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and kept (the words that
    stay, joined by one space).

    Words are the runs of characters other than ASCII white space, unchanged. A word
    is removed if it lies in ``window`` consecutive words of its document that also
    stand in a document with a smaller id; windows are judged on the input. A null
    text has no words. A null id comes after all others. Rows that share an id, null
    included, are not earlier than each other. Other columns are ignored.
    """
    order = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID))
    source = docs.select(
        order.alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
        F.coalesce(text, F.lit("")).alias("text"))
    spans = repeated_spans(source, window, anchor)
    numbers = (spans.agg(F.sum(F.size("spans"))).first()[0] or 0) * 2
    joined = _listed(source, spans, numbers, "left").select("doc_id", "text", "spans")
    kept = joined.mapInArrow(
        _cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
    own: Column = F.when(F.col("doc_id") != LAST_ID, F.col("doc_id"))
    return kept.withColumn("doc_id", own)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        total, removed, kept = [], [], []
        texts, spans = part.column(1).to_pylist(), part.column(2).to_pylist()
        for text, cuts in zip(texts, spans, strict=True):
            words = text.encode().split()
            total.append(len(words))
            if cuts:
                keep = np.ones(len(words), dtype=bool)
                for cut in cuts:
                    keep[cut["begin"]:cut["end"]] = False
                words = [words[i] for i in np.flatnonzero(keep)]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
