"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The distinct words of many texts lie in one flat symbol array. In each round every
word finds its lowest-ranked neighboring pair, by binary search over the sorted
keys of all mergeable pairs, and merges all its occurrences; rounds end when no
word has a pair left. A merged symbol only enters pairs of a higher rank, so this
equals merging one pair at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lexispark.llm.text import flat, list_array, ranges, slices, word_hashes

# Fixed value: byte-level vocabularies of this family split text into words by the pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

CACHED_WORDS = 150_000  # words whose ids a task keeps; then it starts anew
NONE = np.int64(1) << 40  # above every rank


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable Latin-1
    characters stand for themselves, other bytes for the letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _require_plain(spec: dict) -> None:
    """Raise for what this coder does not do: it splits by the byte-level pattern, without a
    normalizer or a space in front, and merges pairs by rank."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    done = [
        spec.get("normalizer") is None,
        pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space"),
        pre.get("use_regex", True),
        model.get("type", "BPE") == "BPE",
        not any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback",
            "ignore_merges")),
        not any(t.get(k) for t in spec.get("added_tokens", ())
                for k in ("single_word", "lstrip", "rstrip")),
    ]
    if not all(done):
        raise ValueError("not a plain byte-level BPE vocabulary")


class Vocabulary:
    """A byte-level BPE vocabulary: symbols as bytes, merges as sorted pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _require_plain(spec)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*ids.values(), *self.special.values()]) + 1
        symbols = [b""] * size
        for token, i in ids.items():
            symbols[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            symbols[i] = token.encode()
        self.byte_ids = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                 for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)  # by rank
        self.classes = character_classes()
        self.data = np.frombuffer(b"".join(symbols), dtype=np.uint8)
        self.lengths = np.array([len(s) for s in symbols], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray):
        """Merge each word: ``lengths`` symbols of ``symbols`` each, none empty.
        Returns the symbols left, word by word, and their number per word."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
        done = []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            over = np.repeat(lowest == NONE, sizes)
            if over.sum() * 4 >= len(over):
                done.append((word[over], symbols[over]))
                word, symbols, rank = word[~over], symbols[~over], rank[~over]
                continue
            hit = rank == np.repeat(lowest, sizes)
            hit[over] = False
            touching = hit[1:] & hit[:-1]
            if touching.any():  # of a run of overlapping pairs take every other
                at = np.flatnonzero(hit)
                first = np.concatenate(([True], np.diff(at) > 1))
                run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                hit[at[(np.arange(len(at)) - run) % 2 == 1]] = False
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1  # where the merged symbols are now
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            rank[new] = NONE
            again = np.concatenate((new, new[new > 0] - 1))
            again = again[again < len(word) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again] = self.pair_ranks(symbols[again], symbols[again + 1])
        words = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        left = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(words, kind="stable")
        return left[order], np.bincount(words, minlength=len(lengths))


LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def character_classes() -> np.ndarray:
    """The class of each code point, as the pattern of the vocabulary sees it."""
    classes = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    at = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, every):
            classes[at[run.start()]:at[run.end() - 1] + 1] = kind
    return classes


class Coder:
    """Encodes and decodes batches; keeps the ids of words it has met.

    Words are known by a 64-bit hash of their bytes and length.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.special = {s.encode(): i for s, i in vocabulary.special.items() if s}
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.cached = np.zeros((3, 0), dtype=np.int64)  # of each word: hash, first id, ids
        self.ids = np.zeros(0, dtype=np.int64)

    def words(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of the words of the segments of ``data`` that ``bounds`` delimits,
        in bytes. Each character starts a word or not by its class and neighbors:

        * letters, numbers, white space and others form runs;
        * the last white character before another run leaves its run: a space joins
          what follows, another one is a word;
        * an apostrophe alone starts a short ending with the letters after it.
        """
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        byte_at = np.flatnonzero((data & 0xC0) != 0x80)
        n = len(points)
        edge = np.zeros(n + 4, dtype=bool)
        edge[np.searchsorted(byte_at, bounds)] = True
        edge[n:] = True
        kind = self.vocabulary.classes[points]
        change = edge.copy()
        change[1:n] |= kind[1:] != kind[:-1]
        start = change.copy()
        last = np.flatnonzero((kind == SPACE) & change[1:n + 1] & ~edge[1:n + 1])
        start[last] = True
        start[last[points[last] == 32] + 1] = False
        at = np.flatnonzero(points == 39)
        at = at[start[at] & change[at + 1] & ~edge[at + 1]]
        if len(at):
            after = np.append(points, np.zeros(3, np.uint32))
            one, two = after[at + 1], np.where(edge[at + 2], 0, after[at + 2])
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = np.isin(one << 8 | two, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
            long &= (one < 128) & (two < 128)
            start[at[short | long] + 1] = False
            start[at[short] + 2] = True
            start[at[long] + 3] = True
        return byte_at[np.flatnonzero(start[:n])]

    def _learn(self, data, hashes, starts, lengths) -> None:
        v = self.vocabulary
        symbols = v.byte_ids[data[ranges(starts, lengths)]]
        ids, counts = v.merge(symbols, lengths)
        first = len(self.ids) + np.cumsum(counts) - counts
        new = np.stack((hashes.view(np.int64), first, counts))
        both = np.concatenate((self.cached, new), axis=1)
        self.cached = both[:, np.argsort(both[0], kind="stable")]
        self.ids = np.concatenate((self.ids, ids))

    def _find(self, hashes):
        known = self.cached[0]
        if not len(known):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(known, hashes.view(np.int64)), len(known) - 1)
        return at, known[at] == hashes.view(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for each text the index of its first, with their number last."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        bounds, tokens = offsets, {}
        if self.specials is not None:
            raw = data.tobytes()
            for found in self.specials.finditer(raw):
                text_end = offsets[np.searchsorted(offsets, found.start(), "right")]
                if found.end() <= text_end:
                    tokens[found.start()] = self.special[found[0]]
                    bounds = np.append(bounds, (found.start(), found.end()))
            bounds = np.unique(bounds)
        starts = self.words(data, bounds)
        if tokens:  # a special token is one word, whatever its characters are
            inside = np.zeros(len(data) + 1, dtype=np.int64)
            for at in tokens:
                end = bounds[np.searchsorted(bounds, at, "right")]
                inside[at + 1] += 1
                inside[end] -= 1
            starts = starts[np.cumsum(inside)[starts] == 0]
        ends = np.append(starts[1:], len(data))
        hashes = word_hashes(data, starts, ends)
        at_special = np.flatnonzero(np.isin(starts, list(tokens))) if tokens else ()
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.cached[0]) > CACHED_WORDS:
            self.cached, self.ids = self.cached[:, :0], self.ids[:0]
        _, known = self._find(distinct)
        if not known.all():
            new = where[~known]
            self._learn(data, distinct[~known], starts[new], (ends - starts)[new])
        slot = self._find(distinct)[0][back]
        first, counts = self.cached[1][slot], self.cached[2][slot]
        if len(at_special):
            first, counts = first.copy(), counts.copy()
            counts[at_special] = 1
        ids = self.ids[ranges(first, counts)]
        total = np.concatenate(([0], np.cumsum(counts)))
        if len(at_special):
            ids[total[at_special]] = [tokens[int(s)] for s in starts[at_special]]
        return ids, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        v = self.vocabulary
        lengths = v.lengths[ids]
        data = v.data[ranges(v.offsets[ids], lengths)].tobytes()
        ends = np.concatenate(([0], np.cumsum(lengths)))[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace")
                for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _coded(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str,
           decoded: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for part in slices(batches, "text"):
            ids, offsets = coder.encode(*flat(part.column(1)))
            columns = [part.column(0), list_array(ids, offsets, pa.int32())]
            if decoded:
                columns.append(pa.array(coder.decode(ids, offsets), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][:len(columns)])

    id_type = docs.schema[key].dataType.simpleString()
    schema = f"id {id_type}, ids array<int>" + ", decoded string" * decoded
    source = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    return source.mapInArrow(run, schema).withColumnRenamed("id", key)


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each text, in order.

    A null or empty text has no ids. Every row gives one row, repeated ones too;
    nothing is shuffled. Other columns are ignored. The vocabulary, whose size its
    file bounds, is broadcast.
    """
    return _coded(docs, vocabulary, key, text, decoded=False)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(key, ids, decoded): as ``encode``, with the ids decoded again."""
    return _coded(docs, vocabulary, key, text, decoded=True)


def decode(coded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id",
           ids: str = "ids") -> DataFrame:
    """(key, decoded): the text of each list of ids; null is empty. Ids outside the
    vocabulary, and nulls, decode to nothing."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        size = len(shared.value.lengths)
        for batch in batches:
            lists = [[i for i in x or () if i is not None and 0 <= i < size]
                     for x in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, lists)])
            flat_ids = np.array([i for x in lists for i in x], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(coder.decode(flat_ids, offsets), pa.string())],
                ["id", "decoded"])

    id_type = coded.schema[key].dataType.simpleString()
    source = coded.select(coded[key].alias("id"), coded[ids].alias("ids"))
    return source.mapInArrow(run, f"id {id_type}, decoded string").withColumnRenamed("id", key)
