"""Texts as flat numpy arrays, for use inside Arrow-batched functions.

A batch of texts is one byte array with offsets. Words are found and hashed
by array operations over all bytes at once, so no step is paid per word. Hashes
are 64 bits wide: a polynomial over random byte values, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts handled at once; a longer text is a slice of its own

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_rng.integers(1 << 62, 1 << 63, dtype=np.uint64)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * SLICE_BYTES:  # those of a rare giant text do not stay in memory
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads each input bit over all output bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class SpanHasher:
    """Hashes spans of one array of values: values[start:end], each in constant time.
    A hash depends on the content and length of a span only."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self.total[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(_INVERSE, len(self.total))[starts]
        h = (self.total[ends] - self.total[starts]) * back
        return mix(h ^ ((ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15)))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(values)(starts, ends)


def byte_hasher(data: np.ndarray) -> SpanHasher:
    return SpanHasher(_BYTE[data])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null text is empty."""
    wide = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = wide.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[wide.offset:wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if len(texts) == 0:
            continue
        _, offs = flat(texts)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def word_spans(data: np.ndarray, offs: np.ndarray):
    """Starts and ends of the runs of bytes other than ASCII white space, and for
    each text the index of its first word, with the number of all words last."""
    n = len(data)
    word = ~WHITE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    inner = offs[(offs > 0) & (offs < n)]
    start[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return byte_hasher(data)(starts, ends)


def grams(hashes: np.ndarray, first: np.ndarray, k: int):
    """Hashes of all runs of ``k`` words that lie within one text: (start words,
    hashes, for each text the index of its first run)."""
    if len(hashes) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    starts = np.arange(len(hashes) - k + 1)
    text_end = np.repeat(first[1:], np.diff(first))[:len(starts)]
    starts = starts[starts + k <= text_end]
    return starts, span_hashes(hashes, starts, starts + k), np.searchsorted(starts, first)


def content_keys(words: np.ndarray, first: np.ndarray) -> list[str | None]:
    """A 128-bit key of each text's word sequence; none for a text without words."""
    hashes = (words, mix(words ^ _U(0x5DEECE66D)))
    one, two = (span_hashes(h, first[:-1], first[1:]).tolist() for h in hashes)
    return [f"{a:016x}{b:016x}" if n else None
            for a, b, n in zip(one, two, np.diff(first).tolist(), strict=True)]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``length`` of them, all in one array."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    shift = starts - np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values).cast(kind))
