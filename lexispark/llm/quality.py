"""Text quality by a regularised quadratic discriminant over document statistics.

Each class is a Gaussian in the space of transformed statistics, with a mean and a
shrunken covariance; a text's score is the posterior of class 1, from the
difference of the two log-densities. The Cholesky factors are computed once per
model, so scoring is two triangular products per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import BROADCAST_ROWS
from lexispark.llm.text import (
    WHITE,
    flat,
    list_array,
    mix,
    slices,
    span_hashes,
    word_hashes,
    word_spans,
)
from lexispark.scale import materialize

FOLDS = 5  # documents of fold 0 are held out
# Least share of the pooled covariance in a class covariance; a class with few rows
# takes more of it.
POOLED_SHARE = 0.1
SPHERE_SHARE = 0.02  # of a sphere with the same trace in each class covariance

STATISTICS = (
    "words", "word_bytes", "upper", "digits", "stops", "marks", "foreign", "white",
    "distinct_words", "repeated_words", "capital_words", "marked_words", "short_words",
    "lines", "distinct_lines", "ended_lines", "words_per_line",
)

_BYTES = np.arange(256)
_IS = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digits": (_BYTES >= 48) & (_BYTES <= 57),
    "stops": np.isin(_BYTES, list(b".,")),
    "foreign": _BYTES >= 192,
    "white": WHITE,
    "line": _BYTES == 10,
}
_MARKS = (_BYTES > 32) & (_BYTES < 127) & ~np.isin(_BYTES, list(b".,")) & ~(
    _IS["upper"] | _IS["digits"] | (_BYTES >= 97) & (_BYTES <= 122))
_END = np.isin(_BYTES, list(b".!?:;\"'"))


def _count(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets]).astype(float)


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The number of distinct hashes of each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    marked = mix(hashes ^ mix(text.astype(np.uint64)))
    order = np.argsort(marked, kind="stable")
    fresh = np.ones(len(marked), dtype=bool)
    fresh[order[1:]] = marked[order[1:]] != marked[order[:-1]]
    return np.bincount(text[fresh], minlength=len(first) - 1).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text: logarithms of sizes, square roots
    of shares. An empty text has defined ones too."""
    size = np.diff(offsets).astype(float)
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first).astype(float)
    hashes = word_hashes(data, starts, ends)
    length = ends - starts
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = hashes[1:] == hashes[:-1]
    lead = data[starts]
    marks = np.concatenate(([0], np.cumsum(_MARKS[data])))
    # lines with something in them
    cut = _IS["line"][data]
    cut_at = np.unique(np.concatenate((np.flatnonzero(cut) + 1, offsets)))
    line_starts = cut_at[:-1]
    line_ends = cut_at[1:] - (cut[cut_at[1:] - 1] if len(data) else 0)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    line_first = np.searchsorted(line_starts, offsets)
    lines = np.diff(line_first).astype(float)
    line_hashes = span_hashes(data.astype(np.uint64) + np.uint64(1), line_starts, line_ends)
    last_word = np.searchsorted(starts, line_ends) - 1
    ended = _END[data[ends[last_word] - 1]] if len(last_word) else np.zeros(0, bool)

    def share(part, whole):
        return np.sqrt(part / np.maximum(whole, 1))

    return np.column_stack((
        np.log1p(words),
        np.log1p(_count_of(length, first) / np.maximum(words, 1)),
        *(share(_count(_IS[k][data], offsets), size) for k in ("upper", "digits", "stops")),
        share(_count(_MARKS[data], offsets), size),
        *(share(_count(_IS[k][data], offsets), size) for k in ("foreign", "white")),
        share(_distinct(hashes, first), words),
        share(_count(again, first), words),
        share(_count(_IS["upper"][lead], first), words),
        share(_count(marks[ends] > marks[starts], first), words),
        share(_count(length <= 3, first), words),
        np.log1p(lines),
        share(_distinct(line_hashes, line_first), lines),
        share(_count(ended, line_first), lines),
        np.log1p(words / np.maximum(lines, 1)),
    ))


def _count_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[first]).astype(float)


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, statistics array<double>) per row. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = statistics(*flat(part.column(1)))
            offsets = np.arange(len(rows) + 1) * rows.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), list_array(rows.ravel(), offsets, pa.float64())],
                ["key", "statistics"])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return source.mapInArrow(run, f"key {kind}, statistics array<double>").withColumnRenamed(
        "key", key)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and offsets of the classes 0 and 1."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    whiteners: np.ndarray
    offsets: np.ndarray
    temper: float = 1.0
    shift: float = 0.0

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        x = (rows - self.center) / self.scale
        density = [
            offset - 0.5 * np.square((x - mean) @ whitener.T).sum(axis=1)
            for mean, whitener, offset in zip(
                self.means, self.whiteners, self.offsets, strict=True)
        ]
        return density[1] - density[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        odds = self.temper * self.log_odds(rows) + self.shift
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def discriminant(counts, sums, products, pooled_share: float = POOLED_SHARE,
                 sphere_share: float = SPHERE_SHARE) -> Discriminant:
    """The model from each class's count, sums and products of statistics. A class
    without rows gets the shape of the other."""
    counts = np.asarray(counts, dtype=float)
    n = np.maximum(counts, 1)
    means = sums / n[:, None]
    scatter = products - np.einsum("k,ki,kj->kij", counts, means, means)
    total = max(counts.sum(), 1.0)
    center = sums.sum(axis=0) / total
    spread = products.sum(axis=0).diagonal() / total - center**2
    scale = np.sqrt(np.where(spread > 1e-12, spread, 1.0))
    means = np.where(counts[:, None] > 0, (means - center) / scale, 0.0)
    scatter = scatter / np.outer(scale, scale)
    pooled = scatter.sum(axis=0) / total
    size = len(center)
    whiteners, offsets = [], []
    for k in (0, 1):
        share = max(pooled_share, size / (size + counts[k])) if counts[k] > 1 else 1.0
        shape = (1 - share) * scatter[k] / n[k] + share * pooled
        level = max(np.trace(shape) / size, 1e-6)
        shape = (1 - sphere_share) * shape + sphere_share * level * np.eye(size)
        factor = np.linalg.cholesky(shape)
        whiteners.append(np.linalg.inv(factor))
        prior = np.log((counts[k] + 1) / (total + 2))
        offsets.append(prior - np.log(factor.diagonal()).sum())
    return Discriminant(center, scale, means, np.array(whiteners), np.array(offsets))


def calibrated(model: Discriminant, odds, labels, weights) -> Discriminant:
    """The model with its log-odds tempered and shifted so that the scores are
    calibrated: a logistic regression on the log-odds of training rows, with targets
    held off 0 and 1 by one pseudo-row each."""
    odds, labels, weights = (np.asarray(v, dtype=float) for v in (odds, labels, weights))
    ones, zeros = (labels * weights).sum(), ((1 - labels) * weights).sum()
    if not ones or not zeros:
        return model
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    unit = max(np.abs(odds).max(), 1.0)
    x = np.column_stack((odds / unit, np.ones_like(odds)))
    beta = np.array([1.0, 0.0])

    def loss(b):
        z = x @ b
        return (weights * (np.logaddexp(0, z) - target * z)).sum() + 1e-6 * b @ b

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (weights * (p - target)) + 2e-6 * beta
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x
        step = np.linalg.solve(curve + 2e-6 * np.eye(2), slope)
        rate = 1.0
        while rate > 1e-6 and loss(beta - rate * step) > loss(beta):
            rate /= 2
        beta = beta - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    if beta[0] <= 0:  # labels that the statistics do not explain
        return model
    return Discriminant(model.center, model.scale, model.means, model.whiteners,
                        model.offsets, float(beta[0] / unit), float(beta[1]))


ODDS_LIMIT = 2000  # calibration counts training rows by whole log-odds up to this


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS == 0


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id",
        label: str = "quality") -> Discriminant:
    """Fit on the labelled rows of ``stats`` outside the held-out fold.

    All of them count: Spark sums counts, statistics and their products per class,
    so the driver gets two rows, and later at most four thousand counts by log-odds.
    Labels other than 0 and 1 and keys that are null are left out; a row labelled
    twice counts twice. Without any labelled row every score is one half.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(key, F.col(label).cast("int").alias("y"))
    known = known.where(~held_out(F.col(key)))
    train = materialize(stats.join(known, key).select("y", "statistics"), "quality-train")
    size = len(STATISTICS)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    at = [F.col("statistics")[i] for i in range(size)]
    rows = train.groupBy("y").agg(
        F.count("*"), F.array(*map(F.sum, at)),
        F.array(*[F.sum(at[i] * at[j]) for i, j in pairs])).collect()
    counts, sums, products = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
    for y, count, sum_, product in rows:
        counts[y], sums[y] = count, sum_
        for (i, j), value in zip(pairs, product, strict=True):
            products[y, i, j] = products[y, j, i] = value
    model = discriminant(counts, sums, products)
    odds = _with_odds(train, model, "y").select(
        "y", F.round(F.greatest(F.least("odds", F.lit(ODDS_LIMIT)), F.lit(-ODDS_LIMIT)))
        .alias("odds"))
    bins = odds.groupBy("y", "odds").count().collect()
    if not bins:
        return model
    y, odds, weights = zip(*bins, strict=True)
    return calibrated(model, odds, y, weights)


def _with_odds(stats: DataFrame, model: Discriminant, key: str) -> DataFrame:
    """(key, odds, score) for rows with statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = values.reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.log_odds(rows)), pa.array(model.score(rows))],
                ["key", "odds", "score"])

    kind = stats.schema[key].dataType.simpleString()
    return stats.select(F.col(key).alias("key"), "statistics").mapInArrow(
        run, f"key {kind}, odds double, score double").withColumnRenamed("key", key)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                    text: str = "text", label: str = "quality") -> DataFrame:
    """(key, held_out, score) of every row of ``docs``: the score is the posterior
    of label 1, from the whole text alone.

    Null texts count as empty; every row gives one row, repeated ones too. A null
    key is in no fold, held_out is null for it. Statistics are written once and read
    for training and scoring; only those of labelled rows are shuffled.
    """
    stats = materialize(document_statistics(docs, key, text), "quality-statistics")
    model = fit(stats, labels, key, label)
    return _with_odds(stats, model, key).select(
        key, held_out(F.col(key)).alias("held_out"), "score")


def accept(docs: DataFrame, labels: DataFrame, threshold: float, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, unchanged. Each is
    scored in place: no join, so repeated ids and null ids do not matter. Statistics for
    the fit are those of labelled rows, if these are few enough to be broadcast, else of
    all. A text of any length has one row of statistics."""
    known = materialize(labels.where(F.col("quality").isin(0, 1)).select(
        F.col(key).alias("__known")).where(~held_out(F.col("__known"))).distinct(),
        "quality-known")
    labelled = docs
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        labelled = docs.join(F.broadcast(known), F.col(key) == F.col("__known"), "left_semi")
    stats = materialize(document_statistics(labelled, key, text), "quality-statistics")
    model = fit(stats, labels, key)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            rows = statistics(*flat(part.column(columns.index(text))))
            yield part.filter(pa.array(model.score(rows) >= threshold))

    return docs.mapInArrow(run, docs.schema)
