"""Groups of neighboring rows, made by array operations.

Rows that a task has sorted come as Arrow batches. Where a key changes a group ends; its
rows become one row with lists. Unlike an aggregate that collects lists, this neither holds
a buffer per group nor sorts rows again when there are many groups. A group may span any
number of batches, and nothing but the group at hand is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

Groups = Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]
# Rows of whole groups that become one batch, unless one group has more.
BATCH_ROWS = 50_000


def _differ(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Where two columns differ; nulls are equal to each other."""
    unequal = pc.fill_null(pc.not_equal(left, right), False)
    nulls = pc.not_equal(pc.is_null(left), pc.is_null(right))
    return pc.or_(unequal, nulls).to_numpy(zero_copy_only=False)


def changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The rows, but the first, whose keys are not those of the row before."""
    n = batch.num_rows
    changed = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        column = batch.column(key)
        changed |= _differ(column.slice(1), column.slice(0, max(n - 1, 0)))
    return np.flatnonzero(changed) + 1


def slices(
    rows: pa.RecordBatch | pa.Array, sizes: np.ndarray, most: int
) -> Iterator[pa.RecordBatch | pa.Array]:
    """``rows`` in parts that, by the given sizes, are about ``most`` together."""
    parts = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield rows.slice(start, end - start)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups, each with the places at which its groups begin."""
    held: list[pa.RecordBatch] = []  # rows not given yet; the last group may go on
    begins: list[int] = []
    n_held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = changes(batch, keys)
        if held:
            seam = _joined([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            if len(changes(seam, keys)):
                starts = np.concatenate([[0], starts])
        else:
            starts = np.concatenate([[0], starts])
        held.append(batch)
        begins.extend((starts + n_held).tolist())
        n_held += batch.num_rows
        if n_held >= BATCH_ROWS and len(begins) > 1:
            last = begins[-1]
            rows = _joined(held)
            yield rows.slice(0, last), np.array(begins[:-1])
            held, begins, n_held = [rows.slice(last)], [0], n_held - last
    if held:
        yield _joined(held), np.array(begins)


def lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    """Each group's values as a list."""
    return pa.ListArray.from_arrays(
        pa.array(np.append(starts, len(values)), pa.int32()), values)


def group_rows(rows: DataFrame, keys: list[str], groups: Groups, schema: str) -> DataFrame:
    """``groups`` of each task's neighboring rows with equal ``keys``; ``rows`` is sorted
    within partitions, and no group is in two of them."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in whole_groups(batches, keys):
            yield groups(batch, starts)

    return rows.mapInArrow(mapped, schema)
