"""Whole users inside a task: one shuffle brings the rows of a user together, sorted, and a task takes
some users at a time as arrays. Meant for users of bounded size; those beyond keep to joins of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reviewlens.operators.scale import width_for

#: Places of a user up to which all pairs of them are met within a task.
LARGE = 1024
#: Pairs of places, and rows, that a task holds at a time.
PAIRS = 1_000_000
ROWS = 200_000


def dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows by user, sorted; ``rows`` should be written out, since its count sets the width."""
    return rows.repartition(width_for(rows), "user_id").sortWithinPartitions("user_id", *order)


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before."""
    differs = np.ones(len(column), bool)
    if len(column) > 1:
        found = pc.fill_null(pc.not_equal(column[1:], column[:-1]), True)
        differs[1:] = found.to_numpy(zero_copy_only=False)
    return differs


def starts_of(table: pa.Table, *columns: str) -> np.ndarray:
    """Where the rows of each value of the columns start."""
    differs = np.zeros(table.num_rows, bool)
    for name in columns:
        differs |= _changes(table[name].combine_chunks())
    return np.flatnonzero(differs)


def whole(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.Table]:
    """Rows sorted by user, cut only between users, at least ``rows`` at a time but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(starts_of(table, "user_id")[-1])
            if last:
                yield table[:last]
            held = table[last:].combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def few_users(batches: Iterator[pa.RecordBatch], pairs: int = PAIRS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Some whole users at a time, with the starts of their rows, so many that their places have about
    ``pairs`` pairs."""
    for table in whole(batches):
        starts = starts_of(table, "user_id")
        ends = np.append(starts[1:], table.num_rows)
        upto = np.cumsum((ends - starts) ** 2)
        first = 0
        while first < len(starts):
            before = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, before + pairs, "right")))
            yield table[starts[first] : ends[last - 1]], starts[first:last] - starts[first]
            first = last


def all_pairs(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, k) of every two rows of a user, a row and itself included, sorted."""
    sizes = np.diff(np.append(starts, rows))
    each, first = np.repeat(sizes, sizes), np.repeat(starts, sizes)
    i = np.repeat(np.arange(rows), each)
    at = np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each)
    return i, first[i] + at


def later_pairs(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, k) of every row and every later row of its user, sorted."""
    sizes = np.diff(np.append(starts, rows))
    each = np.repeat(starts + sizes, sizes) - np.arange(rows) - 1
    i = np.repeat(np.arange(rows), each)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each)


def numbers(table: pa.Table, name: str, null: float = 0.0) -> np.ndarray:
    """A column as doubles, with a number for nulls."""
    return pc.fill_null(table[name].combine_chunks().cast(pa.float64()), null).to_numpy(zero_copy_only=False)
