"""Vectors that take part in a comparison, and their cosines in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: str = "embedding") -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    column = F.col(embedding)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component first, so that no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosine(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Row-wise cosine of the rows as given. Each row is summed alone, so equal rows get equal
    values wherever they stand."""
    size = np.sqrt((one * one).sum(axis=1)) * np.sqrt((two * two).sum(axis=1))
    return (one * two).sum(axis=1) / size
