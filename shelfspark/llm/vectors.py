"""Numeric vectors in array columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers of one block of vectors that are held as doubles at the same time.
BLOCK_NUMBERS = 1 << 19


def is_whole(vector: Column) -> Column:
    """Whether a vector is not null and holds neither null nor NaN nor infinity."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles from a list column without nulls; shorter lists end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as longs."""
    return np.floor(values * float(scale)).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a bounded count of numbers."""
    rows = max(64, BLOCK_NUMBERS // max(1, width))
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
