"""Vectors as integers: which rows count, and their components in blocks of rows.

A row counts if its vector is not null, not empty, holds no null and no non-finite component, and is as long as the vector
of the smallest id that does so (nulls are the largest ids; of equal ids the shortest vector decides).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that an Arrow function works on at once.
BLOCK_ROWS = 4096


def is_whole(vector: str) -> Column:
    """Whether a vector has only finite components, at least one of them."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def dimension(rows: DataFrame, vec_id: str, vector: str) -> int:
    """Length of the vector of the smallest id, 0 without rows."""
    first = rows.agg(F.min(F.struct(F.col(vec_id).isNull(), F.col(vec_id), F.size(vector).alias("size"))).alias("m")).first()["m"]
    return first["size"] if first else 0


def floors(vectors: pa.Array, scale: int, bound: int) -> np.ndarray:
    """``floor(scale * x)`` of vectors of one length as an int64 matrix, kept within ``bound`` on both sides."""
    flat = np.asarray(vectors.flatten()).astype(np.float64)
    return np.clip(np.floor(scale * flat), -bound, bound).astype(np.int64).reshape(len(vectors), -1)


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
