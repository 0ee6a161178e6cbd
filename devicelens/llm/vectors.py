"""Vectors as Spark rows and as the arrays that tasks compute with."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, has only finite components, and is not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def content_key(vector: Column) -> Column:
    """SHA-256 of a vector's components; minus zero counts as zero."""
    return F.sha2(F.array_join(F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")).cast("string")), ","), 256)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one dimension as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unblob(value: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(value, np.float64).reshape(rows, -1)


def second_moments(rows: DataFrame, vector: str = "vector") -> dict[int, np.ndarray]:
    """By dimension, the sum of outer products of the unit vectors of all rows; each task sends its sum of squares once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(0)])
            for d in np.unique(dims):
                x = matrix(batch.column(0).filter(pa.array(dims == d)))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)), pa.array(s.ravel())], ["d", "k", "s"])

    found: dict[int, np.ndarray] = {}
    for r in rows.select(vector).mapInArrow(run, "d int, k int, s double").groupBy("d", "k").agg(F.sum("s").alias("s")).collect():
        found.setdefault(r.d, np.zeros(r.d * r.d))[r.k] = r.s
    return {d: s.reshape(d, d) for d, s in found.items()}


def principal_axes(rows: DataFrame, vector: str = "vector") -> dict[int, np.ndarray]:
    """By dimension, an orthonormal matrix whose columns go from the widest direction of all rows to the narrowest."""
    axes = {}
    for d, s in second_moments(rows, vector).items():
        _, v = np.linalg.eigh(s)
        axes[d] = np.ascontiguousarray(v[:, ::-1])
    return axes
