"""Least squares from sums of products: one mergeable aggregation, then one tiny system per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def product_sums(terms: Sequence[Column]) -> Column:
    """Aggregate: sums of all products term_i * term_j with i <= j, as one array."""
    return F.array(*[F.sum(a * b) for i, a in enumerate(terms) for b in terms[i:]])


def unpack(sums: Iterable[Sequence[float]], k: int) -> np.ndarray:
    """The symmetric k x k matrices of arrays made by :func:`product_sums`."""
    flat = np.array([np.asarray(v, dtype=float) for v in sums]).reshape(-1, k * (k + 1) // 2)
    matrices = np.zeros((len(flat), k, k))
    i, j = np.triu_indices(k)
    matrices[:, i, j] = flat
    matrices[:, j, i] = flat
    return matrices


def least_squares(gram: np.ndarray, moment: np.ndarray) -> np.ndarray:
    """Solve ``gram b = moment`` for many systems; singular ones get the shortest solution. Columns are scaled first."""
    if not moment.shape[1]:
        return moment
    scale = np.sqrt(np.maximum(np.einsum("nii->ni", gram), 0.0))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(gram / (scale[:, :, None] * scale[:, None, :]), rcond=1e-12, hermitian=True)
    return np.einsum("nij,nj->ni", inverse, moment / scale) / scale


def solve_sums(sums: Column, k: int, used: Sequence[int] | None = None) -> Column:
    """Coefficients of the terms 0 … k-1 for the target, which is the last of the k+1 terms.

    ``used`` limits the regression to some terms; the others get 0.
    """
    terms = list(range(k)) if used is None else list(used)

    @F.pandas_udf("array<double>")
    def solve(column: pd.Series) -> pd.Series:
        values = [None if v is None else np.asarray(v, dtype=float) for v in column]
        known = [i for i, v in enumerate(values) if v is not None and np.isfinite(v).all()]
        out: list[np.ndarray | None] = [None] * len(values)
        if known:
            matrices = unpack([values[i] for i in known], k + 1)
            coefficients = np.zeros((len(matrices), k))
            coefficients[:, terms] = least_squares(matrices[:, terms][:, :, terms], matrices[:, terms, k])
            for i, row in zip(known, coefficients):
                out[i] = row
        return pd.Series(out, dtype="object")

    return solve(sums)


def linear(coefficients: Column, terms: Sequence[Column]) -> Column:
    """Sum of coefficient times term."""
    total = F.lit(0.0)
    for i, term in enumerate(terms):
        total = total + coefficients[i] * term
    return total
