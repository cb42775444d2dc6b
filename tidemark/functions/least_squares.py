"""Ordinary least squares from sums of products.

Spark adds up the products; what is left per fit is a matrix a few columns wide, solved
by NumPy inside the tasks that hold the fits (one row per date or month).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gram_columns(x: Sequence[str], y: str, when: Column | None = None) -> dict[str, Column]:
    """Aggregates of the design [1, x...] and target: every product the fit needs, by name."""
    use = (lambda c: c) if when is None else (lambda c: F.when(when, c))
    names = [None, *x, y]
    out: dict[str, Column] = {}
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            if j < i:
                continue
            left = F.lit(1.0) if a is None else F.col(a)
            right = F.lit(1.0) if b is None else F.col(b)
            out[f"g_{i}_{j}"] = F.coalesce(F.sum(use(left * right)), F.lit(0.0))
    return out


def _solve(gram: np.ndarray) -> np.ndarray:
    """Coefficients and residual sum of squares of one fit.

    A full-rank design is solved about its means; a deficient one gets the minimum-norm
    answer, as a least-squares solve of the design itself would give.
    """
    n = gram[0, 0]
    k = gram.shape[0] - 1
    if not n > 0:
        return np.full(k + 1, np.nan)
    mean = gram[0] / n
    centred = gram - n * np.outer(mean, mean)
    xx, xy, yy = centred[1:k, 1:k], centred[1:k, k], centred[k, k]
    scale = np.sqrt(np.diag(gram)[1:k])
    scale[scale == 0] = 1.0
    unit = xx / np.outer(scale, scale)
    if k > 1 and np.linalg.matrix_rank(unit, tol=1e-11, hermitian=True) == k - 1:
        slope = np.linalg.solve(unit, xy / scale) / scale
        beta = np.concatenate([[mean[k] - slope @ mean[1:k]], slope])
        rss = yy - slope @ xy
    else:
        beta, *_ = np.linalg.lstsq(gram[:k, :k], gram[:k, k], rcond=1e-12)
        rss = gram[k, k] - 2 * beta @ gram[:k, k] + beta @ gram[:k, :k] @ beta
    return np.concatenate([beta, [max(rss, 0.0)]])


def fit(gram_names: Sequence[str], k: int) -> Column:
    """`array<double>`: the k coefficients (constant first), then the residual sum of squares."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solved(*sums: pd.Series) -> pd.Series:
        values = np.column_stack([s.to_numpy(float) for s in sums])
        upper = np.triu_indices(k + 1)
        gram = np.zeros((len(values), k + 1, k + 1))
        gram[:, upper[0], upper[1]] = values
        gram[:, upper[1], upper[0]] = values
        return pd.Series([_solve(g) for g in gram])

    return solved(*[F.col(g) for g in gram_names])
