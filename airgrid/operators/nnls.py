"""Non-negative least squares per segment, solved from its moment matrix."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.operators.moments import WIDTH, moment_pairs
from airgrid.schema import SEGMENT


def moment_matrix(packed) -> np.ndarray:
    """The symmetric matrix stored in a `moments` array."""
    full = np.zeros((WIDTH, WIDTH))
    for (i, j), value in zip(moment_pairs(), packed):
        full[i, j] = full[j, i] = value
    return full


def solve_nnls(gram: np.ndarray, xty: np.ndarray, tolerance: float = 1e-10) -> np.ndarray | None:
    """Minimise c'Gc - 2c'b over c >= 0 with the active-set method of Lawson and Hanson (1974).

    Columns are scaled to unit norm first; a column that is all zero keeps coefficient zero.
    None if the optimality conditions are not met after many more steps than columns.
    """
    norm = np.sqrt(np.diag(gram))
    norm[norm == 0] = 1.0
    g, b = gram / np.outer(norm, norm), xty / norm
    limit = tolerance * max(1.0, np.abs(b).max())
    c = np.zeros(len(b))
    free = np.zeros(len(b), dtype=bool)
    for _ in range(20 * len(b)):
        slope = np.where(free, -np.inf, b - g @ c)
        if slope.max() <= limit:
            return c / norm
        free[slope.argmax()] = True
        while True:
            trial = np.zeros(len(b))
            trial[free] = np.linalg.lstsq(g[np.ix_(free, free)], b[free], rcond=None)[0]
            negative = free & (trial <= 0)
            if not negative.any():
                break
            step = (c[negative] / (c[negative] - trial[negative])).min()
            c = c + step * (trial - c)
            free &= c > 1e-14
            c[~free] = 0.0
        c = trial
    return None


def fit_nnls(moments: DataFrame) -> DataFrame:
    """Add `nnls`, the non-negative coefficients without intercept; null where a segment cannot be fitted.

    One moment row is one segment, so the solves need no further shuffle.
    """

    @F.pandas_udf("array<double>")
    def coefficients(packed: pd.Series, n_null: pd.Series) -> pd.Series:
        def one(values, nulls):
            if nulls or values is None or not np.all(np.isfinite(values)):
                return None
            m = moment_matrix(values)
            return solve_nnls(m[1:-1, 1:-1], m[1:-1, -1])

        return pd.Series([one(v, k) for v, k in zip(packed, n_null)], dtype=object)

    return moments.select(
        *SEGMENT, "n_kept", "n_null", "moments", coefficients(F.col("moments"), F.col("n_null")).alias("nnls")
    )
