"""Means and covariances of a few columns in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def pick(self, index: list[int]) -> "Moments":
        return Moments(self.n, self.mean[index], self.cov[np.ix_(index, index)])


def moments_by(df: DataFrame, exprs: list[Column], by: list[str]) -> dict[tuple, Moments]:
    """Population moments per group; ``by`` must name a few small groups such as folds."""
    k = len(exprs)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(e).alias(f"m{i}") for i, e in enumerate(exprs)],
        *[F.covar_pop(exprs[i], exprs[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).collect()
    out = {}
    for r in rows:
        cov = np.zeros((k, k))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
        out[tuple(r[b] for b in by)] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(k)]), cov)
    return out
