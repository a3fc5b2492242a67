"""Cross-products of a feature vector and its label by fold, in one pass, and linear models solved from them.

A block of rows becomes its count, means and centred cross-products; blocks merge by the pairwise formula, so
sums never cancel. Tasks hand on the matrix in bands of rows, each band is merged in its own place, and the
driver gets one matrix a fold. Statistics of all folds but one follow by merging the others, so any number of
penalties, folds and models costs the one pass.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.functions.moments import Moments
from tessel.functions.nulls import col
from tessel.session import reach

#: Rows of the matrix in a band, and numbers of a dense block of rows.
BAND, BLOCK = 64, 1 << 21


def merge(a: Moments, b: Moments) -> Moments:
    """Statistics of the rows of both."""
    if not a.n or not b.n:
        return b if not a.n else a
    n, apart = a.n + b.n, b.mean - a.mean
    cov = (a.cov * a.n + b.cov * b.n + np.outer(apart, apart) * (a.n * b.n / n)) / n
    return Moments(n, a.mean + apart * (b.n / n), cov)


def but(parts: dict, fold) -> Moments:
    """Statistics of all folds but one."""
    return reduce(merge, (m for f, m in parts.items() if f != fold))


def grams(df: DataFrame, features: str, label: str, width: int, by: Column) -> dict:
    """Moments of ``[features, label]`` for each value of ``by``, a whole number of few values.

    Rows without a label do not count.
    """
    reach(df.sparkSession)
    rows = df.where(col(label).isNotNull()).select(by.cast("long").alias("fold"), col(label).cast("double").alias("y"), F.unwrap_udt(col(features)).alias("v")).select(
        "fold", "y", *places())
    schema = "fold long, band int, n long, mean binary, part binary"
    parts = rows.mapInArrow(_summed(width), schema)
    merged = parts.repartition("fold", "band").sortWithinPartitions("fold", "band").mapInArrow(_merged(width + 1), schema).collect()
    out = {}
    for fold in {r["fold"] for r in merged}:
        mine = sorted((r for r in merged if r["fold"] == fold), key=lambda r: r["band"])
        cov = np.concatenate([np.frombuffer(r["part"]) for r in mine]).reshape(width + 1, width + 1) / mine[0]["n"]
        out[fold] = Moments(mine[0]["n"], np.frombuffer(mine[0]["mean"]).copy(), cov)
    return out


def places(v: str = "v") -> list[Column]:
    """Columns ``at, x``: slots and values of an unwrapped vector. A dense one has no slots: null arrays are slow on their way to Python."""
    none = F.array().cast("array<int>")
    return [F.coalesce(F.when(F.col(f"{v}.type") == 0, F.col(f"{v}.indices")), none).alias("at"), F.col(f"{v}.values").alias("x")]


def dense_blocks(batch: pa.RecordBatch, width: int):
    """Dense rows ``[features, label]`` with their folds, a block at a time."""
    fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    at, x = batch.column(2), batch.column(3)
    dense = np.diff(at.offsets.to_numpy()) == 0  # a sparse vector without slots has no values either
    size = max(1, BLOCK // (width + 1))
    for a in range(0, batch.num_rows, size):
        n = min(size, batch.num_rows - a)
        out = np.zeros((n, width + 1))
        values = x.slice(a, n)
        lengths = np.diff(values.offsets.to_numpy())
        row, value = np.repeat(np.arange(n), lengths), values.flatten().to_numpy()
        place = np.empty(len(row), np.int64)
        within = dense[a:a + n][row]
        place[~within] = at.slice(a, n).flatten().to_numpy()
        starts = np.cumsum(lengths) - lengths
        place[within] = (np.arange(len(row)) - starts[row])[within]
        out[row, place] = value
        out[:, width] = y[a:a + n]
        yield fold[a:a + n], out


def _summed(width: int):
    def run(batches):
        held: dict[int, Moments] = {}
        for batch in batches:
            for fold, rows in dense_blocks(batch, width):
                for f in np.unique(fold).tolist():
                    mine = rows[fold == f]
                    mean = mine.mean(axis=0)
                    apart = mine - mean
                    made = Moments(len(mine), mean, apart.T @ apart / len(mine))
                    held[f] = merge(held[f], made) if f in held else made
        for f, m in held.items():
            for band in range(0, width + 1, BAND):
                yield _row(f, band // BAND, m.n, m.mean, m.cov[band:band + BAND] * m.n)
    return run


def _row(fold: int, band: int, n: int, mean: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([fold]), pa.array([band], pa.int32()), pa.array([n]), pa.array([mean.tobytes()], pa.binary()),
                                       pa.array([np.ascontiguousarray(part).tobytes()], pa.binary())], names=["fold", "band", "n", "mean", "part"])


def _merged(size: int):
    """Bands of sorted rows, merged as they stream by."""
    def run(batches):
        last = None
        for batch in batches:
            for r in batch.to_pylist():
                mean, part = np.frombuffer(r["mean"]), np.frombuffer(r["part"]).reshape(-1, size)
                if last is not None and last[:2] == (r["fold"], r["band"]):
                    _, band, n, old, sums = last
                    apart, total = mean - old, n + r["n"]
                    own = apart[band * BAND:band * BAND + len(part)]
                    last = (r["fold"], band, total, old + apart * (r["n"] / total), sums + part + np.outer(own, apart) * (n * r["n"] / total))
                else:
                    if last is not None:
                        yield _row(*last)
                    last = (r["fold"], r["band"], r["n"], mean, part)
        if last is not None:
            yield _row(*last)
    return run


def solve(m: Moments, l1: float, l2: float, tol: float = 1e-12, sweeps: int = 50_000) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise ``mean(e^2)/2 + l1*|w| + l2/2*|w|^2``; the last column is the label."""
    gram, xy = m.cov[:-1, :-1], m.cov[:-1, -1]
    if l1 <= 0:
        held = gram + l2 * np.eye(len(xy))
        try:
            w = np.linalg.solve(held, xy) if l2 > 0 else np.linalg.lstsq(held, xy, rcond=None)[0]
        except np.linalg.LinAlgError:
            w = np.linalg.lstsq(held, xy, rcond=None)[0]
    else:
        w = _descend(gram, xy, l1, l2, tol, sweeps)
    return w, float(m.mean[-1] - w @ m.mean[:-1])


def _descend(gram, xy, l1, l2, tol, sweeps) -> np.ndarray:
    """Coordinate descent: after each sweep over all columns, sweeps over the non-zero ones until they settle."""
    w, left = np.zeros(len(xy)), xy.copy()  # left = xy - gram @ w
    scale = np.diag(gram) + l2
    every = np.flatnonzero(np.diag(gram) > 0)
    least = tol * max(float(np.abs(xy).max(initial=0.0)), 1e-300)
    for _ in range(sweeps):
        if _sweep(every, w, left, gram, scale, l1) <= least:
            break
        active = every[w[every] != 0]
        for _ in range(sweeps):
            if _sweep(active, w, left, gram, scale, l1) <= least:
                break
    return w


def _sweep(columns, w, left, gram, scale, l1) -> float:
    """One update of each column; the largest change of a gradient."""
    most = 0.0
    for j in columns.tolist():
        old, pull = w[j], left[j] + gram[j, j] * w[j]
        new = math.copysign(max(abs(pull) - l1, 0.0), pull) / scale[j]
        if new != old:
            left -= gram[j] * (new - old)
            w[j] = new
            most = max(most, abs(new - old) * scale[j])
    return most


def linear_metrics(m: Moments, w: np.ndarray, intercept: float) -> dict:
    """``n, rmse, r2, pearson_r2`` of a linear model on the rows that the moments describe."""
    to_y, spread, var = w @ m.cov[:-1, -1], w @ m.cov[:-1, :-1] @ w, m.cov[-1, -1]
    mse = max(var - 2 * to_y + spread, 0.0) + (m.mean[-1] - intercept - w @ m.mean[:-1]) ** 2
    return {"n": m.n, "rmse": math.sqrt(mse), "r2": float(1 - mse / var) if var > 0 else None,
            "pearson_r2": float(to_y ** 2 / (spread * var)) if spread > 0 and var > 0 else None}


def dot(vector: str, weights, intercept) -> Column:
    """``weights . vector + intercept`` with built-in functions; a sparse vector's non-zero slots only.

    ``weights`` and ``intercept`` are numbers, or columns that hold them.
    """
    v = F.unwrap_udt(col(vector))
    table = weights if isinstance(weights, Column) else F.array(*[F.lit(float(w)) for w in weights])
    start = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    sparse = F.aggregate(F.arrays_zip(v["indices"].alias("at"), v["values"].alias("x")), start, lambda s, p: s + F.get(table, p["at"]) * p["x"])
    dense = F.aggregate(F.zip_with(v["values"], table, lambda x, w: x * w), start, lambda s, x: s + x)
    return F.when(v["type"] == 0, sparse).otherwise(dense)
