"""Regressors as Spark ML estimators, with penalties stated per summed squared error.

A family takes plain settings (``alpha``, ``n_estimators`` ...) and returns an estimator. Linear
families need the row count and the target's deviation, because Spark divides the squared loss
by the rows and the L2 penalty by the deviation of the target; ``LabelStats`` carries both.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.gram import dot
from tessel.functions.nulls import col
from tessel.operators.boost import HistogramBoost
from tessel.operators.encode import ColumnDrop

SEED = 42
NORMAL_LIMIT = 4096
DEEPEST = 30


@dataclass
class LabelStats:
    """What a linear family must know of the training rows."""

    rows: int
    sd_pop: float
    sd_samp: float
    n_features: int
    seed: int = SEED
    key: tuple[str, ...] = ()

    @classmethod
    def of(cls, df: DataFrame, label: str, n_features: int, seed: int = SEED, key=()) -> "LabelStats":
        r = df.agg(F.count(label), F.stddev_pop(label), F.stddev_samp(label)).first()
        return cls(r[0], r[1] or 1.0, r[2] or 1.0, n_features, seed, tuple(key))

    @property
    def solver(self) -> str:
        return "normal" if self.n_features <= NORMAL_LIMIT else "l-bfgs"

    @property
    def sd(self) -> float:
        return self.sd_pop if self.solver == "normal" else self.sd_samp


def linear(stats: LabelStats, l1: float, l2: float, label: str, features: str, max_iter: int) -> LinearRegression:
    """Minimises ``mean(e^2)/2 + l1*|w| + l2/2*|w|^2``."""
    scaled = l2 * stats.sd
    total = l1 + scaled
    return LinearRegression(
        labelCol=label, featuresCol=features, standardization=False, solver=stats.solver,
        regParam=total, elasticNetParam=l1 / total if total else 0.0, maxIter=max_iter, tol=1e-12)


#: Vectors up to this width have their linear models solved from one pass of cross-products (8 MB a fold).
GRAM_WIDTH = 1024


def penalties(family: str, settings: dict, rows: int) -> tuple[float, float] | None:
    """``(l1, l2)`` of a linear family as in :func:`linear`; None for other families or settings."""
    own = {k: v for k, v in settings.items() if k != "max_iter"}
    if family == "ridge" and set(own) <= {"alpha"}:
        return 0.0, own.get("alpha", 10.0) / max(rows, 1)
    if family == "lasso" and set(own) <= {"alpha"}:
        return own.get("alpha", 0.001), 0.0
    if family == "elasticnet" and set(own) <= {"alpha", "l1_ratio"}:
        alpha, share = own.get("alpha", 0.1), own.get("l1_ratio", 0.5)
        return alpha * share, alpha * (1 - share)
    return None


class LinearModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A linear model given by its weights; predicts with built-in functions."""

    state = Param(Params._dummy(), "state", "weights, intercept, features, prediction", TypeConverters.identity)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    @property
    def weights(self) -> np.ndarray:
        return np.array(self.getOrDefault("state")["weights"])

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.getOrDefault("state")["weights"])

    @property
    def intercept(self) -> float:
        return self.getOrDefault("state")["intercept"]

    def _transform(self, df):
        s = self.getOrDefault("state")
        return df.withColumn(s["prediction"], dot(s["features"], s["weights"], s["intercept"]))


def ridge(stats, label, features, alpha=10.0, max_iter=1000):
    return linear(stats, 0.0, alpha / stats.rows, label, features, max_iter)


def lasso(stats, label, features, alpha=0.001, max_iter=50_000):
    return linear(stats, alpha, 0.0, label, features, max_iter)


def elastic_net(stats, label, features, alpha=0.1, l1_ratio=0.5, max_iter=50_000):
    return linear(stats, alpha * l1_ratio, alpha * (1 - l1_ratio), label, features, max_iter)


def _subset(value) -> str:
    return str(value)


#: Rows of one training task of a forest: it keeps them binned, some 500 bytes each as measured, and reads them again for every group of nodes.
TASK_ROWS = 250_000


class DealtForest(RandomForestRegressor):
    """Spark's forest on rows dealt over enough tasks: a narrow table has few splits of very many rows."""

    def _fit(self, dataset):
        tasks = math.ceil(dataset.count() / TASK_ROWS)
        return super()._fit(dataset.repartition(tasks) if tasks > dataset.rdd.getNumPartitions() else dataset)


#: Trees up to this depth are walked from the root for every group of nodes: kept node numbers of all rows and trees, and their
#: checkpoints, take more disk than they save time.
SHALLOW = 10


def random_forest(stats, label, features, n_estimators=600, max_depth=None, min_samples_leaf=1,
                  max_features="sqrt", min_samples_split=2, max_bins=64):
    """``min_samples_split`` has no counterpart; no depth limit means Spark's deepest, 30."""
    return DealtForest(
        labelCol=label, featuresCol=features, numTrees=n_estimators,
        maxDepth=min(max_depth or DEEPEST, DEEPEST), minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=_subset(max_features), maxBins=max_bins, seed=stats.seed,
        cacheNodeIds=max_depth is None or not 0 < max_depth <= SHALLOW, checkpointInterval=10)


def xgb(stats, label, features, n_estimators=800, learning_rate=0.03, max_depth=6, subsample=0.8,
        colsample_bytree=0.8, min_child_weight=1.0, reg_lambda=1.0, reg_alpha=0.0, max_bins=64):
    """Penalised boosting: columns drawn per tree; with squared loss the least child weight is a least row count."""
    return HistogramBoost({
        "label": label, "features": features, "rounds": n_estimators, "rate": learning_rate,
        "depth": min(max_depth, DEEPEST), "subsample": subsample, "columns": colsample_bytree,
        "min_rows": max(1, min_child_weight), "l1": reg_alpha, "l2": reg_lambda, "bins": max_bins,
        "seed": stats.seed, "key": list(stats.key)})


def catboost(stats, label, features, n_estimators=1000, learning_rate=0.05, depth=6, l2_leaf_reg=3.0,
             subsample=0.8, max_bins=64):
    """Symmetric trees: all nodes of a level share one cut."""
    return HistogramBoost({
        "label": label, "features": features, "rounds": n_estimators, "rate": learning_rate, "depth": depth,
        "subsample": subsample, "l2": l2_leaf_reg, "symmetric": True, "bins": max_bins,
        "seed": stats.seed, "key": list(stats.key)})


def lgbm(stats, label, features, max_n_estimators=3000, learning_rate=0.03, max_depth=12, num_leaves=31,
         min_child_samples=20, min_child_weight=1e-3, subsample=0.8, colsample_bytree=0.8, reg_alpha=0.1,
         reg_lambda=1.0, min_split_gain=0.0, early_stopping_rounds=200, val_size=0.15, validation_tol=0.0, max_bins=64):
    """Boosting under a leaf budget, best cuts of a level first; a share of the rows, drawn by key hash, is held out:
    it ends after ``early_stopping_rounds`` without gain and keeps the best round."""
    depth = min(max_depth, DEEPEST) if max_depth and max_depth > 0 else DEEPEST
    return HistogramBoost({
        "label": label, "features": features, "rounds": max_n_estimators, "rate": learning_rate, "depth": depth,
        "leaves": min(num_leaves, 2 ** depth - 1), "min_rows": max(min_child_samples, min_child_weight),
        "subsample": subsample, "columns": colsample_bytree, "l1": reg_alpha, "l2": reg_lambda,
        "min_gain": min_split_gain, "held": val_size, "patience": early_stopping_rounds, "tolerance": validation_tol,
        "bins": max_bins, "seed": stats.seed, "key": list(stats.key)})


class FourierFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of an RBF kernel: a linear model on them approximates the kernel."""

    settings = Param(Params._dummy(), "settings", "size, gamma, seed", TypeConverters.identity)

    def __init__(self, settings: dict | None = None):
        super().__init__()
        self._set(settings=settings or {})

    def _fit(self, df):
        s = self.getOrDefault("settings")
        row = df.select(Summarizer.metrics("mean", "variance", "count").summary(col(s["featuresCol"])).alias("s")).first()["s"]
        mean, n = np.array(row["mean"]), row["count"]
        var = np.array(row["variance"]) * (n - 1) / max(n, 1)
        overall = float(np.mean(var + mean ** 2) - np.mean(mean) ** 2)
        gamma = s["gamma"]
        if gamma == "scale":
            gamma = 1.0 / (len(mean) * overall) if overall > 0 else 1.0
        elif gamma == "auto":
            gamma = 1.0 / len(mean)
        return FourierModel({**s, "gamma": float(gamma), "width": len(mean)})


class FourierModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted settings", TypeConverters.identity)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def _transform(self, df):
        s = self.getOrDefault("state")
        size, width, gamma, seed = s["size"], s["width"], s["gamma"], s["seed"]

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            rng = np.random.default_rng(seed)
            weights = rng.normal(scale=np.sqrt(2 * gamma), size=(width, size))
            shift = rng.uniform(0, 2 * np.pi, size)
            if len(rows) == 0:
                return pd.Series([], dtype=object)
            return pd.Series(list(np.cos(np.stack(rows.to_numpy()) @ weights + shift) * np.sqrt(2.0 / size)))

        return df.select("*", array_to_vector(project(vector_to_array(col(s["featuresCol"])))).alias(s["outputCol"]))


def svr(stats, label, features, C=10.0, epsilon=0.1, gamma="scale", size=256):
    """RBF regression, approximated: Fourier features, then ridge with ``alpha = 1/(2C)``.

    The squared loss has no insensitive band, so ``epsilon`` has no counterpart.
    """
    inner = LabelStats(stats.rows, stats.sd_pop, stats.sd_samp, size, stats.seed)
    return Pipeline(stages=[
        FourierFeatures({"featuresCol": features, "outputCol": "__rbf", "gamma": gamma, "size": size, "seed": stats.seed}),
        ridge(inner, label, "__rbf", alpha=1.0 / (2 * C)),
        ColumnDrop(["__rbf"]),
    ])


Family = Callable[..., Estimator]

# Families in the order in which a sweep trains them.
FAMILIES: dict[str, Family] = {
    "random_forest": random_forest,
    "elasticnet": elastic_net,
    "ridge": ridge,
    "lasso": lasso,
    "svr": svr,
    "xgb": xgb,
    "catboost": catboost,
    "lgbm": lgbm,
}

#: Families that read their rows two or three times: the boosters keep binned rows of their own.
FEW_PASSES = {"svr", "xgb", "catboost", "lgbm"}

# The defaults in the signatures above, and settings per family on top of them. "reference" trains the full-size models,
# "smoke" the same families small enough for a test.
PRESETS: dict[str, dict[str, dict]] = {
    "reference": {},
    "smoke": {
        "random_forest": {"n_estimators": 10, "max_depth": 6},
        "svr": {"size": 64},
        "xgb": {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3},
        "catboost": {"n_estimators": 8, "depth": 3, "learning_rate": 0.4},
        "lgbm": {"max_n_estimators": 10, "num_leaves": 15, "learning_rate": 0.3},
    },
}


@dataclass
class Spec:
    """A family and its settings: what a registry of models holds before fitting."""

    family: str
    settings: dict

    def build(self, stats: LabelStats, label: str, features: str = "features", prediction: str = "prediction"):
        if self.family not in FAMILIES:
            raise ValueError(f"unknown model family {self.family!r}")
        est = FAMILIES[self.family](stats, label, features, **self.settings)
        named_prediction(est, prediction)
        return est


def named_prediction(est, name: str) -> None:
    if isinstance(est, Pipeline):
        named_prediction(est.getStages()[-2], name)
    else:
        est.setPredictionCol(name)


def default_specs(preset: str = "reference", families: list[str] | None = None) -> dict[str, Spec]:
    chosen = PRESETS[preset]
    return {name: Spec(name, dict(chosen.get(name, {}))) for name in families or FAMILIES}


__all__ = [
    "DEEPEST", "FAMILIES", "GRAM_WIDTH", "PRESETS", "FourierFeatures", "FourierModel", "LabelStats",
    "LinearModel", "Spec", "default_specs", "linear", "penalties",
]
