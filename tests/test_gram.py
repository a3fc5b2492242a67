import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tessel.functions import gram
from tessel.functions.gram import but, dot, grams, linear_metrics, merge, solve
from tessel.functions.hashing import fold_of
from tessel.operators.models import LabelStats, LinearModel, Spec, penalties
from tessel.operators.splits import stratified_split
from tessel.plans.evaluate import cross_validate, fit_and_score, prepare
from tessel.plans.features import FeaturePlan
from tessel.plans.search import grid_points, run_trials
from tessel.plans.stack import out_of_fold


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 70)) * (rng.random((400, 70)) < 0.3) + 1000 * (np.arange(70) == 3)
    y = x[:, :5] @ [1, -2, 0.5, 3, 0] + rng.normal(size=400) + 1e6
    rows = [(i, int(i % 3), float(y[i]), Vectors.sparse(70, [(j, v) for j, v in enumerate(x[i]) if v]) if i % 2 else Vectors.dense(x[i])) for i in range(400)]
    return spark.createDataFrame(rows, ["id", "fold", "y", "features"]).repartition(7), x, y


def test_cross_products_by_fold(vectors):
    df, x, y = vectors
    parts = grams(df, "features", "y", 70, F.col("fold"))
    every = np.column_stack([x, y])
    for fold, m in parts.items():
        mine = every[np.arange(400) % 3 == fold]
        assert m.n == len(mine)
        np.testing.assert_allclose(m.mean, mine.mean(0), rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(m.cov, np.cov(mine.T, bias=True), rtol=1e-8, atol=1e-9)
    rest = every[np.arange(400) % 3 != 1]
    np.testing.assert_allclose(but(parts, 1).cov, np.cov(rest.T, bias=True), rtol=1e-8, atol=1e-9)
    assert merge(but(parts, 1), parts[1]).n == 400


@pytest.mark.parametrize("family,settings", [("ridge", {"alpha": 7.0}), ("lasso", {"alpha": 0.05}), ("elasticnet", {"alpha": 0.2, "l1_ratio": 0.3})])
def test_solutions_equal_the_library(vectors, family, settings):
    df, x, y = vectors
    moments = grams(df, "features", "y", 70, F.lit(0))[0]
    w, b = solve(moments, *penalties(family, settings, 400))
    model = Spec(family, settings).build(LabelStats.of(df, "y", 70), "y").fit(df)
    assert np.allclose(w, model.coefficients.toArray(), rtol=2e-3, atol=2e-3)

    def objective(w, b):
        l1, l2 = penalties(family, settings, 400)
        return np.mean((y - x @ w - b) ** 2) / 2 + l1 * np.abs(w).sum() + l2 / 2 * w @ w

    assert objective(w, b) <= objective(model.coefficients.toArray(), model.intercept) + 1e-7
    got = LinearModel({"weights": w.tolist(), "intercept": b, "features": "features", "prediction": "p"}).transform(df).toPandas()
    np.testing.assert_allclose(got.sort_values("id")["p"], x @ w + b, rtol=1e-10)
    error = got["y"] - got["p"]
    found = linear_metrics(moments, w, b)
    assert math.isclose(found["rmse"], math.sqrt((error ** 2).mean()), rel_tol=1e-6)
    assert math.isclose(found["pearson_r2"], np.corrcoef(got["y"], got["p"])[0, 1] ** 2, rel_tol=1e-6)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(0, 1), rng.choice("abc"), 0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, c string, y double").withColumn("y", F.col("x") * 3 + F.when(F.col("c") == "a", 2.0).otherwise(0.0) + F.col("id") % 5)
    return prepare(stratified_split(df, "id", "y").mark(df), FeaturePlan(key=["id"], target="y"), k=3)


def jobs(spark, work):
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_passes_do_not_depend_on_points(spark, data):
    data.parallelism = 1
    base = Spec("ridge", {})
    run_trials(base, [{"alpha": 1.0}], data)
    assert jobs(spark, lambda: run_trials(base, grid_points({"alpha": [0.1, 1.0, 10.0, 100.0]}), data)) == 0
    assert jobs(spark, lambda: run_trials(Spec("lasso", {}), grid_points({"alpha": [0.1, 1.0]}), data)) == 0


def test_fold_errors_equal_predictions(data):
    spec = Spec("elasticnet", {"alpha": 0.05})
    for encoded, found in zip(data.folds, cross_validate(spec, data)):
        model, _ = fit_and_score(spec, encoded, data.label)
        rows = model.transform(encoded.held).select("y", "prediction").toPandas()
        assert math.isclose(found["rmse"], math.sqrt(((rows["y"] - rows["prediction"]) ** 2).mean()), rel_tol=1e-9) and found["n"] == len(rows)


def test_out_of_fold_of_mixed_families(data):
    specs = {"r": Spec("ridge", {"alpha": 3.0}), "t": Spec("random_forest", {"n_estimators": 2, "max_depth": 2}), "l": Spec("lasso", {"alpha": 0.1})}
    table, models = out_of_fold(data.full, specs, data.label, inner=3)
    assert set(models) == set(specs) and {"p_r", "p_t", "p_l"} <= set(table.columns)
    rows = table.select("id", "y", "p_r", "p_t", "p_l", vector_to_array("features").alias("v")).toPandas()
    assert len(rows) == data.full.train.count() and not rows[["p_r", "p_t", "p_l"]].isna().any().any()
    inner = dict(data.full.train.select("id", fold_of(["id"], 3, "inner-42")).collect())
    fold = rows["id"].map(inner)
    x, y = np.stack(rows["v"]), rows["y"].to_numpy()
    for f in range(3):
        known = (fold != f).to_numpy()
        mean, label = x[known].mean(0), y[known].mean()
        a = x[known] - mean
        w = np.linalg.solve(a.T @ a + 3.0 * np.eye(x.shape[1]), a.T @ (y[known] - label))
        np.testing.assert_allclose(rows["p_r"][~known], (x[~known] - mean) @ w + label, rtol=1e-8)


def test_a_linear_model_is_saved(spark, vectors, tmp_path):
    df, _, _ = vectors
    model = LinearModel({"weights": [0.5] * 70, "intercept": 2.0, "features": "features", "prediction": "p"})
    model.save(str(tmp_path / "m"))
    assert LinearModel.load(str(tmp_path / "m")).transform(df).orderBy("id").collect() == model.transform(df).orderBy("id").collect()
    assert df.select(dot("features", np.zeros(70), 3.0).alias("z")).distinct().collect()[0]["z"] == 3.0


def test_passthrough_trials_equal_the_fitted_stack(data):
    from tessel.plans.stack import _passthrough_rmse, meta_stages, rmse_of, scaled_net, stack_table

    specs = {n: Spec("ridge", {"alpha": a}) for n, a in (("a", 0.1), ("b", 10.0), ("c", 300.0))}
    fold = data.folds[0]
    table = stack_table(fold, specs, data.label, 3, 42)
    known, held = table.wide_moments()
    for alpha, l1 in ((0.01, 0.5), (0.3, 0.1), (0.05, 0.9)):
        w, b = scaled_net(known, alpha, l1)
        assert math.isclose(rmse_of(held, w, b), _passthrough_rmse(table, fold, tuple(specs), alpha, l1), rel_tol=1e-9)
        stats = LabelStats.of(table.rows.where("not held"), "y", len(w))
        trained = meta_stages(tuple(specs), stats, "y", alpha, l1, True).fit(table.rows.where("not held"))
        at = trained.stages[2].coefficients.toArray() / np.maximum(trained.stages[1].std.toArray(), 1e-300)
        sd = np.sqrt(known.cov.diagonal()[:-1])

        def objective(w):
            fit = known.cov[-1, -1] / 2 - w @ known.cov[:-1, -1] + w @ known.cov[:-1, :-1] @ w / 2
            return fit + alpha * l1 * abs(w * sd).sum() + alpha * (1 - l1) / 2 * ((w * sd) ** 2).sum()

        assert objective(w) <= objective(at) + 1e-9


def test_no_array_on_the_way_to_python_is_null(spark):
    """Dense, sparse and empty sparse vectors: none sends a null array, and all become the same dense rows."""
    vectors = [Vectors.dense([1.0, 0.0, 2.0]), Vectors.sparse(3, [2], [5.0]), Vectors.sparse(3, [], [])]
    df = spark.createDataFrame([(0, float(i), v) for i, v in enumerate(vectors)], StructType([
        StructField("fold", LongType()), StructField("y", DoubleType()), StructField("features", VectorUDT())]))
    rows = df.select("fold", "y", F.unwrap_udt("features").alias("v")).select("fold", "y", *gram.places()).coalesce(1)
    assert rows.where("at is null or x is null").count() == 0
    batch = rows.orderBy("y").toArrow().combine_chunks().to_batches()[0]
    _, dense = next(gram.dense_blocks(batch, 3))
    assert dense.tolist() == [[1, 0, 2, 0], [0, 0, 5, 1], [0, 0, 0, 2]]
