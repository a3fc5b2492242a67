import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tessel.functions.metrics import regression_metrics
from tessel.operators import models
from tessel.operators.models import FAMILIES, LabelStats, Spec, default_specs
from tessel.session import shared_dir


@pytest.fixture(scope="module")
def data(spark):
    shared_dir(spark)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 3, 0.5]
    x[:, 2] += x[:, 0]
    y = 5 + x @ [2.0, -1.0, 0.3] + np.sin(x[:, 0] * 2) * 3 + rng.normal(size=400) * 0.1
    df = spark.createDataFrame(
        [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["id", "y", "features"]).repartition(4).cache()
    return x, y, df, LabelStats.of(df, "y", 3, key=("id",))


def descend(x, y, l1, l2):
    """Brute-force coordinate descent for mean(e^2)/2 + l1|w| + l2/2 w^2."""
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(5000):
        for j in range(len(w)):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (xc[:, j] @ xc[:, j] / len(y) + l2)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("family,settings,l1,l2", [
    ("ridge", {"alpha": 50.0}, 0.0, 50.0 / 400), ("lasso", {"alpha": 0.4}, 0.4, 0.0),
    ("elasticnet", {"alpha": 0.6, "l1_ratio": 0.3}, 0.18, 0.42)])
def test_penalties_match_the_textbook(data, family, settings, l1, l2):
    x, y, df, stats = data
    model = Spec(family, settings).build(stats, "y").fit(df)
    w, b = descend(x, y, l1, l2)
    np.testing.assert_allclose(model.coefficients.toArray(), w, rtol=1e-5, atol=1e-6)
    assert abs(model.intercept - b) < 1e-5


def test_wide_tables_switch_solver(data):
    x, y, df, stats = data
    wide = LabelStats(stats.rows, stats.sd_pop, stats.sd_samp, 5000)
    assert wide.solver == "l-bfgs"
    model = Spec("ridge", {"alpha": 50.0}).build(wide, "y").fit(df)
    np.testing.assert_allclose(model.coefficients.toArray(), descend(x, y, 0.0, 50.0 / 400)[0], rtol=1e-4)


@pytest.mark.parametrize("family", ["random_forest", "xgb", "catboost", "lgbm", "svr"])
def test_beats_the_mean(data, family):
    _, _, df, stats = data
    model = default_specs("smoke")[family].build(stats, "y").fit(df)
    assert regression_metrics(model.transform(df), "y").first()["r2"] > 0.5


def test_early_stop_keeps_fewer_trees(data):
    _, _, df, stats = data
    spec = Spec("lgbm", {"max_n_estimators": 40, "learning_rate": 0.5, "validation_tol": 0.05, "num_leaves": 7})
    assert spec.build(stats, "y").fit(df).getNumTrees < 40


def test_defaults_cover_all_families():
    assert list(default_specs()) == list(FAMILIES)
    with pytest.raises(ValueError):
        Spec("none", {}).build(LabelStats(1, 1.0, 1.0, 1), "y")


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.2), (2.0, 1.8), (3.0, 3.5)], "y double, prediction double")
    m = regression_metrics(df, "y").first()
    assert abs(m["rmse"] - np.sqrt(0.11)) < 1e-12 and abs(m["r2"] - (1 - 0.33 / 2)) < 1e-12
    assert abs(m["pearson_r2"] - np.corrcoef([1, 2, 3], [1.2, 1.8, 3.5])[0, 1] ** 2) < 1e-12


def test_forest_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """A table in one split is dealt over tasks; one that has enough tasks is left as it is."""
    seen = []
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    monkeypatch.setattr(models.RandomForestRegressor, "_fit", lambda self, df: seen.append([len(p) for p in df.rdd.glom().collect()]))
    df = spark.range(1000).coalesce(1)
    est = models.Spec("random_forest", {"n_estimators": 1}).build(models.LabelStats(1000, 1.0, 1.0, 1), "id")
    est.fit(df)
    est.fit(spark.range(50).coalesce(1))
    assert sum(seen[0]) == 1000 and len(seen[0]) == 10 and max(seen[0]) <= 110 and seen[1] == [50]
