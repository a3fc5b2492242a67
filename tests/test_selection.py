import random

import pytest
from pyspark.sql import functions as F

from tessel.functions.metrics import regression_metrics
from tessel.operators.models import LabelStats, Spec
from tessel.operators.splits import stratified_split
from tessel.plans.evaluate import Prepared, Trained, cross_validate, leaderboard, prepare, select_top, sweep
from tessel.plans.features import FeaturePlan
from tessel.plans.run import RunConfig, full_run
from tessel.plans.search import (
    GRIDS, SPACES, best_of, draw, grid_points, grid_search, guarded, keep_baseline, random_search, tune_top)
from tessel.plans.stack import (
    elastic_net_of, fit_meta, fit_stack, out_of_fold, rmse_of, stack_search, stack_table, triples)
from tessel.sources.sinks import load_model, results_table
from tessel.streaming.score import score_stream

PLAN = FeaturePlan(key=["id"], target="y", min_freq=5)
LINEAR = {"ridge": Spec("ridge", {}), "lasso": Spec("lasso", {"alpha": 0.5}), "elasticnet": Spec("elasticnet", {})}


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(400).select(
        i, (i * 17 % 89).cast("double").alias("a"), F.when(i % 9 != 0, (i * 5 % 31).cast("double")).alias("b"),
        F.concat(F.lit("g"), (i % 4).cast("string")).alias("g"),
        (i * 17 % 89 * 2 + i * 5 % 31 * i % 7 + i % 4 * 10).cast("double").alias("y"))


@pytest.fixture(scope="module")
def data(table):
    return prepare(stratified_split(table, "id", "y").mark(table), PLAN, k=3, parallelism=4)


def test_prepared_sides(data):
    assert data.full.train.count() + data.full.held.count() == 400
    train = data.full.train.count()
    assert sum(f.held.count() for f in data.folds) == train
    assert all(f.train.count() + f.held.count() == train for f in data.folds)


def test_fold_features_see_training_rows_only(data):
    """Means learned per fold differ, and equal the mean of that fold's training rows."""
    means = [s.learned["scale"]["a"][0] for f in [*data.folds, data.full]
             for s in f.features.model.stages if type(s).__name__ == "StandardizeModel"]
    assert len(set(means)) == 4


def test_sweep_survives_a_broken_model(data):
    done = sweep({"bad": Spec("nothing", {}), "ridge": Spec("ridge", {})}, data)
    assert list(done) == ["ridge"] and done["ridge"].metrics["test_r2"] > 0.3


def test_top_and_leaderboard(spark):
    made = {n: Trained(n, Spec("ridge", {}), None, {"cv_rmse_mean": v}) for n, v in (("b", 2.0), ("a", 2.0), ("c", 1.0), ("d", None))}
    assert select_top(made, 3) == ["c", "a", "b"]
    board = leaderboard(results_table(spark, {n: t.metrics for n, t in made.items()}), 3)
    assert [r["model"] for r in board.collect()] == ["c", "a", "b"]
    with pytest.raises(RuntimeError):
        select_top({})


def test_search_spaces_and_seed():
    for space in SPACES.values():
        rng = random.Random(1)
        for _ in range(50):
            for name, value in draw(space, rng).items():
                kind, *args = space[name]
                assert value in args[0] if kind == "choice" else args[0] <= value <= args[1]
                if kind == "int":
                    assert (value - args[0]) % args[2] == 0
    assert draw(SPACES["lgbm"], random.Random(3)) == draw(SPACES["lgbm"], random.Random(3))
    assert [len(grid_points(g)) for g in GRIDS.values()] == [4, 5, 24]


def test_grid_and_random_search(data):
    best, trials = grid_search("ridge", Spec("ridge", {}), {"alpha": [1.0, 1e6]}, data)
    assert best.name == "ridge_grid" and best.spec.settings == {"alpha": 1.0} and best.metrics["cv_rmse_std"] is None
    assert trials[0].value < trials[1].value
    a, b = (random_search(Spec("elasticnet", {}), SPACES["elasticnet"], 2, data, seed=5) for _ in range(2))
    assert [(t.settings, t.value) for t in a] == [(t.settings, t.value) for t in b]
    assert best_of(a).value == min(t.value for t in a)


def test_guard():
    def trained(name, cv, test):
        return Trained(name, Spec("ridge", {}), None, {"cv_rmse_mean": cv, "test_rmse": test})

    base, tuned = trained("m", 1.0, 1.0), trained("m_tuned", 1.005, 1.5)
    assert guarded(tuned, base) is tuned and guarded(tuned, None) is tuned
    kept = guarded(tuned, base, "holdout")
    assert kept.name == "m_tuned" and kept.metrics == base.metrics


def test_keep_baseline_table(spark):
    rows = {"a": {"cv_rmse_mean": 1.0}, "a_tuned": {"cv_rmse_mean": 1.02}, "b": {"cv_rmse_mean": 1.0}, "b_tuned": {"cv_rmse_mean": 1.01}}
    got = {r["model"]: (r["cv_rmse_mean"], r["kept_baseline"]) for r in keep_baseline(results_table(spark, rows)).collect()}
    assert got == {"a": (1.0, False), "a_tuned": (1.0, True), "b": (1.0, False), "b_tuned": (1.01, False)}


def test_tune_top_skips_unknown_and_survives(data):
    base = sweep({"ridge": Spec("ridge", {}), "lasso": Spec("lasso", {})}, data)
    base["odd"] = Trained("odd", Spec("odd", {}), None, {"cv_rmse_mean": 0.0})
    tuned, logs = tune_top(["odd", "ridge", "lasso"], base, data, grids={"ridge": {"alpha": [1.0]}, "lasso": {"wrong": [1]}})
    assert list(tuned) == ["ridge_grid"] and "ridge" in logs


def test_triples():
    assert len(triples(list("abcde"))) == 10
    with pytest.raises(ValueError):
        triples(["a", "b"])


def test_out_of_fold_rows_are_whole_and_unseen(data):
    made, models = out_of_fold(data.full, LINEAR, "y", inner=4)
    assert made.count() == data.full.train.count() and set(models) == set(LINEAR)
    seen = models["ridge"].transform(data.full.train).select("id", F.col("p_ridge").alias("seen"))
    both = made.join(seen, "id")
    assert both.where(F.abs(F.col("p_ridge") - F.col("seen")) < 1e-12).count() == 0


def objective(m, w, alpha, l1):
    scaled = w * (m.cov.diagonal()[:-1] ** 0.5)
    fit = m.cov[-1, -1] / 2 - w @ m.cov[:-1, -1] + w @ m.cov[:-1, :-1] @ w / 2
    return fit + alpha * l1 * abs(scaled).sum() + alpha * (1 - l1) / 2 * scaled @ scaled


def test_moments_give_the_model_that_training_gives(data):
    """The pass-free trial equals the trained, scaled elastic net, and its error the scored one."""
    table = stack_table(data.folds[0], LINEAR, "y", 3, 42)
    combo = ("ridge", "lasso", "elasticnet")
    known, held = table.moments()
    for alpha, l1 in ((0.5, 0.5), (0.001, 0.9), (5.0, 1.0)):
        w, b = elastic_net_of(known, alpha, l1)
        stats = LabelStats.of(table.rows.where("not held"), "y", 3)
        model = fit_meta(table, stats, combo, alpha, l1, False)
        scaler, net = model.stages[1], model.stages[2]
        trained = net.coefficients.toArray() / scaler.std.toArray()
        assert objective(known, w, alpha, l1) <= objective(known, trained, alpha, l1) + 1e-9
        assert objective(known, w, alpha, l1) == pytest.approx(objective(known, trained, alpha, l1), rel=1e-2)
        scored = regression_metrics(model.transform(table.rows.where("held")), "y").first()["rmse"]
        assert rmse_of(held, trained, net.intercept) == pytest.approx(scored, rel=1e-9)
        assert rmse_of(held, w, b) == pytest.approx(scored, rel=1e-2)


def test_stack_search_and_fit(data):
    trials = stack_search(LINEAR, data, n_trials=3, inner=2)
    assert [t.value for t in trials] == [t.value for t in stack_search(LINEAR, data, n_trials=3, inner=2)]
    done = fit_stack(min(trials, key=lambda t: t.value), LINEAR, data, inner=2)
    assert done.metrics["test_r2"] > 0.3 and done.metrics["cv_rmse_std"] is None
    with pytest.raises(ValueError):
        stack_search({"ridge": Spec("ridge", {})}, data)


def test_full_run_saves_tuned_and_stacked_models(spark, table, tmp_path):
    config = RunConfig(cv_splits=2, inner_splits=2, trials_model=1, trials_stack=2, preset="smoke",
                       families=["elasticnet", "ridge", "lasso"], output_dir=str(tmp_path),
                       grids={"ridge": {"alpha": [1.0]}, "lasso": {"alpha": [0.1]}})
    done = full_run(table, PLAN, config)
    names = [r["model"] for r in done.results.collect()]
    assert set(names) == {"elasticnet", "ridge", "lasso", "elasticnet_tuned", "ridge_grid", "lasso_grid", "stacking"}
    assert {p.name for p in (tmp_path / "models").iterdir()} == {"elasticnet_tuned", "ridge_grid", "lasso_grid", "stacking"}
    name, model = load_model(str(tmp_path / "models" / "stacking"))
    scores = model.transform(table).select("id", "prediction").collect()
    live = done.trained["stacking"].model.transform(table).select("id", "prediction").collect()
    assert name == "stacking" and sorted(scores) == sorted(live)


def test_two_tuned_models_skip_stacking(table):
    config = RunConfig(cv_splits=2, families=["ridge"], grids={"ridge": {"alpha": [1.0]}})
    assert [r["model"] for r in full_run(table, PLAN, config).results.collect()] == ["ridge", "ridge_grid"]


def test_stream_scores_equal_batch_scores(spark, table, data, tmp_path):
    from pyspark.ml import PipelineModel

    model = PipelineModel(stages=[data.full.features.model, LINEAR["ridge"].build(data.full.stats, "y").fit(data.full.train)])
    table.drop("y").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.drop("y").schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(model, stream, "id", str(tmp_path / "out"), available_now=True).awaitTermination(120)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["id"]: r["prediction"] for r in model.transform(table).collect()}
    assert got == pytest.approx(want)
    more = table.drop("y").withColumn("id", F.col("id") + 1_000_000)
    more.write.mode("append").parquet(str(tmp_path / "in"))
    score_stream(model, stream, "id", str(tmp_path / "out"), available_now=True).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2 * table.count()


def test_cross_validate_rows(data):
    assert [m["fold"] for m in cross_validate(Spec("ridge", {}), data)] == [0, 1, 2]


def test_rows_of_one_file_are_dealt_out(spark):
    """A table read by one task does not leave all later passes to one task."""
    rows = spark.range(400_000).coalesce(1).select("id", F.rand(1).alias("a"), F.rand(2).alias("y"), F.lit(False).alias("is_test"))
    made = prepare(rows, FeaturePlan(key=["id"], target="y"), k=2)
    assert len(made.full.projected.inputFiles()) > 1
    assert made.full.rows.count() == 400_000


def test_linear_models_write_no_encoded_table(table):
    """Cross-products come from the projection; a table that a tree family needs later gives the same ones."""
    made = prepare(stratified_split(table, "id", "y").mark(table), PLAN, k=2)
    before = cross_validate(Spec("ridge", {}), made)
    stack_search(LINEAR, made, n_trials=2, inner=2)
    assert all(f.written is None for f in made.folds)
    for f in made.folds:
        assert f.train.count() + f.held.count() == f.projected.count()
        f.found = None
    for a, b in zip(before, cross_validate(Spec("ridge", {}), made)):
        assert a == pytest.approx(b)


def test_features_are_fitted_when_asked_for(data, monkeypatch):
    """Folds alone do not fit the full table, nor the other way round, and each is fitted once."""
    asked, make = [], data.make
    fresh = Prepared(data.plan, data.rows, lambda fold: asked.append(fold) or make(fold), data.k, data.parallelism)
    fresh.full, fresh.full
    assert asked == [None]
    cross_validate(Spec("ridge", {}), fresh)
    cross_validate(Spec("lasso", {}), fresh)
    assert sorted(asked[1:]) == list(range(data.k))


def test_a_failure_is_no_result(data, table, monkeypatch, tmp_path):
    """Errors of single models are kept and raised once the rest is done; nothing passes for a whole sweep."""
    done = sweep({"bad": Spec("nothing", {}), "ridge": Spec("ridge", {})}, data)
    assert isinstance(done.failed["bad"], ValueError)
    with pytest.raises(RuntimeError, match="bad: ValueError"):
        done.whole()
    tuned, _ = tune_top(["ridge", "lasso"], sweep({"ridge": Spec("ridge", {}), "lasso": Spec("lasso", {})}, data).whole(), data,
                        grids={"ridge": {"alpha": [1.0]}, "lasso": {"wrong": [1]}})
    assert list(tuned.failed) == ["lasso"]
    config = RunConfig(cv_splits=2, families=["ridge", "lasso"], grids={"ridge": {"alpha": [1.0]}, "lasso": {"wrong": [1]}}, output_dir=str(tmp_path))
    with pytest.raises(RuntimeError, match="tuned lasso"):
        full_run(table, PLAN, config)
    assert (tmp_path / "model_results.csv").exists() and (tmp_path / "models" / "ridge_grid").exists()
    from checks import selection

    monkeypatch.setattr(selection, "sales_data", lambda *_: data)
    monkeypatch.setattr(selection, "default_specs", lambda *_: {"bad": Spec("nothing", {}), "ridge": Spec("ridge", {})})
    with pytest.raises(RuntimeError, match="bad"):
        selection.baseline_sweep(data.rows.sparkSession, "")


def test_early_stop_query_has_room_to_stop(data, monkeypatch):
    """The query trains the full-size model: more rounds than its patience."""
    from checks import selection
    from checks.registry import QUERIES

    seen = []
    monkeypatch.setattr(selection, "sales_data", lambda *_: data)
    monkeypatch.setattr(selection, "fit_and_score", lambda spec, rows, label: seen.append(spec.build(rows.stats, label)) or (None, {"n": 1, "rmse": 1.0, "r2": 1.0}))
    QUERIES["gbt_early_stop"](data.rows.sparkSession, "")
    s = seen[0].getOrDefault("settings")
    assert s["rounds"] == 3000 and 0 < s["patience"] < s["rounds"] and s["held"] > 0 and s["leaves"] == 31


def test_scratch_tables_that_one_model_does_not_need(spark, table):
    """One booster reads the projection, a second one has the encoded rows written; the table of a full run goes
    once its rows are written again; dealt rows are not shuffled once more."""
    import glob

    from tessel.plans.evaluate import fit_and_score
    from tessel.session import shared_dir

    made = prepare(stratified_split(table, "id", "y").mark(table), PLAN, k=2)
    spec = Spec("xgb", {"n_estimators": 1, "max_depth": 1})
    first = fit_and_score(spec, made.full, "y")[1]
    assert made.full.written is None
    assert fit_and_score(spec, made.full, "y")[1] == pytest.approx(first) and made.full.written is not None
    full_run(table, PLAN, RunConfig(cv_splits=2, families=["ridge"], grids={"ridge": {"alpha": [1.0]}}))
    assert not glob.glob(f"{shared_dir(spark)}/table-*")
    rows = table.repartition(3).withColumn("is_test", F.col("id") % 5 == 0)
    assert len(prepare(rows, PLAN, k=2, dealt=True).rows.inputFiles()) == 3
