"""Model selection, search and stacking."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.modeling import FOLD_SQL, _shrunk, prepared, sales_frame, sales_plan
from checks.registry import query
from checks.views import LINES_SQL, lines, table
from tessel.functions.metrics import regression_metrics
from tessel.operators.models import Spec, default_specs
from tessel.operators.splits import stratified_split
from tessel.plans.evaluate import fit_and_score, leaderboard, prepare, select_top, sweep
from tessel.plans.run import RunConfig, full_run
from tessel.plans.search import (
    GRIDS, SMOKE_SPACES, best_of, grid_search, keep_baseline, random_search, refit_best, trials_table, tune_top)
from tessel.plans.stack import (
    JOIN, fit_stack, out_of_fold, stack_search, stack_trials_table, triples)
from tessel.session import discard, new_path, settled, tidy, wide
from tessel.sources.sinks import METRICS, results_table, trial_summary, write_results

# --- closed forms ------------------------------------------------------------------------


def _alphas(values) -> str:
    return ", ".join(f"({float(a)!r}::DOUBLE)" for a in values)


def _grid_sql(alphas) -> str:
    return f"""WITH {FOLD_SQL}, a(alpha) AS (VALUES {_alphas(alphas)}),
per AS (SELECT alpha, m.fold, sqrt(avg((y - ({_shrunk("n / (n + alpha)")})) ** 2)) AS rmse
  FROM xy JOIN m ON xy.fold = m.fold, a WHERE m.fold < 5 GROUP BY 1, 2)"""


GRID_SQL = f"""{_grid_sql(GRIDS["ridge"]["alpha"])}
SELECT alpha, round(avg(rmse), 4) AS value FROM per GROUP BY 1"""


@query("grid_search", GRID_SQL)
def grid_search_query(spark, sf_dir):
    """Mean CV error of every point of the ridge grid."""
    _, trials = grid_search("ridge", Spec("ridge", {}), GRIDS["ridge"], prepared(spark, sf_dir, "l_extendedprice"))
    return spark.createDataFrame([(t.settings["alpha"], t.value) for t in trials], "alpha double, value double").select(
        "alpha", F.round("value", 4).alias("value"))


@query("trials_table", GRID_SQL)
def trials_table_query(spark, sf_dir):
    """The trial log of the grid, written as CSV and read back."""
    _, trials = grid_search("ridge", Spec("ridge", {}), GRIDS["ridge"], prepared(spark, sf_dir, "l_extendedprice"))
    log, path = trials_table(spark, "ridge", trials), new_path(spark, "trials") + ".csv"
    write_results(log, path)
    back = spark.read.schema(log.schema).csv(path, header=True, escape="\\")
    alpha = F.get_json_object("settings", "$.alpha").cast("double")
    return back.select(alpha.alias("alpha"), F.round("value", 4).alias("value"))


BOARD = {"light": 10.0, "medium": 2000.0, "heavy": 50_000.0, "huge": 400_000.0}


@query("leaderboard_topk", f"""{_grid_sql(BOARD.values())}
SELECT CASE alpha {" ".join(f"WHEN {a!r} THEN '{n}'" for n, a in BOARD.items())} END AS model,
  round(avg(rmse), 4) AS cv_rmse_mean, round(stddev_pop(rmse), 4) AS cv_rmse_std FROM per GROUP BY alpha
ORDER BY avg(rmse), 1 LIMIT 3""")
def leaderboard_topk(spark, sf_dir):
    """The three best of four ridge models."""
    data = prepared(spark, sf_dir, "l_extendedprice")
    done = sweep({n: Spec("ridge", {"alpha": a}) for n, a in BOARD.items()}, data).whole()
    top = leaderboard(results_table(spark, {n: t.metrics for n, t in done.items()}), 3)
    return top.select("model", F.round("cv_rmse_mean", 4).alias("cv_rmse_mean"), F.round("cv_rmse_std", 4).alias("cv_rmse_std"))


@query("trial_summary", f"""WITH {LINES_SQL},
t AS (SELECT l_suppkey, l_returnflag || ' + ' || l_linestatus AS stack_combo,
  sqrt(avg((charge - l_extendedprice) ** 2)) AS value FROM lines GROUP BY 1, 2)
SELECT stack_combo, count(*) AS n_trials, round(min(value), 5) AS best_rmse, round(avg(value), 5) AS avg_rmse
FROM t GROUP BY 1""")
def trial_summary_query(spark, sf_dir):
    """Errors of the list price per supplier, summed up per flag and status."""
    combo = F.concat_ws(JOIN, "l_returnflag", "l_linestatus")
    rows = lines(spark, sf_dir).withColumn("stack_combo", combo)
    trials = regression_metrics(rows, "charge", "l_extendedprice", by=["l_suppkey", "stack_combo"])
    made = trial_summary(trials, value="rmse")
    return made.select("stack_combo", "n_trials", F.round("best_rmse", 5).alias("best_rmse"),
                       F.round("avg_rmse", 5).alias("avg_rmse"))


@query("model_triples", f"""WITH {LINES_SQL},
p AS (SELECT o_orderpriority AS name, sqrt(avg((charge - l_extendedprice) ** 2)) AS rmse
  FROM lines JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT name, row_number() OVER (ORDER BY rmse, name) AS pos FROM p)
SELECT a.name || ' + ' || b.name || ' + ' || c.name AS stack_combo
FROM r a JOIN r b ON a.pos < b.pos JOIN r c ON b.pos < c.pos""")
def model_triples(spark, sf_dir):
    """All triples of the order priorities, ranked by the error of the list price."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    rows = lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    board = regression_metrics(rows, "charge", "l_extendedprice", by=["o_orderpriority"])
    ranked = leaderboard(board.withColumnRenamed("o_orderpriority", "model"), 5, by="rmse")
    names = [r["model"] for r in ranked.orderBy("rmse", "model").collect()]
    return spark.createDataFrame([(JOIN.join(t),) for t in triples(names)], "stack_combo string")


_TUNED = "CASE WHEN p_type < 'M' THEN 0.99 ELSE 0.8 END"


@query("keep_baseline", f"""WITH {LINES_SQL},
s AS (SELECT p_type, charge AS y, l_extendedprice AS a, l_extendedprice * {_TUNED} AS b
  FROM lines JOIN part ON l_partkey = p_partkey),
m AS (SELECT p_type, sqrt(avg((y - a) ** 2)) AS ra, 1 - avg((y - a) ** 2) / var_pop(y) AS qa,
  sqrt(avg((y - b) ** 2)) AS rb, 1 - avg((y - b) ** 2) / var_pop(y) AS qb FROM s GROUP BY 1)
SELECT p_type AS model, round(ra, 5) AS cv_rmse_mean, round(qa, 8) AS cv_r2_mean, 0 AS kept_baseline FROM m
UNION ALL SELECT p_type || '_tuned', round(CASE WHEN rb > 1.01 * ra THEN ra ELSE rb END, 5),
  round(CASE WHEN rb > 1.01 * ra THEN qa ELSE qb END, 8), CAST(rb > 1.01 * ra AS INT) FROM m""")
def keep_baseline_query(spark, sf_dir):
    """Per part type: list price as baseline, discounted list price as its tuned rival."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = lines(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    factor = F.when(F.col("p_type") < "M", 0.99).otherwise(0.8)
    rows = rows.withColumn("rival", F.col("l_extendedprice") * factor)
    empty = [F.lit(None).cast("double").alias(m) for m in METRICS if m not in ("cv_rmse_mean", "cv_r2_mean")]

    def board(prediction: str, suffix: str):
        return regression_metrics(rows, "charge", prediction, by=["p_type"]).select(
            F.concat("p_type", F.lit(suffix)).alias("model"), F.col("rmse").alias("cv_rmse_mean"),
            F.col("r2").alias("cv_r2_mean"), *empty)

    made = keep_baseline(board("l_extendedprice", "").unionByName(board("rival", "_tuned")))
    return made.select("model", F.round("cv_rmse_mean", 5).alias("cv_rmse_mean"),
                       F.round("cv_r2_mean", 8).alias("cv_r2_mean"), F.col("kept_baseline").cast("int"))


OOF = {"plain": 0.0, "medium": 10_000.0, "heavy": 100_000.0}


@query("stack_oof", f"""WITH {FOLD_SQL},
t AS (SELECT row_key, x, y, ('0x' || substr(md5('inner-42:' || row_key), 1, 8))::BIGINT % 5 AS k FROM xy WHERE fold <> 5),
w AS (SELECT f.f AS k, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS c, var_pop(x) AS v
  FROM t, range(5) f(f) WHERE t.k <> f.f GROUP BY 1),
s AS (SELECT var_pop(x) AS v FROM t)
SELECT row_key, {", ".join(f"round(my + n * c / (n * w.v + {a!r} * s.v) * (x - mx), 1) AS p_{n}" for n, a in OOF.items())}
FROM t JOIN w ON t.k = w.k, s""")
def stack_oof(spark, sf_dir):
    """Out-of-fold predictions of three ridge models for all training rows."""
    data = prepared(spark, sf_dir, "l_extendedprice")
    specs = {n: Spec("ridge", {"alpha": a}) for n, a in OOF.items()}
    made, _ = out_of_fold(data.full, specs, data.label, inner=5)
    return made.select("row_key", *[F.round(f"p_{n}", 1).alias(f"p_{n}") for n in OOF])


# --- searches and tree models: checked by rows and by tests --------------------------------

@lru_cache(maxsize=4)
def _sales_data(app: str, sf_dir: str):
    spark = SparkSession.getActiveSession()
    df, path = settled(sales_frame(spark, sf_dir), "sales")
    tidy(spark)
    rows = stratified_split(df, "row_key", "charge").mark(df)
    made = prepare(rows, sales_plan(k_best=20), k=2, parallelism=4, dealt=wide(df))
    discard(spark, path)  # all rows are written again with their sides and folds
    return made


def sales_data(spark, sf_dir):
    return _sales_data(spark.sparkContext.applicationId, sf_dir)


def _holdout_query(name: str, family: str, preset: str = "smoke"):
    @query(name)
    def scored(spark, sf_dir):
        data = sales_data(spark, sf_dir)
        _, m = fit_and_score(default_specs(preset)[family], data.full, data.label)
        return spark.createDataFrame([(family, m["n"], m["rmse"], m["r2"])], "model string, n bigint, rmse double, r2 double")
    return scored


for _name, _family in (("random_forest", "random_forest"), ("gbt", "xgb"), ("gbt_symmetric", "catboost"), ("rbf_ridge", "svr")):
    _holdout_query(_name, _family)
# ten rounds could never stop early: the patience is 200 rounds
_holdout_query("gbt_early_stop", "lgbm", "reference")


@query("baseline_sweep")
def baseline_sweep(spark, sf_dir):
    """All eight families, small sizes, two folds."""
    done = sweep(default_specs("smoke"), sales_data(spark, sf_dir)).whole()
    return results_table(spark, {n: t.metrics for n, t in done.items()})


@query("random_search")
def random_search_query(spark, sf_dir):
    trials = random_search(default_specs("smoke")["elasticnet"], SMOKE_SPACES["elasticnet"], 4, sales_data(spark, sf_dir))
    return trials_table(spark, "elasticnet", trials)


@query("refit_best")
def refit_best_query(spark, sf_dir):
    data, base = sales_data(spark, sf_dir), default_specs("smoke")["random_forest"]
    trials = random_search(base, SMOKE_SPACES["random_forest"], 2, data)
    best = refit_best("random_forest", base, trials, data)
    return results_table(spark, {best.name: best.metrics, "best_trial": {"cv_rmse_mean": best_of(trials).value}})


@query("tune_top")
def tune_top_query(spark, sf_dir):
    """Two linear models: one goes to the grid, one to the random search."""
    data = sales_data(spark, sf_dir)
    specs = default_specs("smoke", ["elasticnet", "ridge"])
    base = sweep(specs, data).whole()
    tuned, _ = tune_top(select_top(base, 2), base, data, n_trials=2)
    return results_table(spark, {n: t.metrics for n, t in {**base, **tuned.whole()}.items()})


@query("stack_search")
def stack_search_query(spark, sf_dir):
    """Trials of stacks over four models, two outer and two inner folds."""
    data = sales_data(spark, sf_dir)
    specs = default_specs("smoke", ["ridge", "elasticnet", "lasso", "random_forest"])
    return stack_trials_table(spark, stack_search(specs, data, n_trials=6, inner=2))


@query("stack_fit")
def stack_fit_query(spark, sf_dir):
    """The best of a few stacks, fitted on all training rows and scored on the holdout."""
    data = prepared(spark, sf_dir, "l_extendedprice")
    specs = {n: Spec("ridge", {"alpha": a}) for n, a in OOF.items()}
    trials = stack_search(specs, data, n_trials=4, inner=2)
    best = min(trials, key=lambda t: (t.value, t.number))
    return results_table(spark, {"stacking": fit_stack(best, specs, data, inner=2).metrics})


@query("full_run")
def full_run_query(spark, sf_dir):
    """Sweep, rank, tune, stack, save, on the joined sales table."""
    config = RunConfig(top_k=3, trials_model=2, trials_stack=4, cv_splits=2, inner_splits=2, parallelism=4,
                       preset="smoke", families=["ridge", "elasticnet", "xgb"], output_dir=new_path(spark, "run"),
                       grids={"ridge": {"alpha": [1.0, 10.0]}})
    return full_run(sales_frame(spark, sf_dir), sales_plan(k_best=20), config).results


