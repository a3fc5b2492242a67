"""Splits, folds, metrics, regressors and the feature plan."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    LINE_GAPS_SQL, LINES_SQL, PART_GAPS_SQL, PRIORITIES, SALES_SQL, line_gaps, lines, part_gaps, sales, table)
from tessel.functions.hashing import fold_of
from tessel.functions.metrics import regression_metrics
from tessel.operators import derive as d
from tessel.operators.boost import HistogramBoost
from tessel.operators.encode import explode_vector
from tessel.operators.models import LabelStats, Spec
from tessel.operators.splits import HELD, random_split, stratified_split, target_bin
from tessel.plans.evaluate import cross_validate, fit_and_score, prepare, train_one
from tessel.plans.features import FeaturePlan, fit_features
from tessel.session import new_path, settle
from tessel.sources.sinks import (
    load_model, results_table, run_report, save_model, score, write_results, write_scores)

_FIFTEENTHS = "[" + ", ".join(f"{i / 15!r}" for i in range(1, 15)) + "]"


def binned_sql(source: str, target: str, key: str, extra: str = "") -> str:
    """CTEs ``edges``, ``binned`` and ``split``: target bin, key hash and holdout flag."""
    return f"""edges AS (SELECT list_distinct(quantile_cont({target}, {_FIFTEENTHS})) AS e FROM {source}),
binned AS (SELECT {source}.*, CAST(len(list_filter(e, lambda x: x < {target})) AS INT) AS bin,
  md5('42:' || {key}) AS h FROM {source}, edges),
split AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY h)
    <= round(count(*) OVER (PARTITION BY bin) * 0.2) AS is_test,
  CAST(('0x' || substr(h, 1, 8))::BIGINT % 5 AS INT) AS fold FROM binned)"""


# --- splits ----------------------------------------------------------------------------

@query("quantile_bins", f"""WITH {binned_sql("orders", "o_totalprice", "o_orderkey")}
SELECT o_orderkey, bin FROM binned""")
def quantile_bins(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return df.select("o_orderkey", target_bin(df, "o_totalprice").cast("int").alias("bin"))


@query("quantile_bins_ties", f"""WITH {binned_sql("lines", "l_quantity", "row_key").replace("edges AS", LINES_SQL + ", edges AS", 1)}
SELECT row_key, bin FROM binned""")
def quantile_bins_ties(spark, sf_dir):
    """A target of 50 distinct values: many rows sit on an edge."""
    df = lines(spark, sf_dir)
    return df.select("row_key", target_bin(df, "l_quantity").cast("int").alias("bin"))


@query("stratified_split", f"""WITH {binned_sql("orders", "o_totalprice", "o_orderkey")}
SELECT o_orderkey, CAST(is_test AS INT) AS is_test FROM split""")
def stratified(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    split = stratified_split(df, "o_orderkey", "o_totalprice")
    return df.select("o_orderkey", split.is_test.cast("int").alias("is_test"))


@query("random_split", """
SELECT p_partkey, CAST(row_number() OVER (ORDER BY md5('7:' || p_partkey)) <= round(count(*) OVER () * 0.25) AS INT)
  AS is_test FROM part""")
def random_holdout(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return df.select("p_partkey", random_split(df, "p_partkey", 0.25, 7).is_test.cast("int").alias("is_test"))


@query("kfold_assign", """
SELECT o_orderkey, CAST(('0x' || substr(md5('42:' || o_orderkey), 1, 8))::BIGINT % 5 AS INT) AS fold FROM orders""")
def kfold_assign(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", fold_of("o_orderkey", 5).alias("fold"))


# --- closed forms on one or two standardised features ------------------------------------

LINE_SPLIT_SQL = LINES_SQL + ", " + binned_sql("lines", "charge", "row_key")


@lru_cache(maxsize=8)
def _prepared(app: str, sf_dir: str, columns: tuple[str, ...]):
    df = lines(SparkSession.getActiveSession(), sf_dir).select("row_key", *columns, "charge")
    plan = FeaturePlan(key=["row_key"], target="charge")
    rows = stratified_split(df, "row_key", "charge").mark(df)
    return prepare(rows, plan, k=5, parallelism=4)


def prepared(spark, sf_dir, *columns):
    """Encoded folds of the whole line item table, shared by the queries below."""
    return _prepared(spark.sparkContext.applicationId, sf_dir, columns)


# moments of the training part of every fold, fold 5 being the holdout
FOLD_SQL = LINE_SPLIT_SQL + """,
xy AS (SELECT row_key, l_extendedprice AS x, l_quantity AS z, charge AS y, CASE WHEN is_test THEN 5 ELSE fold END AS fold
  FROM split),
m AS (SELECT f.f AS fold, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, regr_slope(y, x) AS slope,
    stddev_pop(x) AS sx, covar_pop(x, y) AS cxy FROM xy, range(6) f(f)
  WHERE xy.fold <> f.f AND xy.fold <> 5 GROUP BY 1)"""


def _shrunk(factor: str) -> str:
    """Prediction of a penalised line whose standardised slope is multiplied by ``factor``."""
    return f"m.my + {factor} * m.slope * (xy.x - m.mx)"


def _fold_metrics(factor: str) -> str:
    return f"""per AS (SELECT m.fold, count(*) AS n, sqrt(avg((y - ({_shrunk(factor)})) ** 2)) AS rmse,
  1 - avg((y - ({_shrunk(factor)})) ** 2) / var_pop(y) AS r2, corr(y, {_shrunk(factor)}) ** 2 AS pearson_r2
  FROM xy JOIN m ON xy.fold = m.fold GROUP BY 1)"""


@query("cross_validate", f"""WITH {FOLD_SQL}, {_fold_metrics("1")}
SELECT CAST(fold AS INT) AS fold, n, round(rmse, 4) AS rmse, round(r2, 7) AS r2, round(pearson_r2, 7) AS pearson_r2
FROM per WHERE fold < 5""")
def cross_validate_query(spark, sf_dir):
    """Per-fold metrics of least squares; features are fitted per fold."""
    data = prepared(spark, sf_dir, "l_extendedprice")
    rows = cross_validate(Spec("ridge", {"alpha": 0.0}), data)
    made = spark.createDataFrame(rows, "fold int, n bigint, rmse double, r2 double, pearson_r2 double")
    return made.select("fold", "n", F.round("rmse", 4).alias("rmse"), F.round("r2", 7).alias("r2"),
                       F.round("pearson_r2", 7).alias("pearson_r2"))


@query("regression_metrics", f"""WITH {LINES_SQL}
SELECT l_returnflag, count(*) AS n, round(sqrt(avg((charge - l_extendedprice) ** 2)), 5) AS rmse,
  round(1 - sum((charge - l_extendedprice) ** 2) / (var_pop(charge) * count(*)), 9) AS r2,
  round(corr(charge, l_extendedprice) ** 2, 9) AS pearson_r2 FROM lines GROUP BY 1""")
def regression_metrics_query(spark, sf_dir):
    """The list price as a prediction of the charge, per return flag."""
    made = regression_metrics(lines(spark, sf_dir), "charge", "l_extendedprice", by=["l_returnflag"])
    return made.select("l_returnflag", "n", F.round("rmse", 5).alias("rmse"), F.round("r2", 9).alias("r2"),
                       F.round("pearson_r2", 9).alias("pearson_r2"))


def _linear_query(name: str, family: str, settings: dict, weight: str):
    sql = f"""WITH {FOLD_SQL}
SELECT 'x' AS term, round({weight}, 4) AS value FROM m WHERE fold = 5
UNION ALL SELECT 'intercept', round(my, 4) FROM m WHERE fold = 5"""

    @query(name, sql)
    def fitted(spark, sf_dir):
        """Weight of the standardised price and the intercept."""
        data = prepared(spark, sf_dir, "l_extendedprice")
        model, _ = fit_and_score(Spec(family, settings), data.full, data.label)
        return spark.createDataFrame(
            [("x", float(model.coefficients[0])), ("intercept", model.intercept)], "term string, value double"
        ).select("term", F.round("value", 4).alias("value"))
    return fitted


_linear_query("lasso", "lasso", {"alpha": 1000.0}, "sign(cxy) * greatest(abs(cxy / sx) - 1000.0, 0)")
_linear_query("lasso_default", "lasso", {}, "sign(cxy) * greatest(abs(cxy / sx) - 0.001, 0)")
_linear_query("elastic_net", "elasticnet", {}, "sign(cxy) * greatest(abs(cxy / sx) - 0.1 * 0.5, 0) / (1 + 0.1 * 0.5)")


@query("ridge", f"""WITH {LINE_SPLIT_SQL},
xy AS (SELECT l_extendedprice AS x, l_quantity + l_extendedprice / 4000 AS z, charge AS y FROM split WHERE NOT is_test),
s AS (SELECT count(*)::DOUBLE AS n, corr(x, z) AS c, covar_pop(x, y) / stddev_pop(x) AS bx,
  covar_pop(z, y) / stddev_pop(z) AS bz, avg(y) AS my FROM xy)
SELECT 'x' AS term, round(((n + 10) * n * bx - n * c * n * bz) / ((n + 10) ** 2 - (n * c) ** 2), 4) AS value FROM s
UNION ALL SELECT 'z', round(((n + 10) * n * bz - n * c * n * bx) / ((n + 10) ** 2 - (n * c) ** 2), 4) FROM s
UNION ALL SELECT 'intercept', round(my, 4) FROM s""")
def ridge_query(spark, sf_dir):
    """Two correlated features, alpha 10."""
    df = lines(spark, sf_dir).select(
        "row_key", "charge", F.col("l_extendedprice").alias("x"),
        (F.col("l_quantity") + F.col("l_extendedprice") / 4000).alias("z"))
    train, test = stratified_split(df, "row_key", "charge").apply(df)
    fitted = fit_features(train, FeaturePlan(key=["row_key"], target="charge"))
    encoded = fitted.transform(train)
    model = Spec("ridge", {}).build(LabelStats.of(encoded, "charge", 2), "charge").fit(encoded)
    values = [("x", float(model.coefficients[0])), ("z", float(model.coefficients[1])), ("intercept", model.intercept)]
    return spark.createDataFrame(values, "term string, value double").select("term", F.round("value", 4).alias("value"))


TRAIN_ONE_SQL = f"""WITH {FOLD_SQL}, {_fold_metrics("n / (n + 5000)").replace("AS (SELECT m.fold, count(*) AS n,", "AS (SELECT m.fold, count(*) AS rows,", 1)}
SELECT 'ridge' AS model, round(avg(rmse) FILTER (fold < 5), 4) AS cv_rmse_mean,
  round(stddev_pop(rmse) FILTER (fold < 5), 4) AS cv_rmse_std, round(avg(r2) FILTER (fold < 5), 7) AS cv_r2_mean,
  round(stddev_pop(r2) FILTER (fold < 5), 7) AS cv_r2_std, round(max(rmse) FILTER (fold = 5), 4) AS test_rmse,
  round(max(r2) FILTER (fold = 5), 7) AS test_r2 FROM per"""


def rounded_results(df):
    return df.select("model", *[
        F.round(m, 7 if "r2" in m else 4).alias(m) for m in df.columns if m != "model"])


def _trained(spark, sf_dir):
    return train_one("ridge", Spec("ridge", {"alpha": 5000.0}), prepared(spark, sf_dir, "l_extendedprice"))


@query("train_one", TRAIN_ONE_SQL)
def train_one_query(spark, sf_dir):
    return rounded_results(results_table(spark, {"ridge": _trained(spark, sf_dir).metrics}))


@query("results_table", TRAIN_ONE_SQL)
def results_table_query(spark, sf_dir):
    """The results row, written as CSV and read back."""
    path = new_path(spark, "results") + ".csv"
    results = results_table(spark, {"ridge": _trained(spark, sf_dir).metrics})
    write_results(results, path)
    return rounded_results(spark.read.schema(results.schema).csv(path, header=True))


SCORES_SQL = f"""WITH {FOLD_SQL}
SELECT row_key, round({_shrunk("n / (n + 10)")}, 2) AS prediction FROM xy JOIN m ON xy.fold = m.fold WHERE m.fold = 5"""


def _ridge_model(spark, sf_dir):
    data = prepared(spark, sf_dir, "l_extendedprice")
    model, _ = fit_and_score(Spec("ridge", {}), data.full, data.label)
    return PipelineModel(stages=[data.full.features.model, model])


def _holdout(spark, sf_dir):
    df = lines(spark, sf_dir).select("row_key", "l_extendedprice", "charge")
    return stratified_split(df, "row_key", "charge").apply(df)[1].drop("charge")


@query("model_roundtrip", SCORES_SQL)
def model_roundtrip(spark, sf_dir):
    """Holdout scores of a model that was saved and loaded."""
    path = save_model({"ridge": _ridge_model(spark, sf_dir)}, "ridge", new_path(spark, "models"))
    _, model = load_model(path)
    return score(model, _holdout(spark, sf_dir), "row_key").withColumn("prediction", F.round("prediction", 2))


@query("score_output", SCORES_SQL)
def score_output(spark, sf_dir):
    """Holdout scores written as CSV, read back."""
    path = new_path(spark, "scores") + ".csv"
    write_scores(score(_ridge_model(spark, sf_dir), _holdout(spark, sf_dir), "row_key"), path)
    made = spark.read.schema("row_key string, prediction double").csv(path, header=True)
    return made.withColumn("prediction", F.round("prediction", 2))


# --- the feature plan --------------------------------------------------------------------

@query("encode_columns", f"""WITH {PART_GAPS_SQL},
o AS (SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_brand) >= 20 THEN coalesce(p_brand, 'nan') ELSE 'Other' END AS b,
  CASE WHEN count(*) OVER (PARTITION BY p_type) >= 20 THEN p_type ELSE 'Other' END AS t,
  CASE WHEN p_size > 10 THEN 'wide' ELSE 'small' END AS w, p_size FROM parts),
s AS (SELECT median(p_size) AS md, avg(p_size) AS m, stddev_pop(p_size) AS s FROM o)
SELECT p_partkey, 'p_brand_' || b AS feature, 1.0::DOUBLE AS value FROM o
UNION ALL SELECT p_partkey, 'p_type_' || t, 1.0 FROM o
UNION ALL SELECT p_partkey, 'width', CASE w WHEN 'small' THEN 1.0 ELSE 2.0 END FROM o
UNION ALL SELECT p_partkey, 'p_size', round((p_size - m) / s, 5) FROM o, s""")
def encode_columns(spark, sf_dir):
    """Categories, then ordinals, then numbers, in long form."""
    df = part_gaps(spark, sf_dir).select(
        "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
        F.when(F.col("p_size") > 10, "wide").otherwise("small").alias("width"))
    plan = FeaturePlan(key=["p_partkey"], target="p_retailprice", ordinals={"width": ["small", "wide"]})
    fitted = fit_features(df, plan)
    made = explode_vector(fitted.transform(df), ["p_partkey"], fitted.names)
    return made.withColumn("value", F.round("value", 5))


@query("feature_names", f"""WITH {PART_GAPS_SQL},
n AS (SELECT CASE WHEN count(*) OVER (PARTITION BY p_name) >= 30 THEN p_name ELSE 'Other' END AS a,
  CASE WHEN count(*) OVER (PARTITION BY p_brand) >= 30 THEN coalesce(p_brand, 'nan') ELSE 'Other' END AS b,
  CASE WHEN count(*) OVER (PARTITION BY p_type) >= 30 THEN p_type ELSE 'Other' END AS c FROM parts),
u AS (SELECT 0 AS part, 'p_name_' || a AS feature FROM n UNION ALL SELECT 1, 'p_brand_' || b FROM n
  UNION ALL SELECT 2, 'p_type_' || c FROM n),
k AS (SELECT part, feature FROM u GROUP BY 1, 2 HAVING count(*) < (SELECT count(*) FROM parts) UNION ALL SELECT 3, 'p_size')
SELECT CAST(row_number() OVER (ORDER BY part, feature) - 1 AS INT) AS idx, feature FROM k""")
def feature_names(spark, sf_dir):
    """Slot names in vector order."""
    plan = FeaturePlan(key=["p_partkey"], target="p_retailprice", min_freq=30)
    return fit_features(part_gaps(spark, sf_dir), plan).names_table(spark)


GAPS_PLAN_SQL = LINE_GAPS_SQL + ", " + binned_sql("gaps", "charge", "row_key") + """,
train AS (SELECT * FROM split WHERE NOT is_test),
q AS (SELECT quantile_cont(quantity, 0.25) AS q1, median(quantity) AS q2, quantile_cont(quantity, 0.75) AS q3,
  quantile_cont(spend, 0.25) AS s1, quantile_cont(spend, 0.75) AS s3, quantile_cont(spend, 0.99) AS cap,
  quantile_cont(least(spend, c), 0.25) AS c1, quantile_cont(least(spend, c), 0.75) AS c3
  FROM train, (SELECT quantile_cont(spend, 0.99) AS c FROM train)),
c AS (SELECT row_key, flag, is_test,
  CASE WHEN quantity IS NULL THEN q2
    ELSE greatest(least(quantity, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) END AS quantity,
  greatest(least(spend, s3 + 1.5 * (s3 - s1)), s1 - 1.5 * (s3 - s1)) AS spend,
  greatest(least(least(spend, cap), c3 + 1.5 * (c3 - c1)), c1 - 1.5 * (c3 - c1)) AS spend_cap FROM split, q),
s AS (SELECT avg(quantity) AS qm, stddev_pop(quantity) AS qs, avg(spend) AS sm, stddev_pop(spend) AS ss,
  avg(spend_cap) AS cm, stddev_pop(spend_cap) AS cs FROM c WHERE NOT is_test)"""


def _long_block(side: str) -> str:
    return f"""WITH {GAPS_PLAN_SQL}
SELECT row_key, 'flag_' || flag AS feature, 1.0::DOUBLE AS value FROM c WHERE {side}
UNION ALL SELECT row_key, 'quantity', round((quantity - qm) / qs, 5) FROM c, s WHERE {side}
UNION ALL SELECT row_key, 'spend', round((spend - sm) / ss, 5) FROM c, s WHERE {side}
UNION ALL SELECT row_key, 'spend_cap', round((spend_cap - cm) / cs, 5) FROM c, s WHERE {side}"""


def _gaps_plan(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select("row_key", "quantity", "spend", "flag", "charge")
    plan = FeaturePlan(key=["row_key"], target="charge", recipes=[d.winsorize("spend_cap", "spend", 0.99)])
    marked = settle(stratified_split(df, "row_key", "charge").mark(df), "marked")
    train, test = (marked.where(F.col(HELD) == side).drop(HELD) for side in (False, True))
    return fit_features(train, plan), train, test


def _long(fitted, df):
    return explode_vector(fitted.transform(df), ["row_key"], fitted.names).withColumn("value", F.round("value", 5))


@query("feature_plan_fit", _long_block("NOT is_test"))
def feature_plan_fit(spark, sf_dir):
    """Fit on the training side and transform it; the vector in long form."""
    fitted, train, _ = _gaps_plan(spark, sf_dir)
    return _long(fitted, train)


@query("transform_new", _long_block("is_test"))
def transform_new(spark, sf_dir):
    """Fit on the training side, transform the holdout."""
    fitted, _, test = _gaps_plan(spark, sf_dir)
    return _long(fitted, test)


@query("run_report", f"""WITH {GAPS_PLAN_SQL}
SELECT 'ClipOutliersModel' AS stage, 'quantity' AS column_name, 'low' AS stat, round(q1 - 1.5 * (q3 - q1), 4) AS value FROM q
UNION ALL SELECT 'ClipOutliersModel', 'quantity', 'high', round(q3 + 1.5 * (q3 - q1), 4) FROM q
UNION ALL SELECT 'FillModel', 'quantity', 'median', round(q2, 4) FROM q
UNION ALL SELECT 'StandardizeModel', 'quantity', 'mean', round(qm, 4) FROM s
UNION ALL SELECT 'StandardizeModel', 'quantity', 'deviation', round(qs, 4) FROM s
UNION ALL SELECT 'MissingFlagsModel', 'quantity', 'was_missing', 1.0 FROM q""")
def run_report_query(spark, sf_dir):
    """What the fitted stages learned about the quantity."""
    report = run_report(_gaps_plan(spark, sf_dir)[0].model, spark).where(F.col("column") == "quantity")
    return report.select("stage", F.col("column").alias("column_name"), "stat",
                         F.round(F.col("value").cast("double"), 4).alias("value"))


def sales_plan(k_best: int | None = None) -> FeaturePlan:
    return FeaturePlan(
        key=["row_key"], target="charge", ordinals={"o_orderpriority": PRIORITIES},
        recipes=[d.product("price_kept", "l_extendedprice", "kept"), d.log1p("ln_price", "l_extendedprice"),
                 d.ratio("price_per_unit", "l_extendedprice", "l_quantity")],
        exclude=["l_linenumber"], min_freq=20, k_best=k_best)


def sales_frame(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("kept", 1 - F.col("l_discount"))


def flagship(spark, sf_dir):
    """Join, split, feature plan, ridge, holdout metrics."""
    df = settle(sales_frame(spark, sf_dir), "sales")
    marked = settle(stratified_split(df, "row_key", "charge").mark(df), "marked")
    train, test = (marked.where(F.col(HELD) == side).drop(HELD) for side in (False, True))
    fitted = fit_features(train, sales_plan())
    encoded = settle(fitted.transform(train).select("row_key", "charge", "features"), "train")
    stats = LabelStats.of(encoded, "charge", fitted.width)
    model = Spec("ridge", {}).build(stats, "charge").fit(encoded)
    scored = model.transform(fitted.transform(test))
    return regression_metrics(scored, "charge").select(F.lit("ridge").alias("model"), "n", "rmse", "r2", "pearson_r2")


query("sales_ridge")(flagship)


@query("sales_join", f"""WITH {SALES_SQL} SELECT * FROM sales""")
def sales_join(spark, sf_dir):
    """The joined table that the models train on."""
    return sales(spark, sf_dir)



# --- boosted trees on columns of few distinct values -------------------------------------

_SLOTS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _boost_rows(spark, sf_dir):
    return VectorAssembler(inputCols=_SLOTS, outputCol="features").transform(
        lines(spark, sf_dir).select("row_key", F.col("l_extendedprice").alias("y"), *[F.col(c).cast("double").alias(c) for c in _SLOTS]))


def _cells_sql(rows: str, by: str = "") -> str:
    """Sums of gradients and rows by slot and value, and node."""
    return " UNION ALL ".join(f"SELECT {by}{i} AS slot, {c} AS v, sum(g) AS g, count(*) AS n FROM {rows} GROUP BY ALL" for i, c in enumerate(_SLOTS))


def _score_sql(g: str, n: str, l1: float, l2: float) -> str:
    return f"CASE WHEN {n} > 0 THEN pow(greatest(abs({g}) - {l1!r}, 0), 2) / ({n} + {l2!r}) ELSE 0 END"


def _weight_sql(g: str, n: str, l1: float, l2: float, rate: float) -> str:
    return f"(CASE WHEN {n} > 0 THEN -sign({g}) * greatest(abs({g}) - {l1!r}, 0) / ({n} + {l2!r}) * {rate!r} ELSE 0 END)"


_AT = "CASE slot " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_SLOTS)) + " END <= v"
_START_SQL = LINES_SQL + """, r0 AS (SELECT row_key, l_quantity::DOUBLE AS l_quantity, l_discount, l_tax, l_linenumber::DOUBLE AS l_linenumber,
  l_extendedprice AS y, avg(l_extendedprice) OVER () AS m FROM lines)"""
PENALTIES = {"l1": 50_000.0, "l2": 1_000.0, "rate": 0.5}


def _stump_sql(turn: int, l1: float, l2: float, rate: float) -> str:
    """CTEs of one stump: rows ``r{turn}`` get margins in ``r{turn + 1}``."""
    return f"""g{turn} AS (SELECT *, m - y AS g FROM r{turn}), c{turn} AS ({_cells_sql(f"g{turn}")}),
w{turn} AS (SELECT slot, v, sum(g) OVER (PARTITION BY slot ORDER BY v) AS gl, sum(n) OVER (PARTITION BY slot ORDER BY v) AS nl,
  sum(g) OVER (PARTITION BY slot) AS g, sum(n) OVER (PARTITION BY slot) AS n FROM c{turn}),
b{turn} AS (SELECT slot, v, {_weight_sql("gl", "nl", l1, l2, rate)} AS lower, {_weight_sql("(g - gl)", "(n - nl)", l1, l2, rate)} AS upper
  FROM w{turn} WHERE nl < n ORDER BY {_score_sql("gl", "nl", l1, l2)} + {_score_sql("(g - gl)", "(n - nl)", l1, l2)} - {_score_sql("g", "n", l1, l2)} DESC, slot, v LIMIT 1),
r{turn + 1} AS (SELECT r.* REPLACE (m + CASE WHEN {_AT} THEN lower ELSE upper END AS m) FROM r{turn} r, b{turn})"""


@query("boost_penalised", f"""WITH {_START_SQL}, {_stump_sql(0, **PENALTIES)}, {_stump_sql(1, **PENALTIES)}, {_stump_sql(2, **PENALTIES)}
SELECT row_key, round(m, 3) AS prediction FROM r3""")
def boost_penalised(spark, sf_dir):
    """Three rounds of stumps under both penalties."""
    df = _boost_rows(spark, sf_dir)
    model = HistogramBoost({"label": "y", "rounds": 3, "depth": 1, "bins": 200, "features": "features", "key": ["row_key"], **PENALTIES}).fit(df)
    return model.transform(df).select("row_key", F.round("prediction", 3).alias("prediction"))


def _halves(l2: float) -> str:
    """CTEs of a symmetric tree of depth 2."""
    return f"""g0 AS (SELECT *, m - y AS g FROM r0), c0 AS ({_cells_sql("g0")}),
w0 AS (SELECT slot, v, sum(g) OVER (PARTITION BY slot ORDER BY v) AS gl, sum(n) OVER (PARTITION BY slot ORDER BY v) AS nl,
  sum(g) OVER (PARTITION BY slot) AS g, sum(n) OVER (PARTITION BY slot) AS n FROM c0),
b0 AS (SELECT slot, v FROM w0 WHERE nl < n ORDER BY {_score_sql("gl", "nl", 0.0, l2)} + {_score_sql("(g - gl)", "(n - nl)", 0.0, l2)} DESC, slot, v LIMIT 1),
h0 AS (SELECT g0.*, CASE WHEN {_AT} THEN 0 ELSE 1 END AS node FROM g0, b0), c1 AS ({_cells_sql("h0", "node, ")}),
sums AS (SELECT node, sum(g) AS g, count(*) AS n FROM h0 GROUP BY node), tried AS (SELECT DISTINCT slot, v FROM c1),
w1 AS (SELECT t.slot, t.v, s.node, s.g, s.n, coalesce(sum(c.g), 0) AS gl, coalesce(sum(c.n), 0) AS nl FROM tried t CROSS JOIN sums s
  LEFT JOIN c1 c ON c.slot = t.slot AND c.node = s.node AND c.v <= t.v GROUP BY ALL),
b1 AS (SELECT slot, v FROM w1 GROUP BY slot, v HAVING bool_or(nl > 0 AND nl < n)
  ORDER BY sum({_score_sql("gl", "nl", 0.0, l2)} + {_score_sql("(g - gl)", "(n - nl)", 0.0, l2)} - {_score_sql("g", "n", 0.0, l2)}) DESC, slot, v LIMIT 1),
l1 AS (SELECT h0.*, 2 * node + CASE WHEN {_AT} THEN 0 ELSE 1 END AS leaf FROM h0, b1)"""


@query("boost_symmetric_cuts", f"""WITH {_START_SQL}, {_halves(3.0)},
e AS (SELECT leaf, -sum(g) / (count(*) + 3.0) AS x FROM l1 GROUP BY leaf)
SELECT row_key, round(m + x, 3) AS prediction FROM l1 JOIN e USING (leaf)""")
def boost_symmetric_cuts(spark, sf_dir):
    """One symmetric tree of two levels: the second cut is the best one for both nodes together."""
    df = _boost_rows(spark, sf_dir)
    model = HistogramBoost({"label": "y", "rounds": 1, "depth": 2, "rate": 1.0, "l2": 3.0, "symmetric": True, "bins": 200,
                            "features": "features", "key": ["row_key"]}).fit(df)
    return model.transform(df).select("row_key", F.round("prediction", 3).alias("prediction"))
