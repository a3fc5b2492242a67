"""Result tables, fitted models and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Metric columns of a results table, in order.
METRICS = ("cv_rmse_mean", "cv_rmse_std", "cv_r2_mean", "cv_r2_std", "test_rmse", "test_r2")
RESULTS_SCHEMA = "model string, " + ", ".join(f"{m} double" for m in METRICS)


def results_table(spark: SparkSession, results: dict[str, dict[str, float | None]]) -> DataFrame:
    """One row per model; holds as many rows as there are models."""
    rows = [(name, *[None if m.get(k) is None else float(m[k]) for k in METRICS]) for name, m in results.items()]
    return spark.createDataFrame(rows, RESULTS_SCHEMA)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_results(results: DataFrame, path: str) -> None:
    """A single CSV file: a results or trials table has one row per model or trial."""
    write_csv(results.coalesce(1), path)


def trial_summary(trials: DataFrame, by: str = "stack_combo", value: str = "value") -> DataFrame:
    return trials.groupBy(by).agg(
        F.count(value).alias("n_trials"), F.min(value).alias("best_rmse"), F.avg(value).alias("avg_rmse"))


def save_model(models: dict[str, PipelineModel], name: str, folder: str) -> str:
    if name not in models:
        raise ValueError(f"no fitted model named {name!r}")
    path = f"{folder.rstrip('/')}/{name}"
    models[name].write().overwrite().save(path)
    return path


def load_model(path: str, name: str | None = None) -> tuple[str, PipelineModel]:
    """The model and the name to register it under: the last part of the path by default."""
    return name or path.rstrip("/").rsplit("/", 1)[-1], PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, key: list[str] | str,
          prediction: str = "prediction", name: str = "prediction") -> DataFrame:
    """Key columns first, then the prediction. Works on streaming tables too."""
    keys = [key] if isinstance(key, str) else list(key)
    return model.transform(df).select(*keys, F.col(prediction).alias(name))


def write_scores(scores: DataFrame, path: str) -> None:
    """Scores grow with the data: one file per partition, no coalesce."""
    write_csv(scores, path)


def run_report(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """What each fitted stage learned: ``(step, stage, column, stat, value)`` in step order."""
    rows, stored = [], []
    for step, stage in enumerate(model.stages):
        name = type(stage).__name__
        learned = stage.report() if hasattr(stage, "report") else []
        levels = stage.stored_report(spark) if hasattr(stage, "stored_report") else None
        if levels is not None:
            stored.append(levels.select(F.lit(step).alias("step"), F.lit(name).alias("stage"), "column", "stat", "value"))
        for column, stat, value in learned or ([(None, "fitted", None)] if levels is None else []):
            rows.append((step, name, column, stat, None if value is None else str(value)))
    small = spark.createDataFrame(rows, "step int, stage string, column string, stat string, value string")
    return reduce(DataFrame.unionByName, stored, small)


def write_report(report: DataFrame, path: str) -> None:
    lines = report.orderBy("step", "column", "stat").select(F.concat_ws(
        " ", F.col("step").cast("string"), "stage", "column", "stat", "value").alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)
