"""Regression metrics in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(label: Column, prediction: Column) -> list[Column]:
    """Aggregates ``n, rmse, r2, pearson_r2``, usable with or without ``groupBy``."""
    squared = (label - prediction) * (label - prediction)
    return [
        F.count(label).alias("n"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.avg(squared), F.var_pop(label))).alias("r2"),
        F.pow(F.corr(label, prediction), F.lit(2.0)).alias("pearson_r2"),
    ]


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: list[str] = ()) -> DataFrame:
    columns = metric_columns(F.col(label), F.col(prediction))
    return df.groupBy(*by).agg(*columns) if by else df.agg(*columns)


def fold_summary(fold_metrics: DataFrame, by: list[str] = ()) -> DataFrame:
    """Mean and population deviation over folds, one row per group."""
    return fold_metrics.groupBy(*by).agg(
        F.avg("rmse").alias("cv_rmse_mean"), F.stddev_pop("rmse").alias("cv_rmse_std"),
        F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
