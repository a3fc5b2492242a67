"""Value counts of many columns in one shuffle, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.nulls import col


def value_counts(df: DataFrame, columns: list[str], cast: str = "string") -> DataFrame:
    """``(column, value, n)``; missing counts as a value. Counts are combined before the shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast(cast).alias("value")) for c in columns
    ])
    return (df.select(F.explode(pairs).alias("x")).select("x.*")
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def modes(counts: DataFrame) -> DataFrame:
    """``(column, mode)``: the most frequent present value, the smallest one on ties."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return (counts.where(F.col("value").isNotNull()).groupBy("column")
            .agg(best.getField("value").alias("mode")))
