"""Binned mutual information between features and the target, from one grouped count.

This is a histogram estimate: scores differ from a nearest-neighbour estimate, and close ranks
may swap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessel.functions.nulls import col
from tessel.functions.quantiles import quantile_report

MISSING_BIN = "missing"


def inner_edges(found: list[float | None]) -> list[float]:
    return sorted({e for e in found if e is not None})


def bin_of(c: Column, edges: list[float]) -> Column:
    """Right-closed bin number, the count of edges below the value; NULL stays NULL. Edges are halved, not tried in a row."""
    edges = sorted(edges)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(c <= F.lit(float(edges[mid])), between(low, mid)).otherwise(between(mid + 1, high))

    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(between(0, len(edges)))


def quantile_edges(df: DataFrame, columns: list[str], bins: int, exact: bool = True) -> dict[str, list[float]]:
    probs = [i / bins for i in range(1, bins)]
    found = quantile_report(df, columns, probs, exact=exact).values
    return {c: inner_edges(v) for c, v in found.items()}


def joint_counts(df: DataFrame, binned: dict[str, Column], target_bin: Column) -> DataFrame:
    """``(feature, xb, yb, n)``. Few distinct keys: counts collapse before the shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.coalesce(b.cast("string"), F.lit(MISSING_BIN)).alias("xb"))
        for name, b in binned.items()])
    return (df.select(F.explode(pairs).alias("x"), target_bin.alias("yb")).where(F.col("yb").isNotNull())
            .groupBy("x.feature", "x.xb", "yb").agg(F.count(F.lit(1)).alias("n")))


def information(counts: DataFrame) -> DataFrame:
    """``(feature, mi)`` in nats from joint counts."""
    def total(*by: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by)).cast("double")

    parts = counts.select(
        "feature", F.col("n").cast("double").alias("n"), total("feature", "xb").alias("nx"),
        total("feature", "yb").alias("ny"), total("feature").alias("all"))
    term = F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nx") * F.col("ny")))
    return parts.groupBy("feature").agg(F.sum(term).alias("mi"))


def level_information(counts: DataFrame) -> DataFrame:
    """``(feature, mi)`` of the 0/1 flag of every level, named ``<feature>_<level>``.

    Only rows with the flag set were counted. The others follow from the totals per target bin;
    target bins in which a level never occurs hold unset rows only and are summed at once.
    """
    def total(*by: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*by)).cast("double")

    def term(n: Column, nx: Column) -> Column:
        return F.when(n > 0, n / F.col("all") * F.log(n * F.col("all") / (nx * F.col("ny")))).otherwise(0.0)

    parts = counts.select(
        "feature", "xb", F.col("n").cast("double").alias("n"), total("feature", "xb").alias("nx"),
        total("feature", "yb").alias("ny"), total("feature").alias("all"))
    n, nx, ny, rows = (F.col(c) for c in ("n", "nx", "ny", "all"))
    summed = (parts.select("feature", "xb", "nx", "ny", "all", (term(n, nx) + term(ny - n, rows - nx)).alias("t"))
              .groupBy("feature", "xb", "nx", "all").agg(F.sum("t").alias("t"), F.sum("ny").alias("met")))
    absent = F.when(rows > nx, (rows - F.col("met")) / rows * F.log(rows / (rows - nx))).otherwise(0.0)
    return summed.select(F.concat_ws("_", "feature", "xb").alias("feature"), (F.col("t") + absent).alias("mi"))


def mutual_info(df: DataFrame, columns: list[str], target: str, bins: int = 16, exact: bool = True) -> DataFrame:
    """``(feature, mi)`` of numeric columns; a missing value is a bin of its own."""
    edges = quantile_edges(df, [*columns, target], bins, exact)
    binned = {c: bin_of(col(c).cast("double"), edges[c]) for c in columns}
    return information(joint_counts(df, binned, bin_of(col(target).cast("double"), edges[target])))


def top_features(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best, ties by name."""
    return scores.orderBy(F.desc("mi"), "feature").limit(k)
