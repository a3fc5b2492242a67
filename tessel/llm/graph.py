"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessel.llm.scratch import Scratch


#: Edges in one file of an intermediate table.
ROWS_PER_FILE = 200_000


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    met = near.join(low, "u")
    if small:
        pairs = met.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            low.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        pairs = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return pairs.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges from larger to smaller ids are stars: no id has two centres or is both a leaf and a centre."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionAll(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("u").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return seen.filter("leaf > 1 or leaf = 1 and centre = 1").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)`` for every end of ``edges (a, b)``; the component is its smallest id.

    Each round is two groupings with partial minima and two joins, so a hub with any number of
    neighbours never meets in one group. Empty input gives an empty table; loops are ignored.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = scratch.put(pairs)
    parts = 1 + now.count() // ROWS_PER_FILE
    while not _settled(now):
        large = scratch.put(_stars(now, small=False).coalesce(parts))
        after = scratch.put(_stars(large, small=True).coalesce(parts))
        scratch.drop(now, large)
        now = after
    labels = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return scratch.put(labels.unionAll(roots.join(labels.select("id"), "id", "left_anti")).coalesce(2 * parts))
