"""Tables written between passes, and a semi-join that looks at the size of its key list."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.session import new_path

#: Key lists up to this many rows (some 16 MB) are sent to all executors; longer ones are shuffled.
SMALL_KEYS = 500_000


def reach(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package where it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


class Scratch:
    """Parquet tables in the shared folder, dropped one by one when no later step reads them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def put(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, self.label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for df in tables:
            if df is not None and id(df) in self.paths:
                _, path = self.paths.pop(id(df))
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def only(self, *tables: DataFrame) -> None:
        """Drop all tables written so far but these."""
        self.drop(*[df for df, _ in list(self.paths.values()) if not any(df is t for t in tables)])


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` values are in ``keys`` (distinct, already written).

    A short list is broadcast after a count; a long one is joined by a shuffle.
    """
    few = keys.limit(SMALL_KEYS + 1).count() <= SMALL_KEYS
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")
