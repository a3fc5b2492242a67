"""The folder that every executor can see, and tables written there."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc.master.startswith("local"):
        named = tempfile.mkdtemp(prefix="tessel-")
        spark.conf.set("spark.checkpoint.dir", named)
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """:func:`settle`, with the path for a later :func:`discard`."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage, survives the loss of executors, and lets each later pass read only the
    columns it needs.
    """
    return settled(df, label)[0]


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def wide(df: DataFrame) -> bool:
    """Whether a table just read back has enough parts for all cores, so that its rows need not be dealt again."""
    return df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over tasks, however few files or row groups they came from."""
    return df.hint("rebalance")


def reach(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package where it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, have]))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table in the shared folder that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
