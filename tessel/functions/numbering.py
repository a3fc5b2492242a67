"""Dense numbers for the rows of a sorted table, without a global window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.nulls import col
from tessel.session import settle

#: Bits of ``monotonically_increasing_id`` that count rows within a partition.
ROW_BITS = 33


def dense_numbers(df: DataFrame, group: str, order: str, out: str = "slot") -> DataFrame:
    """``df`` with ``out``: 0, 1, 2 ... within each ``group`` in the order of ``order``.

    Rows are range-partitioned and sorted once; a row's number is its place in its partition plus the rows of
    the group in partitions before. Only one row per partition and group reaches the driver.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = settle(df.repartitionByRange(col(group), col(order)).sortWithinPartitions(group, order)
                         .withColumn("__id", place), "numbered")
    part = F.shiftright("__id", ROW_BITS)
    sizes = sorted_rows.groupBy(part.alias("part"), col(group).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("__id").bitwiseAND((1 << ROW_BITS) - 1)).alias("first")).collect()
    before: dict = {}
    for g in {r["g"] for r in sizes}:
        mine = sorted((r for r in sizes if r["g"] == g), key=lambda r: r["part"])
        for r, n in zip(mine, accumulate([0, *(r["n"] for r in mine)])):
            before[r["part"], g] = n - r["first"]
    kind = df.schema[group].dataType.simpleString()
    offsets = df.sparkSession.createDataFrame([(p, g, n) for (p, g), n in before.items()], f"__part long, __g {kind}, __before long")
    # as many rows as partitions and groups
    joined = sorted_rows.join(F.broadcast(offsets), (part == F.col("__part")) & col(group).eqNullSafe(F.col("__g")))
    number = F.col("__id").bitwiseAND((1 << ROW_BITS) - 1) + F.col("__before")
    return joined.select(*[col(c) for c in df.columns], number.alias(out))
