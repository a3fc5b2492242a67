"""Column helpers that fix how missing values behave. NULL is the only missing value inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.DoubleType, T.FloatType)


def col(name: str) -> Column:
    """Column by its literal name, dots and leading digits included."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.nanvl(col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, FLOATS) else col(f.name)
        for f in df.schema.fields
    ])


def finite(c: Column) -> Column:
    """NULL in place of NaN and both infinities."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def floor_at(c: Column, low) -> Column:
    """``max(c, low)`` that keeps NULL."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def cap_at(c: Column, high) -> Column:
    """``min(c, high)`` that keeps NULL."""
    return F.when(c.isNotNull(), F.least(c, F.lit(high)))


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def replace_columns(df: DataFrame, new: dict[str, Column], extra: dict[str, Column] | None = None) -> DataFrame:
    """One projection: swap the expressions in ``new`` in place, append those in ``extra``."""
    extra = extra or {}
    kept = [new[c].alias(c) if c in new else col(c) for c in df.columns if c not in extra]
    return df.select(*kept, *[e.alias(c) for c, e in extra.items()])
