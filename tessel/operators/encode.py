"""From typed columns to one sparse feature vector with named slots."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.nulls import col


TOKENS, HOT = "__tokens", "__hot"


class ColumnDrop(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drops helper columns at the end of a plan."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.identity)

    def __init__(self, columns: list[str] | None = None):
        super().__init__()
        self._set(columns=columns or [])

    def _transform(self, df):
        return df.drop(*self.getOrDefault("columns"))


class Tokens(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """One array of ``<column number>=<level>`` per row; a missing level gives an unknown word."""

    columns = Param(Params._dummy(), "columns", "category columns", TypeConverters.identity)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    def __init__(self, columns: list[str] | None = None, outputCol: str = TOKENS):
        super().__init__()
        self._set(columns=columns or [], outputCol=outputCol)

    def _transform(self, df):
        words = [F.coalesce(F.concat(F.lit(f"{i}="), col(c)), F.lit(""))
                 for i, c in enumerate(self.getOrDefault("columns"))]
        return df.select("*", F.array(*words).alias(self.getOrDefault("outputCol")))


def one_hot(levels: dict[str, list[str]]) -> list:
    """Fitted stages that one-hot the given levels in sorted order, all columns in one vector.

    Unknown and missing texts set no slot. Nothing is fitted: the level lists are the vocabulary
    of a binary count vector, which stays sparse and looks all columns up in one call.
    """
    names = [c for c, known in levels.items() if known]
    if not names:
        return []
    words = [f"{i}={v}" for i, c in enumerate(names) for v in sorted(levels[c])]
    return [Tokens(names), CountVectorizerModel.from_vocabulary(words, TOKENS, HOT, minTF=1.0, binary=True)]


def assemble(hot: bool, ords: list[str], nums: list[str], out: str = "features", wide: tuple = (), drop: tuple = ()) -> list:
    """Stages that build the vector: categories, then those of ``wide`` vectors, then ordinals, then numbers."""
    helpers = [*([TOKENS, HOT] if hot else []), *wide, *drop]
    return [
        VectorAssembler(inputCols=([HOT] if hot else []) + list(wide) + ords + nums, outputCol=out, handleInvalid="error"),
        *([ColumnDrop(helpers)] if helpers else []),
    ]


def slot_names(levels: dict[str, list[str]], ords: list[str], nums: list[str]) -> list[str]:
    return [f"{c}_{v}" for c, known in levels.items() for v in sorted(known)] + list(ords) + list(nums)


def keep_slots(indices: list[int], source: str, out: str = "features") -> list:
    return [VectorSlicer(inputCol=source, outputCol=out, indices=indices), ColumnDrop([source])]


def explode_vector(df: DataFrame, key: list[str], names: list[str] | DataFrame, vector: str = "features") -> DataFrame:
    """``(key, feature, value)`` in long form, non-zero slots only. ``names`` may be a table ``(idx, feature)``."""
    # type 0 is sparse; of a dense vector every slot is looked at
    made = df.withColumn("__v", F.unwrap_udt(col(vector))).select(*key, F.explode(F.arrays_zip(
        F.when(F.col("__v.type") == 0, F.col("__v.indices")).otherwise(
            F.sequence(F.lit(0), F.greatest(F.size("__v.values"), F.lit(1)) - 1)).alias("at"),
        F.col("__v.values").alias("value"))).alias("p"))
    if isinstance(names, DataFrame):
        made = made.select(*key, F.col("p.at").alias("__at"), "p.value").where(F.col("value") != 0)
        return made.join(names.select(F.col("idx").alias("__at"), "feature"), "__at").select(*key, "feature", "value")
    labels = F.array(*[F.lit(n) for n in names])
    return made.select(*key, F.get(labels, F.col("p.at")).alias("feature"), "p.value").where(F.col("value") != 0)
