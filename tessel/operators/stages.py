"""Fitted table transforms as Spark ML stages.

Fitting runs one aggregation over all columns of a stage (three passes where exact quantiles
are needed). What was learned is a small JSON-able dict; a level table that outgrows
``LEVELS_INLINE`` is a Parquet table instead, which is joined, so that Spark decides by its size
how. A saved model holds its level tables. Every ``transform`` is a projection, or a projection
over left joins, and so works on streaming tables too.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable,
    MLWriter)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.functions.counts import modes, value_counts
from tessel.functions.numbering import dense_numbers
from tessel.functions.nulls import clip, col, finite, nan_to_null, replace_columns
from tessel.functions.quantiles import quantile_report
from tessel.operators.derive import derive
from tessel.operators.roles import infer_roles
from tessel.session import new_path, settle

LEVELS_INLINE = 5_000
MAP_INLINE = 200


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """``columns`` wins; without it a stage takes all columns of its role, less ``exclude``."""

    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.identity)
    exclude = Param(Params._dummy(), "exclude", "key, target and the like", TypeConverters.identity)
    defaults: dict = {}

    def __init__(self, **settings):
        super().__init__()
        self._setDefault(columns=None, exclude=[], **self.defaults)
        self._set(**settings)

    def get(self, name: str):
        return self.getOrDefault(name)

    def pick(self, df: DataFrame, role: str) -> list[str]:
        if self.get("columns") is not None:
            return [c for c in self.get("columns") if c in df.columns]
        return getattr(infer_roles(df, exclude=self.get("exclude")), role)


class _StateWriter(MLWriter):
    """Writes the state and, inside the model's folder, the level table it names."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if "table" in self.instance.learned:
            self.sparkSession.read.parquet(self.instance.learned["table"]).write.parquet(f"{path}/levels")


class _StateReader(DefaultParamsReader):
    def load(self, path):
        made = super().load(path)
        if "table" in made.learned:
            made._set(state={**made.learned, "table": f"{path}/levels"})
        return made


class _Fitted(Model, MLReadable, MLWritable):
    """Holds what the estimator learned in ``state``."""

    state = Param(Params._dummy(), "state", "learned values", TypeConverters.identity)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)

    @property
    def learned(self) -> dict:
        return self.getOrDefault("state")

    def report(self) -> list[tuple]:
        """``(column, statistic, value)`` rows."""
        return []

    def stored_report(self, spark) -> DataFrame | None:
        """The same rows of a level table, as a DataFrame."""
        if "table" not in self.learned:
            return None
        return spark.read.parquet(self.learned["table"]).select(
            "column", F.concat(F.lit(self.stat + ":"), "value").alias("stat"), F.col("x").cast("string").alias("value"))


# --- derived columns -------------------------------------------------------------------

class Derive(_Stage, Estimator):
    recipes = Param(Params._dummy(), "recipes", "recipes of derived columns", TypeConverters.identity)

    def _fit(self, df):
        return DeriveModel({"recipes": self.get("recipes"), "caps": upper_caps(df, self.get("recipes"))})


def upper_caps(df: DataFrame, recipes: list[dict]) -> dict[str, float | None]:
    """The upper quantiles that the winsorize recipes need, all from one set of passes."""
    wins = [r for r in recipes if r["op"] == "winsorize"]
    if not wins:
        return {}
    plain = derive(df, [r for r in recipes if r["op"] != "winsorize"])
    wins = [r for r in wins if r["column"] in plain.columns]
    probs = sorted({r["q"] for r in wins})
    found = quantile_report(plain, sorted({r["column"] for r in wins}), probs).values
    return {r["out"]: found[r["column"]][probs.index(r["q"])] for r in wins}


class DeriveModel(_Fitted):
    def _transform(self, df):
        recipes, caps = self.learned["recipes"], self.learned["caps"]
        if any(r.get("per_batch") for r in recipes):
            caps = {**caps, **upper_caps(df, [r for r in recipes if r["op"] != "winsorize" or r["per_batch"]])}
        return derive(df, recipes, caps)

    def report(self):
        return [(c, "cap", v) for c, v in self.learned["caps"].items()]


# --- ordinals and missing flags --------------------------------------------------------

def ranks_of(levels) -> dict[str, float]:
    """Ranks from 1 for a list of levels, the given numbers for a dict."""
    if isinstance(levels, dict):
        return {str(k): float(v) for k, v in levels.items()}
    return {str(v): float(i) for i, v in enumerate(levels, 1)}


class OrdinalMap(_Stage, Transformer):
    mapping = Param(Params._dummy(), "mapping", "column to levels", TypeConverters.identity)

    def _transform(self, df):
        return replace_columns(df, {
            c: lookup(col(c), ranks_of(levels)) for c, levels in self.get("mapping").items() if c in df.columns})

    def report(self):
        return [(c, "levels", len(levels)) for c, levels in self.get("mapping").items()]


def lookup(c: Column, values: dict[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
    return F.try_element_at(F.create_map(*pairs), c.cast("string")).cast("double")


class MissingFlags(_Stage, Estimator):
    def _fit(self, df):
        names = self.pick(df, "numeric")
        if not names:
            return MissingFlagsModel({"columns": []})
        row = df.agg(*[F.max(col(c).isNull()).alias(f"x{i}") for i, c in enumerate(names)]).first()
        return MissingFlagsModel({"columns": [c for c, missing in zip(names, row) if missing]})


class MissingFlagsModel(_Fitted):
    def _transform(self, df):
        return replace_columns(df, {}, {
            f"{c}_was_missing": col(c).isNull().cast("int") for c in self.learned["columns"]})

    def report(self):
        return [(c, "was_missing", 1) for c in self.learned["columns"]]


# --- level tables: small ones inline, others as a stored table ---------------------------

def keep_levels(table: DataFrame, columns: list[str], inline: int, label: str) -> dict:
    """``table`` has ``column, value, x``. Written once; inlined if it has at most ``inline`` rows."""
    path = new_path(table.sparkSession, label)
    table.write.parquet(path)
    rows = table.sparkSession.read.schema(table.schema).parquet(path).limit(inline + 1).collect()
    if len(rows) > inline:
        return {"columns": columns, "table": path}
    levels: dict[str, list] = {c: [] for c in columns}
    for r in sorted(rows, key=lambda r: (r["column"], r["value"])):
        levels[r["column"]].append([r["value"], r["x"]])
    return {"columns": columns, "levels": levels}


def join_levels(df: DataFrame, state: dict, keys: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
    """Left join one stored level table per column. Unhinted: Spark broadcasts a small table and
    splits hot keys of a large one."""
    levels = df.sparkSession.read.parquet(state["table"])
    found = {}
    for i, (c, key) in enumerate(keys.items()):
        side = levels.where(F.col("column") == c).select(
            F.col("value").alias(f"__k{i}"), F.col("x").alias(f"__x{i}"))
        df = df.join(side, key == F.col(f"__k{i}"), "left")
        found[c] = F.col(f"__x{i}")
    return df, found


MISSING_TEXT, OTHER = "nan", "Other"


def as_level(c: str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(MISSING_TEXT))


class RareGroup(_Stage, Estimator):
    """Levels seen fewer than ``min_freq`` times, and unseen ones, become ``Other``."""

    min_freq = Param(Params._dummy(), "min_freq", "least count to keep", TypeConverters.toInt)
    inline = Param(Params._dummy(), "inline", "levels held inline", TypeConverters.toInt)
    defaults = {"min_freq": 20, "inline": LEVELS_INLINE}

    def _fit(self, df):
        names = self.pick(df, "category")
        if not names:
            return RareGroupModel({"columns": [], "levels": {}})
        kept = frequent_levels(value_counts(df, names), self.get("min_freq"))
        return RareGroupModel(keep_levels(kept, names, self.get("inline"), "levels"))


def frequent_levels(counts: DataFrame, min_freq: int) -> DataFrame:
    """One row for each frequent level; NULL and the text it is shown as are one level if either is frequent."""
    shown = F.coalesce("value", F.lit(MISSING_TEXT)).alias("value")
    return counts.where(F.col("n") >= min_freq).select("column", shown, F.col("n").alias("x")).groupBy("column", "value").agg(
        F.max("x").alias("x"))


def as_counts(counts: DataFrame, ordinals: list[str], min_freq: int) -> DataFrame:
    """``(column, value, rare, n)``: rare levels of a category summed up, all others as they are."""
    is_level = ~F.col("column").isin(ordinals) if ordinals else F.lit(True)
    rare = is_level & (F.col("n") < min_freq)
    text = F.when(is_level, F.coalesce("value", F.lit(MISSING_TEXT))).otherwise(F.col("value"))
    return (counts.select("column", F.when(~rare, text).alias("value"), rare.alias("rare"), "n")
            .groupBy("column", "value", "rare").agg(F.sum("n").alias("n")))


def grouped(kept: dict[str, list], columns: list[str]) -> dict[str, Column]:
    """Expressions that leave kept levels and turn all others into ``Other``."""
    levels = {c: [v for v, _ in kept[c]] for c in columns}
    return {c: F.when(as_level(c).isin(levels[c]), as_level(c)).otherwise(F.lit(OTHER)) if levels[c]
            else F.lit(OTHER) for c in columns}


class RareGroupModel(_Fitted):
    stat = "kept"

    def _transform(self, df):
        names = [c for c in self.learned["columns"] if c in df.columns]
        if "table" not in self.learned:
            return replace_columns(df, grouped(self.learned["levels"], names))
        wide, found = join_levels(df, self.learned, {c: as_level(c) for c in names})
        return wide.select(*[
            F.when(found[c].isNotNull(), as_level(c)).otherwise(F.lit(OTHER)).alias(c) if c in found
            else col(c) for c in df.columns])

    def report(self):
        return [(c, f"kept:{v}", n) for c, kept in self.learned.get("levels", {}).items() for v, n in kept]


# --- one-hot of any number of levels -----------------------------------------------------

class OneHot(_Stage, Estimator):
    """One sparse vector ``outputCol`` over all levels seen when fitting, in column and then level order.

    The dictionary of levels is a table with dense slot numbers, so their number has no limit.
    Unknown and missing levels set no slot.
    """

    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    defaults = {"outputCol": "__hot"}

    def _fit(self, df):
        names, out = self.pick(df, "category"), self.get("outputCol")
        levels = value_counts(df, names).where(F.col("value").isNotNull()).withColumnRenamed("n", "x")
        model = number_levels(levels, names, group=False)
        return PipelineModel(stages=[model, *model.encoders(out), VectorAssembler(
            inputCols=[f"{out}_{i}" for i in model.wide()], outputCol=out), DropColumnsModel(
            {"drop": [*model.slot_columns(), *(f"{out}_{i}" for i in model.wide())]})])


def number_levels(levels: DataFrame, columns: list[str], keep: Column | None = None, group: bool = True) -> "LevelSlotsModel":
    """A dictionary of ``levels (column, value, x)``: those that ``keep`` holds for get dense slots in their column.

    With ``group`` unknown levels become ``Other``, and take its slot if there is one.
    """
    table = settle(levels.select("column", "value", "x", (F.lit(True) if keep is None else keep).alias("kept")), "levels")
    slots = dense_numbers(table.where("kept").select("column", "value"), "column", "value").withColumnRenamed("value", "__v").withColumnRenamed("column", "__c")
    made = table.join(slots, (F.col("column") == F.col("__c")) & (F.col("value") == F.col("__v")), "left").select("column", "value", "x", "slot")
    path = new_path(levels.sparkSession, "dictionary")
    made.write.parquet(path)
    stored = levels.sparkSession.read.schema(made.schema).parquet(path)
    sizes = {r["column"]: r["n"] for r in stored.groupBy("column").agg(F.count("slot").alias("n")).collect()}
    other = {r["column"]: r["slot"] for r in stored.where((F.col("value") == OTHER) & F.col("slot").isNotNull()).collect()} if group else {}
    return LevelSlotsModel({"columns": columns, "table": path, "sizes": {c: sizes.get(c, 0) for c in columns}, "other": other, "group": group})


class LevelSlotsModel(_Fitted):
    """Looks up each column's level in the stored dictionary: one left join a column, no hint.

    Adds ``__slot_<i>``, the number of columns' slots where there is no slot.
    """

    stat = "kept"

    def wide(self) -> list[int]:
        """Places of the columns that have slots."""
        return [i for i, c in enumerate(self.learned["columns"]) if self.learned["sizes"][c]]

    def slot_columns(self) -> list[str]:
        return [f"__slot_{i}" for i in range(len(self.learned["columns"]))]

    def width(self) -> int:
        return sum(self.learned["sizes"].values())

    def encoders(self, out: str) -> list:
        """Fitted encoders from slot numbers to sparse vectors ``<out>_<i>``; a number beyond the last sets none."""
        places = self.wide()
        if not places:
            return []
        spark = SparkSession.getActiveSession()
        sizes = [float(self.learned["sizes"][self.learned["columns"][i]] - 1) for i in places]
        last = spark.createDataFrame([tuple(sizes)], ", ".join(f"__slot_{i} double" for i in places))
        return [OneHotEncoder(inputCols=last.columns, outputCols=[f"{out}_{i}" for i in places], handleInvalid="keep").fit(last)]

    def _transform(self, df):
        s, names = self.learned, self.learned["columns"]
        levels = df.sparkSession.read.parquet(s["table"])
        wide = df
        for i, c in enumerate(names):
            side = levels.where(F.col("column") == c).select(F.col("value").alias(f"__k{i}"), F.col("slot").alias(f"__s{i}"))
            wide = wide.join(side, (as_level(c) if s["group"] else col(c).cast("string")) == F.col(f"__k{i}"), "left")
        grouped_columns, slots = {}, []
        for i, c in enumerate(names):
            none, known = s["sizes"][c], F.col(f"__k{i}").isNotNull()
            if s["group"]:
                grouped_columns[c] = F.when(known, F.col(f"__k{i}")).otherwise(F.lit(OTHER))
            slot = F.when(known, F.coalesce(F.col(f"__s{i}"), F.lit(none))).otherwise(F.lit(s["other"].get(c, none)))
            slots.append(slot.cast("double").alias(f"__slot_{i}"))
        return wide.select(*[grouped_columns.get(c, col(c)).alias(c) for c in df.columns], *slots)

    def names(self, spark) -> DataFrame:
        """``(place, slot, feature)`` of every slot."""
        place = F.create_map(*[x for i, c in enumerate(self.learned["columns"]) for x in (F.lit(c), F.lit(i))])
        return spark.read.parquet(self.learned["table"]).where(F.col("slot").isNotNull()).select(
            F.element_at(place, F.col("column")).alias("place"), "slot", F.concat_ws("_", "column", "value").alias("feature"))


class TargetEncode(_Stage, Estimator):
    """``TE_<column>``: mean target of the level; the overall mean for unseen or missing levels."""

    target = Param(Params._dummy(), "target", "target column", TypeConverters.toString)
    inline = Param(Params._dummy(), "inline", "levels held inline", TypeConverters.toInt)
    defaults = {"inline": MAP_INLINE}

    def _fit(self, df):
        if not self.isDefined("target"):
            raise ValueError("target encoding needs a target column")
        names, y = self.pick(df, "category"), col(self.get("target")).cast("double")
        overall = df.agg(F.avg(y)).first()[0]
        if not names:
            return TargetEncodeModel({"columns": [], "levels": {}, "mean": overall})
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in names])
        means = (df.select(F.explode(pairs).alias("p"), y.alias("y"))
                 .where(F.col("p.value").isNotNull())
                 .groupBy("p.column", "p.value").agg(F.avg("y").alias("x"))
                 .where(F.col("x").isNotNull()))
        return TargetEncodeModel({**keep_levels(means, names, self.get("inline"), "means"), "mean": overall})


class TargetEncodeModel(_Fitted):
    stat = "mean"

    def _transform(self, df):
        names = [c for c in self.learned["columns"] if c in df.columns]
        mean = F.lit(self.learned["mean"]).cast("double")
        wide, found = df, {}
        if "table" in self.learned:
            wide, found = join_levels(df, self.learned, {c: col(c).cast("string") for c in names})
        else:
            found = {c: lookup(col(c), dict(self.learned["levels"][c])) if self.learned["levels"][c]
                     else F.lit(None) for c in names}
        return wide.select(*[col(c) for c in df.columns],
                           *[F.coalesce(found[c], mean).cast("double").alias(f"TE_{c}") for c in names])

    def report(self):
        return [(c, f"mean:{v}", x) for c, means in self.learned.get("levels", {}).items() for v, x in means]


# --- numbers ---------------------------------------------------------------------------

class ClipOutliers(_Stage, Estimator):
    """Clip to ``[q1 - factor*iqr, q3 + factor*iqr]``; a column without spread is left alone."""

    factor = Param(Params._dummy(), "factor", "iqr multiple", TypeConverters.toFloat)
    exact = Param(Params._dummy(), "exact", "exact quartiles or a sketch", TypeConverters.toBoolean)
    defaults = {"factor": 1.5, "exact": True}

    def _fit(self, df):
        names = self.pick(df, "numeric")
        found = quantile_report(df, names, [0.25, 0.75], exact=self.get("exact")).values
        return ClipOutliersModel({"bounds": iqr_bounds(found, self.get("factor"))})


def iqr_bounds(quartiles: dict[str, list], factor: float) -> dict[str, list[float]]:
    bounds = {}
    for c, (q1, q3) in quartiles.items():
        spread = None if q1 is None else q3 - q1
        if spread and spread == spread:
            bounds[c] = [q1 - factor * spread, q3 + factor * spread]
    return bounds


class ClipOutliersModel(_Fitted):
    def _transform(self, df):
        return replace_columns(df, {
            c: clip(col(c).cast("double"), *b) for c, b in self.learned["bounds"].items() if c in df.columns})

    def report(self):
        return [(c, s, v) for c, b in self.learned["bounds"].items() for s, v in zip(("low", "high"), b)]


class NanClean(_Stage, Transformer):
    """NaN becomes missing in every column of floats."""

    def _transform(self, df):
        return nan_to_null(df)


class FiniteClean(_Stage, Transformer):
    """Infinities and NaN become missing."""

    def _transform(self, df):
        floats = [c for c in self.pick(df, "numeric") if df.schema[c].dataType.typeName() in ("double", "float")]
        return replace_columns(df, {c: finite(col(c)) for c in floats})


class ModeFill(_Stage, Estimator):
    def _fit(self, df):
        names = self.pick(df, "category")
        fills: dict = {}
        for kind in ("double", "string"):
            same = [c for c in names if (df.schema[c].dataType.typeName() == "string") == (kind == "string")]
            if same:
                fills.update({r["column"]: r["mode"] for r in modes(value_counts(df, same, kind)).collect()})
        return FillModel({"fills": fills, "stat": "mode"})


class MedianFill(_Stage, Estimator):
    """Fills with the exact median. A column without any value is dropped."""

    exact = Param(Params._dummy(), "exact", "exact median or a sketch", TypeConverters.toBoolean)
    defaults = {"exact": True}

    def _fit(self, df):
        found = quantile_report(df, self.pick(df, "numeric"), [0.5], exact=self.get("exact")).values
        return FillModel({
            "fills": {c: v[0] for c, v in found.items() if v[0] is not None},
            "drop": [c for c, v in found.items() if v[0] is None], "stat": "median"})


class FillModel(_Fitted):
    def _transform(self, df):
        df = df.drop(*self.learned.get("drop", []))
        return replace_columns(df, {
            c: F.coalesce(col(c).cast("string" if isinstance(v, str) else "double"), F.lit(v))
            for c, v in self.learned["fills"].items() if c in df.columns})

    def report(self):
        return [(c, self.learned["stat"], v) for c, v in self.learned["fills"].items()]


class Standardize(_Stage, Estimator):
    """``(x - mean) / population deviation``; no spread divides by 1."""

    def _fit(self, df):
        names = self.pick(df, "numeric")
        if not names:
            return StandardizeModel({"scale": {}})
        row = df.agg(*[a for i, c in enumerate(names) for a in (
            F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}"))]).first()
        return StandardizeModel({"scale": {
            c: [row[2 * i], row[2 * i + 1] or 1.0] for i, c in enumerate(names) if row[2 * i] is not None}})


class StandardizeModel(_Fitted):
    def _transform(self, df):
        return replace_columns(df, {
            c: (col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, (m, s) in self.learned["scale"].items() if c in df.columns})

    def report(self):
        return [(c, s, v) for c, ms in self.learned["scale"].items() for s, v in zip(("mean", "deviation"), ms)]


class DropEmpty(_Stage, Estimator):
    """Drop columns without any value when fitting."""

    def _fit(self, df):
        names = self.get("columns") or [c for c in df.columns if c not in self.get("exclude")]
        row = df.agg(*[F.count(col(c)).alias(f"x{i}") for i, c in enumerate(names)]).first()
        return DropColumnsModel({"drop": [c for c, n in zip(names, row) if n == 0]})


class VarianceKeep(_Stage, Estimator):
    """Keep numeric columns whose sample variance is above the threshold."""

    threshold = Param(Params._dummy(), "threshold", "variance to exceed", TypeConverters.toFloat)
    defaults = {"threshold": 0.0}

    def _fit(self, df):
        names = self.pick(df, "numeric")
        if not names:
            return DropColumnsModel({"drop": []})
        row = df.agg(*[F.var_samp(col(c)).alias(f"x{i}") for i, c in enumerate(names)]).first()
        return DropColumnsModel({"drop": [
            c for c, v in zip(names, row) if v is None or not v > self.get("threshold")]})


class DropColumnsModel(_Fitted):
    def _transform(self, df):
        return df.drop(*self.learned["drop"])

    def report(self):
        return [(c, "dropped", 1) for c in self.learned["drop"]]
