"""The feature plan: every transform in order, fitted in as few passes as possible.

``feature_stages`` returns the stages one by one, as an unfitted ``Pipeline``. ``fit_features``
gives the same fitted model in five passes over the training table: one grouped count serves
rare levels, modes, one-hot sizes and their variances; one set of quantiles serves clipping and
medians (clipping never moves a median); one aggregation serves scaling and the variances.

A category with up to ``INLINE`` levels is a projection; a wider one is looked up in a dictionary
table with dense slot numbers, which no part of the fit brings to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import accumulate

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.functions.counts import value_counts
from tessel.functions.nulls import clip, col, finite, nan_to_null, replace_columns
from tessel.functions.quantiles import quantile_report
from tessel.operators import stages as st
from tessel.operators.encode import assemble, keep_slots, one_hot
from tessel.operators.mutual import (
    bin_of, information, joint_counts, level_information, quantile_edges)
from tessel.operators.roles import Roles, infer_roles
from tessel.session import settle

#: Levels of a category that are held in expressions; all columns together hold this many a column at most.
INLINE = 1_000


@dataclass
class FeaturePlan:
    """What to build.

    ``carry`` names added columns that also reach the vector: ``"indicators"``, ``"target_enc"``.
    By default the vector holds only the columns known before those are added.
    """

    key: list[str]
    target: str
    recipes: list[dict] = field(default_factory=list)
    ordinals: dict[str, list | dict] = field(default_factory=dict)
    roles: dict[str, str] = field(default_factory=dict)
    exclude: list[str] = field(default_factory=list)
    min_freq: int = 20
    target_encode: list[str] = field(default_factory=list)
    clip_factor: float = 1.5
    variance_threshold: float | None = 0.0
    k_best: int | None = None
    mi_bins: int = 16
    exact: bool = True
    carry: tuple[str, ...] = ()

    @property
    def hidden(self) -> list[str]:
        return [*self.key, self.target, *self.exclude]


@dataclass
class FittedFeatures:
    """The fitted plan. Slots: narrow categories (``head``), wide ones by column and level, then ``tail``."""

    model: PipelineModel
    head: list[str]
    tail: list[str]
    wide: st.LevelSlotsModel | None
    roles: Roles
    plan: FeaturePlan

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    @property
    def width(self) -> int:
        return len(self.head) + (self.wide.width() if self.wide else 0) + len(self.tail)

    @property
    def names(self) -> list[str]:
        """All slot names; for wide categories rather take :meth:`names_table`."""
        found = []
        if self.wide:
            found = self.wide.names(SparkSession.getActiveSession()).orderBy("place", "slot").collect()
        return [*self.head, *(r["feature"] for r in found), *self.tail]

    def names_table(self, spark) -> DataFrame:
        first = len(self.head)
        rest = first + (self.wide.width() if self.wide else 0)
        known = spark.createDataFrame([*enumerate(self.head), *enumerate(self.tail, rest)], "idx int, feature string")
        if not self.wide:
            return known
        sizes = [self.wide.learned["sizes"][c] for c in self.wide.learned["columns"]]
        starts = F.array(*[F.lit(n) for n in accumulate([first, *sizes[:-1]])])
        return known.unionByName(self.wide.names(spark).select(
            (F.get(starts, F.col("place")) + F.col("slot")).cast("int").alias("idx"), "feature"))


def planned_roles(df: DataFrame, plan: FeaturePlan) -> tuple[DataFrame, Roles]:
    """The table with its derived columns (caps still open) and the roles of all columns."""
    derived = st.derive(df, plan.recipes) if plan.recipes else df
    return derived, infer_roles(derived, list(plan.ordinals), plan.hidden, plan.roles)


def feature_stages(df: DataFrame, plan: FeaturePlan) -> Pipeline:
    """Column-level stages, unfitted, in order; the vector follows from :func:`fit_features`."""
    _, roles = planned_roles(df, plan)
    steps: list = [st.NanClean()]
    if plan.recipes:
        steps.append(st.Derive(recipes=plan.recipes))
    if roles.ordinal:
        steps.append(st.OrdinalMap(mapping={c: plan.ordinals[c] for c in roles.ordinal}))
    steps.append(st.MissingFlags(exclude=plan.hidden))
    steps.append(st.RareGroup(columns=roles.category, min_freq=plan.min_freq))
    if plan.target_encode:
        steps.append(st.TargetEncode(columns=plan.target_encode, target=plan.target))
    measured = roles.ordinal + roles.numeric
    return Pipeline(stages=steps + [
        st.ClipOutliers(exclude=plan.hidden, factor=plan.clip_factor, exact=plan.exact),
        st.FiniteClean(columns=measured),
        st.ModeFill(columns=roles.category + roles.ordinal),
        st.MedianFill(columns=roles.numeric, exact=plan.exact),
        st.Standardize(columns=roles.numeric),
    ])


def fit_features(df: DataFrame, plan: FeaturePlan) -> FittedFeatures:
    df = nan_to_null(df)
    derived, roles = planned_roles(df, plan)
    steps: list = [st.NanClean()]
    if plan.recipes:
        caps = st.upper_caps(df, plan.recipes)
        steps.append(st.DeriveModel({"recipes": plan.recipes, "caps": caps}))
        derived = steps[-1].transform(df)
    cats, ords, nums = roles.category, roles.ordinal, roles.numeric
    ranks = {c: st.ranks_of(plan.ordinals[c]) for c in ords}
    mapped = {c: st.lookup(col(c), ranks[c]) for c in ords}
    value = {**mapped, **{c: col(c).cast("double") for c in nums}}

    # pass 1: level counts; ordinals are counted after mapping, so that levels stay few
    rows, kept, other, modes, wide_levels = _levels(derived, plan, cats, mapped)
    wide = [c for c in cats if c not in kept]
    narrow = [c for c in cats if c in kept]
    slots, grouped_rows = None, derived
    if wide:
        slots = st.number_levels(wide_levels, wide, _varied(F.col("x"), rows, plan.variance_threshold))
        grouped_rows = slots.transform(derived)
    grouped_rows = replace_columns(grouped_rows, st.grouped(kept, narrow))

    # passes 2-4: quartiles and medians
    found = quantile_report(derived, ords + nums, [0.25, 0.5, 0.75], exact=plan.exact, exprs=value)
    bounds = st.iqr_bounds({c: [v[0], v[2]] for c, v in found.values.items()}, plan.clip_factor)
    missing = [c for c in _numeric_order(derived, roles) if found.present[c] < rows]
    medians = {c: found.values[c][1] for c in nums}
    endless = [c for c in nums if c not in bounds and medians[c] is not None
               and not all(map(math.isfinite, found.extremes.get(c, (math.inf,))))]
    if endless:  # infinities that clipping leaves are blanked before the median
        again = quantile_report(derived, endless, [0.5], exact=plan.exact, exprs={c: finite(value[c]) for c in endless})
        medians.update({c: v[0] for c, v in again.values.items()})
    fills = {c: _clipped_mode(modes.get(c, {}), bounds.get(c)) for c in ords}
    empty = [c for c in ords + nums if (fills if c in ords else medians)[c] is None]
    ords, nums = [c for c in ords if c not in empty], [c for c in nums if c not in empty]

    encoder = None
    if plan.target_encode:
        encoder = st.TargetEncode(columns=plan.target_encode, target=plan.target).fit(grouped_rows)
        derived = grouped_rows = encoder.transform(grouped_rows)

    # pass 5: means and deviations of what clipping and filling leave, and of carried columns
    clean = {c: F.coalesce(finite(clip(value[c], *bounds[c]) if c in bounds else value[c]),
                           F.lit(fills[c] if c in fills else medians[c])) for c in ords + nums}
    added = {}
    if "indicators" in plan.carry:
        added.update({f"{c}_was_missing": value[c].isNull().cast("double") for c in missing})
    if "target_enc" in plan.carry and encoder is not None:
        added.update({f"TE_{c}": col(f"TE_{c}") for c in encoder.learned["columns"]})
    scale, spread = _scales(derived, {**clean, **added}, nums)

    if ords:
        steps.append(st.OrdinalMap(mapping={c: plan.ordinals[c] for c in ranks}))
    steps.append(st.MissingFlagsModel({"columns": missing}))
    steps.append(st.RareGroupModel({"columns": narrow, "levels": kept}))
    slots_at = len(steps)
    steps += [encoder] if encoder is not None else []
    steps += [
        st.ClipOutliersModel({"bounds": bounds}),
        st.FiniteClean(columns=ords + nums),
        st.FillModel({"fills": {c: fills[c] for c in ords}, "stat": "mode"}),
        st.FillModel({"fills": {c: medians[c] for c in nums}, "drop": empty, "stat": "median"}),
        st.StandardizeModel({"scale": scale}),
    ]
    levels = {c: sorted({v for v, _ in kept[c]} | ({st.OTHER} if other[c] else set())) for c in narrow}
    levels = {c: v for c, v in levels.items() if v}
    tail = ords + nums + list(added)
    keys = [(c, v) for c in levels for v in levels[c]]
    numbers = [(None, c) for c in tail]
    if plan.variance_threshold is not None:
        seen = {c: dict(kept[c]) for c in levels}
        for c in levels:
            if other[c]:
                seen[c][st.OTHER] = seen[c].get(st.OTHER, 0) + other[c]
        unit = rows / (rows - 1) if rows > 1 else 0.0
        variance = {c: (unit if spread[c] > 0 else 0.0) if c in nums else spread[c] for c in tail}
        keys = [(c, v) for c, v in keys if _spread_of(seen[c][v], rows) > plan.variance_threshold]
        numbers = [(None, c) for _, c in numbers if variance[c] > plan.variance_threshold]
    if plan.k_best is not None and (keys or numbers or slots):
        best = _best_slots(grouped_rows, plan, {**clean, **added}, keys, numbers, slots)
        keys, numbers = [k for k in keys if k in best], [k for k in numbers if k in best]
        if slots:
            chosen = derived.sparkSession.createDataFrame([k for k in best if k[0] in wide], "column string, value string").withColumn("__best", F.lit(True))
            slots = st.number_levels(wide_levels.join(F.broadcast(chosen), ["column", "value"], "left"), wide, F.col("__best").isNotNull())
    if slots:
        steps.insert(slots_at, slots)
    held = {c: [v for w, v in keys if w == c] for c in levels}
    steps += one_hot(held)
    vectors = [f"__wide_{i}" for i in slots.wide()] if slots else []
    steps += slots.encoders("__wide") if slots else []
    inputs = [c for _, c in numbers]
    helpers = tuple(slots.slot_columns()) if slots else ()
    if keys or numbers or vectors:
        steps += assemble(bool(keys), inputs, [], "features", tuple(vectors), helpers)
    else:  # nothing varies: an empty vector
        steps += [*assemble(False, tail[:1], [], "all_features", (), helpers), *keep_slots([], "all_features")]
    return FittedFeatures(PipelineModel(stages=steps), [f"{c}_{v}" for c in levels for v in held[c]], inputs, slots,
                          replace(roles, ordinal=ords, numeric=nums), plan)


def _spread_of(n: int, rows: int) -> float:
    """Sample variance of a 0/1 slot that ``n`` of ``rows`` set."""
    p = n / rows
    return p * (1 - p) * rows / (rows - 1) if rows > 1 else 0.0


def _varied(n, rows: int, threshold: float | None):
    """The same for a column of counts, against the threshold."""
    if threshold is None:
        return F.lit(True)
    p = n / F.lit(float(max(rows, 1)))
    return (p * (1 - p) * rows / (rows - 1) if rows > 1 else F.lit(0.0)) > threshold


def _numeric_order(derived: DataFrame, roles: Roles) -> list[str]:
    wanted = set(roles.ordinal) | set(roles.numeric)
    return [c for c in derived.columns if c in wanted]


def _levels(derived, plan, cats, mapped):
    """Rows; kept levels with counts and the count of grouped rows of each narrow category; ordinal level counts;
    ``(column, value, x)`` of all levels of the wide ones."""
    ords = list(mapped)
    source = derived.select(*[col(c) for c in cats], *[e.cast("string").alias(c) for c, e in mapped.items()])
    if not cats and not ords:
        return derived.count(), {}, {}, {}, None
    counts = settle(st.as_counts(value_counts(source, cats + ords), ords, plan.min_freq), "counts")
    sizes = counts.groupBy("column", "rare").agg(F.count(F.lit(1)).alias("levels"), F.sum("n").alias("n")).collect()
    rows = sum(r["n"] for r in sizes if r["column"] == (cats + ords)[0])
    wide = [r["column"] for r in sizes if r["column"] in cats and not r["rare"] and r["levels"] > INLINE]
    kept: dict[str, list] = {c: [] for c in cats if c not in wide}
    other = {c: 0 for c in kept}
    modes: dict[str, dict] = {c: {} for c in ords}
    for r in counts.where(~F.col("column").isin(wide) if wide else F.lit(True)).collect():
        c, v, n = r["column"], r["value"], r["n"]
        if c in modes:
            if v is not None:
                modes[c][float(v)] = n
        elif r["rare"]:
            other[c] += n
        else:
            kept[c].append([v, n])
    levels = None
    if wide:
        value = F.when(F.col("rare"), F.lit(st.OTHER)).otherwise(F.col("value"))
        levels = settle(counts.where(F.col("column").isin(wide)).groupBy("column", value.alias("value")).agg(F.sum("n").alias("x")), "levels")
    return rows, {c: sorted(v) for c, v in kept.items()}, other, modes, levels


def _clipped_mode(counts: dict[float, int], bounds) -> float | None:
    merged: dict[float, int] = {}
    for v, n in counts.items():
        v = min(max(v, bounds[0]), bounds[1]) if bounds else v
        merged[v] = merged.get(v, 0) + n
    return min(merged, key=lambda v: (-merged[v], v)) if merged else None


def _scales(derived, exprs, nums):
    """Mean and deviation of the numbers, sample variance of every expression."""
    scale, spread = {}, {}
    if exprs:
        names = list(exprs)
        row = derived.agg(*[a for i, c in enumerate(names) for a in (
            F.avg(exprs[c]).alias(f"m{i}"), F.stddev_pop(exprs[c]).alias(f"s{i}"),
            F.var_samp(exprs[c]).alias(f"v{i}"))]).first()
        for i, c in enumerate(names):
            spread[c] = row[f"v{i}"] or 0.0
            if c in nums:
                scale[c] = [row[f"m{i}"], row[f"s{i}"] or 1.0]
    return scale, spread


def _best_slots(rows, plan, exprs, keys, numbers, slots) -> set:
    """The ``k_best`` slots by mutual information with the target, ties by name, as ``(column, level)`` or ``(None, column)``.

    ``rows`` hold grouped levels. Slots of equal names are told apart by column; only the chosen ones reach the driver.
    """
    measured, levels = [c for _, c in numbers], list(dict.fromkeys(c for c, _ in keys))
    wide = slots.learned["columns"] if slots else []
    columns = [*levels, *wide]
    table = rows.select(*[exprs[c].alias(c) for c in measured], *[col(c) for c in columns], col(plan.target).cast("double").alias("__y"))
    edges = quantile_edges(table, [*measured, "__y"], plan.mi_bins, exact=plan.exact)
    y_bin = bin_of(F.col("__y"), edges["__y"])
    scores = []
    if measured:
        found = information(joint_counts(table, {c: bin_of(col(c), edges[c]) for c in measured}, y_bin))
        scores.append(found.select(F.lit(None).cast("string").alias("column"), F.col("feature").alias("value"), F.col("feature").alias("name"), "mi"))
    if columns:
        found = level_information(joint_counts(table, {str(i): col(c) for i, c in enumerate(columns)}, y_bin))
        number = F.substring_index("feature", "_", 1)
        column = F.get(F.array(*[F.lit(c) for c in columns]), number.cast("int"))
        value = F.expr("substring(feature, length(substring_index(feature, '_', 1)) + 2)")
        found = found.select(column.alias("column"), value.alias("value"), F.concat_ws("_", column, value).alias("name"), "mi")
        allowed = [F.struct(F.lit(c), F.lit(v)) for c, v in keys]
        if levels:
            scores.append(found.where(F.struct("column", "value").isin(allowed)))
        if wide:
            known = found.sparkSession.read.parquet(slots.learned["table"]).where(F.col("slot").isNotNull()).select("column", "value")
            scores.append(found.join(known, ["column", "value"], "left_semi"))
    best = reduce(DataFrame.unionByName, scores).orderBy(F.desc("mi"), "name", F.coalesce("column", F.lit("")), "value").limit(plan.k_best)
    return {(r["column"], r["value"]) for r in best.collect()}
