"""Exact interpolated quantiles of many columns without sorting any column.

``percentile`` keeps every distinct value of a column in one task, which cannot hold at scale.
Here a sketch proposes cut points close to every wanted rank, one count in the tasks tells exactly
how many rows lie between neighbouring cut points, and only the rows of the few intervals that
hold a wanted rank are grouped by value and ranked. That is three passes over pruned columns
whatever the size; an interval that still holds many rows is first cut again.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessel.functions.nulls import col
from tessel.session import reach

ACCURACY = 10_000
OPEN_ROWS = 2_000_000
#: Values sorted at once for the sketch, and how many of them one stands for.
BLOCK, STEP = 1 << 17, 16
#: The interval of missing values.
MISSING = -1


@dataclass
class Quantiles:
    values: dict[str, list[float | None]]
    present: dict[str, int]
    rows: int
    extremes: dict[str, tuple[float, float]] = field(default_factory=dict)


@dataclass
class _Interval:
    """Rows of one column at a cut point, or strictly between two of them."""

    first: int
    n: int
    low: float
    high: float

    def value_at(self, rank: int) -> float | None:
        if self.low == self.high or rank == self.first:
            return self.low
        return self.high if rank == self.first + self.n - 1 else None


@dataclass
class _Ranked:
    cuts: list[float] = field(default_factory=list)
    intervals: list[_Interval] = field(default_factory=list)
    present: int = 0
    found: dict[int, float] = field(default_factory=dict)

    def ranks(self, prob: float) -> tuple[int, int]:
        at = (self.present - 1) * prob
        return math.floor(at), math.ceil(at)

    def holding(self, rank: int) -> _Interval:
        return next(i for i in self.intervals if i.first <= rank < i.first + i.n)

    def at(self, rank: int) -> float | None:
        return self.found[rank] if rank in self.found else self.holding(rank).value_at(rank)

    def quantile(self, prob: float) -> float | None:
        if not self.present:
            return None
        low, high = (self.at(r) for r in self.ranks(prob))
        part = (self.present - 1) * prob - self.ranks(prob)[0]
        return low if part == 0 else low + (high - low) * part


def _around(prob: float, accuracy: int) -> list[float]:
    slack = 2.0 / accuracy
    return [min(max(prob + d, 0.0), 1.0) for d in (-slack, slack)]


def _sketch(df: DataFrame, wanted: list[tuple[Column, list[float]]], accuracy: int) -> list[list[float]]:
    """Values near the wanted ranks, from every ``STEP``-th value of sorted blocks. They only propose: counts decide."""
    probs = sorted({p for _, own in wanted for p in own})
    thin = _values(df, [c for c, _ in wanted]).mapInArrow(_thinned(len(wanted)), "c int, v double")
    found = {r["c"]: dict(zip(probs, r["q"])) for r in thin.groupBy("c").agg(F.percentile_approx("v", probs, accuracy).alias("q")).collect()}
    return [[found[i][p] for p in own] if i in found else [] for i, (_, own) in enumerate(wanted)]


def _thinned(columns: int):
    def middle(i: int, held: list[np.ndarray]) -> pa.RecordBatch:
        v = np.sort(np.concatenate(held))[STEP // 2::STEP]
        return pa.RecordBatch.from_pydict({"c": pa.array(np.full(len(v), i), pa.int32()), "v": v})

    def run(batches):
        held = [[] for _ in range(columns)]
        size = [0] * columns
        for batch in batches:
            for i in range(columns):
                held[i].append(batch.column(i).drop_null().to_numpy(zero_copy_only=False))
                size[i] += len(held[i][-1])
                if size[i] >= BLOCK:
                    yield middle(i, held[i])
                    held[i], size[i] = [], 0
        for i in range(columns):
            if size[i]:
                yield middle(i, held[i])
    return run


def _count(df: DataFrame, exprs: dict[str, Column], ranked: dict[str, _Ranked]) -> int:
    """Fill in the intervals of all columns; returns the number of rows.

    Tasks count: the shuffle moves one row an interval and task.
    """
    names = list(ranked)
    parts = _values(df, [exprs[n] for n in names]).mapInArrow(
        _counted([np.array(ranked[n].cuts, float) for n in names]), "c int, at int, n long, low double, high double")
    found = parts.groupBy("c", "at").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    for i, n in enumerate(names):
        mine = sorted((r for r in found if r["c"] == i and r["at"] != MISSING), key=lambda r: r["at"])
        first, intervals = 0, []
        for r in mine:
            intervals.append(_Interval(first, r["n"], r["low"], r["high"]))
            first += r["n"]
        ranked[n].intervals, ranked[n].present = intervals, first
    return sum(r["n"] for r in found if r["c"] == 0)


def _values(df: DataFrame, exprs: list[Column]) -> DataFrame:
    reach(df.sparkSession)
    return df.select(*[e.cast("double").alias(f"v{i}") for i, e in enumerate(exprs)])


def _counted(cuts: list[np.ndarray]):
    """Rows, least and largest value by column and interval: ``2i`` between cuts, ``2i + 1`` on cut ``i``. NaN is above all."""
    def run(batches):
        n = [np.zeros(2 * len(c) + 1, np.int64) for c in cuts]
        low, high = ([np.full(2 * len(c) + 1, x) for c in cuts] for x in (np.nan, -np.inf))
        missing = [0] * len(cuts)
        for batch in batches:
            for i, c in enumerate(cuts):
                missing[i] += batch.column(i).null_count
                v = np.sort(batch.column(i).drop_null().to_numpy(zero_copy_only=False))
                ends = np.empty(2 * len(c) + 2, np.int64)
                ends[0], ends[-1] = 0, len(v)
                ends[1:-1:2], ends[2:-1:2] = np.searchsorted(v, c, "left"), np.searchsorted(v, c, "right")
                on = np.flatnonzero(np.diff(ends))
                n[i] += np.diff(ends)
                low[i][on] = np.fmin(low[i][on], v[ends[on]])
                high[i][on] = np.maximum(high[i][on], v[ends[on + 1] - 1])
        for i in range(len(cuts)):
            on = np.flatnonzero(n[i])
            yield pa.RecordBatch.from_pydict({
                "c": pa.array(np.full(len(on) + 1, i), pa.int32()), "at": pa.array(np.append(on, MISSING), pa.int32()),
                "n": np.append(n[i][on], missing[i]), "low": pa.array([*low[i][on].tolist(), None], pa.float64()),
                "high": pa.array([*high[i][on].tolist(), None], pa.float64())})
    return run


def _rank_inside(df: DataFrame, open_ranks: dict[tuple[str, int], list[int]], exprs: dict[str, Column],
                 ranked: dict[str, _Ranked]) -> None:
    """Group and rank the rows of the open intervals, one partition per interval."""
    spans = {key: ranked[key[0]].holding(ranks[0]) for key, ranks in open_ranks.items()}
    names = list(dict.fromkeys(name for name, _ in spans))
    wanted = F.array(*[
        F.array(*[F.lit(r - spans[key].first).cast("bigint") for r in ranks]) for key, ranks in open_ranks.items()])
    upto = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = [sorted(((s.low, s.high, b) for b, (key, s) in enumerate(spans.items()) if key[0] == name), key=lambda x: (math.isnan(x[0]), x[0]))
              for name in names]
    rows = (_values(df, [exprs[n] for n in names]).mapInArrow(_of_spans(inside), "b int, v double, n long")
            .groupBy("b", "v").agg(F.sum("n").alias("n"))
            .withColumn("end", F.sum("n").over(upto))
            .where(F.exists(F.get(wanted, F.col("b")),
                            lambda r: (r < F.col("end")) & (r >= F.col("end") - F.col("n"))))
            .collect())
    for i, (key, ranks) in enumerate(open_ranks.items()):
        for rank in ranks:
            at = rank - spans[key].first
            ranked[key[0]].found[rank] = next(
                r["v"] for r in rows if r["b"] == i and r["end"] - r["n"] <= at < r["end"])


def _of_spans(inside: list[list[tuple[float, float, int]]]):
    """``(number of the span, value, rows)`` of the values in each column's spans, which are sorted and lie apart."""
    def run(batches):
        sides = [tuple(np.array(x) for x in zip(*spans)) for spans in inside]
        for batch in batches:
            found = []
            for i, (low, high, number) in enumerate(sides):
                v, n = np.unique(batch.column(i).drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                at = np.searchsorted(low, v, "right") - 1
                on = (at >= 0) & (np.searchsorted(high, v, "left") == at)
                found.append((number[at[on]], v[on], n[on]))
            b, v, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_pydict({"b": pa.array(b, pa.int32()), "v": v, "n": pa.array(n, pa.int64())})
    return run


def quantile_report(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    accuracy: int = ACCURACY,
    exact: bool = True,
    exprs: dict[str, Column] | None = None,
    open_rows: int = OPEN_ROWS,
) -> Quantiles:
    """Quantiles of every column, with the number of present values and rows.

    ``exact=False`` stops at the sketch (rank error at most ``rows / accuracy``).
    """
    exprs = {c: (exprs or {}).get(c, col(c).cast("double")) for c in columns}
    if not columns:
        return Quantiles({}, {}, 0)
    if not exact:
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(e).alias(f"n{i}") for i, e in enumerate(exprs.values())],
            *[F.percentile_approx(e, list(probs), accuracy).alias(f"q{i}") for i, e in enumerate(exprs.values())],
        ).first()
        return Quantiles(
            {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(columns)},
            {c: row[f"n{i}"] for i, c in enumerate(columns)}, row["rows"])

    around = [p for prob in probs for p in _around(prob, accuracy)]
    points = _sketch(df, [(exprs[c], around) for c in columns], accuracy)
    ranked = {c: _Ranked(sorted(set(p))) for c, p in zip(columns, points)}
    rows = _count(df, exprs, ranked)
    while True:
        open_ranks: dict[tuple[str, int], list[int]] = {}
        for c, r in ranked.items():
            for rank in sorted({k for p in probs for k in r.ranks(p)} if r.present else set()):
                if r.at(rank) is None:
                    open_ranks.setdefault((c, r.holding(rank).first), []).append(rank)
        wide = {key: ranks for key, ranks in open_ranks.items() if ranked[key[0]].holding(ranks[0]).n > open_rows}
        if not wide:
            break
        _cut_again(df, wide, exprs, ranked, accuracy)
        _count(df, exprs, ranked)
    if open_ranks:
        _rank_inside(df, open_ranks, exprs, ranked)
    return Quantiles(
        {c: [r.quantile(p) for p in probs] for c, r in ranked.items()},
        {c: r.present for c, r in ranked.items()}, rows,
        {c: (r.intervals[0].low, r.intervals[-1].high) for c, r in ranked.items() if r.present})


def _cut_again(df, wide, exprs, ranked, accuracy) -> None:
    """More cut points inside wide intervals. Every interval gets at least its own end points, so
    that it shrinks each time."""
    wanted, spans = [], []
    for (name, _), ranks in wide.items():
        span = ranked[name].holding(ranks[0])
        rel = [p for r in ranks for p in _around((r - span.first) / (span.n - 1), accuracy)]
        c = exprs[name]
        wanted.append((F.when(c.between(F.lit(span.low), F.lit(span.high)), c), rel))
        spans.append((name, span))
    for (name, span), points in zip(spans, _sketch(df, wanted, accuracy)):
        for p in {*points, span.low, span.high}:
            at = bisect_left(ranked[name].cuts, p)
            if at == len(ranked[name].cuts) or ranked[name].cuts[at] != p:
                ranked[name].cuts.insert(at, p)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], **options) -> dict[str, list]:
    return quantile_report(df, columns, probs, **options).values
