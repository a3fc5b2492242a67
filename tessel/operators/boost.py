"""Boosted trees for squared loss from histograms of gradients, with penalties, symmetric trees and patience.

Values become bin numbers once, and rows are kept as bytes with the margin of the trees so far, some hundred of
them in a record, since a record costs Spark far more on its way to Python than its bytes do. A level of a
tree is one job: tasks sum gradients and rows by node, slot and bin. The driver adds up sums of a few MB; larger
ones are shuffled to tasks that add the sums of their slots up and find the best cuts, and the driver gets one cut
a node from each of them. Margins are
written again after every BLOCK trees, so a task never replays more than that many, and lost executors lose
nothing but their running tasks. The errors of all prefixes of a block on the held-out rows come from one pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.gram import dense_blocks, places
from tessel.functions.hashing import hash_int, row_hash
from tessel.functions.nulls import col
from tessel.session import discard, new_path, reach, spread

#: Trees between two writes of the margins.
BLOCK = 8
#: Tasks that add up the sums of a level and find its cuts, at most, and nodes times slots for each of them.
ADDERS, ADDED = 64, 256
#: Bytes of sums of all tasks that the driver adds up itself, at most: a second stage costs as much as a small level.
SENT = 16 << 20
#: Bytes of a record of rows, and numbers of a block of rows that is summed at once.
RECORD, CHUNK = 8192, 1 << 18
#: Digits of the row hash that draws use.
DIGITS = 15
ROWS = "draw binary, y binary, margin binary, bins binary"


@dataclass
class Settings:
    """``l1`` and ``l2`` act on leaf weights: ``-soft(G, l1) / (rows + l2)``, scaled by ``rate``.

    ``leaves`` bounds the leaves of a tree (the best cuts of a level come first); ``symmetric`` trees have one cut
    a level. With ``held`` above 0 that share of the rows is held out; boosting ends after ``patience`` rounds
    without an error below ``(1 - tolerance)`` times the best, and the best round is kept.
    """

    label: str = "label"
    features: str = "features"
    prediction: str = "prediction"
    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    leaves: int | None = None
    subsample: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_rows: float = 1.0
    symmetric: bool = False
    held: float = 0.0
    patience: int = 0
    tolerance: float = 0.0
    bins: int = 64
    seed: int = 42
    key: list[str] = field(default_factory=list)


@dataclass
class Tree:
    """Node i goes to ``kid[i]`` if its bin in ``slot[i]`` is at most ``cut[i]``, else to the next; slot -1 is a leaf."""

    slot: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    kid: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    depth: int = 0

    def add(self, value: float) -> int:
        for held, x in ((self.slot, -1), (self.cut, 0), (self.kid, 0), (self.value, value)):
            held.append(x)
        return len(self.slot) - 1

    def reached(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bin numbers ends in."""
        # a leaf leads back to itself: no bin lies above 255
        slot = np.maximum(np.array(self.slot, np.int64), 0)
        leaf = np.array(self.slot) < 0
        cut = np.where(leaf, 255, self.cut)
        kid = np.where(leaf, np.arange(len(leaf)), self.kid)
        at = np.zeros(len(bins), np.int64)
        if not self.depth:
            return at
        flat, first = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(self.depth):
            at = kid.take(at) + (flat.take(first + slot.take(at)) > cut.take(at))
        return at

    def of(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.reached(bins)]


def cut_points(rows: DataFrame, features: str, width: int, bins: int) -> list[list[float]]:
    """At most ``bins`` cuts a slot: quantiles of its values other than zero, its smallest value, and zero.

    A cut at the largest value parts nothing and is left out, so constant slots have none.
    """
    v = F.unwrap_udt(col(features))
    pairs = F.when(v["type"] == 0, F.arrays_zip(v["indices"].alias("at"), v["values"].alias("x"))).otherwise(
        F.transform(v["values"], lambda x, i: F.struct(i.alias("at"), x.alias("x"))))
    one = F.array(F.struct(F.lit(-1).alias("at"), F.lit(1.0).alias("x")))  # counts the rows in the same pass
    long = rows.select(F.explode(F.concat(one, pairs)).alias("p")).select(F.col("p.at").alias("at"), F.col("p.x").alias("x")).where("x <> 0 and not isnan(x)")
    probs = [(i + 1) / bins for i in range(bins - 1)]
    got = long.groupBy("at").agg(F.percentile_approx("x", probs, 50 * bins).alias("q"), F.min("x").alias("low"), F.max("x").alias("high"),
                                 F.count("*").alias("n")).collect()
    cuts: list[list[float]] = [[] for _ in range(width)]
    n = next((r["n"] for r in got if r["at"] < 0), 0)
    for r in got:
        if r["at"] < 0:
            continue
        zero = r["n"] < n
        top = max(r["high"], 0.0) if zero else r["high"]
        cuts[r["at"]] = sorted({x for x in [*r["q"], r["low"], *([0.0] if zero else [])] if x < top})
    return cuts


def binned(x: np.ndarray, cuts: list[list[float]], live: list[int]) -> np.ndarray:
    """Number of cuts below each value; a missing value lies below all."""
    x = np.where(np.isnan(x), -np.inf, x)
    out = np.empty((len(x), len(live)), np.uint8)
    for i, s in enumerate(live):
        out[:, i] = np.searchsorted(cuts[s], x[:, s], side="left")
    return out


def _bytes(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as one binary value each."""
    n, width = rows.shape
    return _split(rows, np.arange(n + 1) * width)


def _split(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that end at the bytes ``ends[1:]`` of ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _held(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and where its values end."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)), ends - ends[0]


def _recorded(draw: np.ndarray, y: np.ndarray, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    """Records of some RECORD bytes."""
    size = max(1, RECORD // (24 + bins.shape[1]))
    ends = np.minimum(np.arange(-(-len(draw) // size) + 1) * size, len(draw))
    return pa.RecordBatch.from_arrays([_split(x, ends * (x.nbytes // max(len(draw), 1))) for x in (draw, y, margin, bins)], names=["draw", "y", "margin", "bins"])


def _rows(batch: pa.RecordBatch, width: int):
    """``(draw, y, margin, bins)`` of the rows of all records, a block at a time."""
    draw, y, margin = (_held(batch.column(i))[0].view(kind) for i, kind in enumerate((np.int64, np.float64, np.float64)))
    bins = _held(batch.column(3))[0].reshape(len(draw), width)
    size = max(1, CHUNK // max(width, 1))
    for a in range(0, len(draw), size):
        yield draw[a:a + size], y[a:a + size], margin[a:a + size], bins[a:a + size]


def _encode(width: int, cuts: list[list[float]], live: list[int]):
    def run(batches):
        for batch in batches:
            for draw, block in dense_blocks(batch, width):
                yield _recorded(draw, np.ascontiguousarray(block[:, width]), np.zeros(len(block)), binned(block[:, :width], cuts, live))
    return run


def chance(draw: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each row hash, another one for each salt."""
    x = draw.astype(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / 2**53


def _histogram(s: Settings, width: int, sizes: list[int], done: list[Tree], tree: Tree, active: list[int], slots: list[int], turn: int, shift: float):
    """Sums by active node, slot and bin over the rows of this task that train this tree; a row a node and slot."""
    def run(batches):
        place = np.full(len(tree.slot), -1)
        place[active] = np.arange(len(active))
        own = np.array([sizes[i] for i in slots])
        first = np.cumsum(own) - own
        cells = int(own.sum())
        sums, counts = np.zeros(len(active) * cells), np.zeros(len(active) * cells, np.int64)
        whole = slots == list(range(width))
        for draw, y, margin, bins in (rows for batch in batches for rows in _rows(batch, width)):
            at = place[tree.reached(bins)]
            use = (at >= 0) & (chance(draw, turn + 1) < s.subsample)
            if s.held:
                use &= chance(draw, 0) >= s.held
            if not use.any():
                continue
            bins, at = bins[use], at[use]
            g = (margin[use] + shift + sum(t.of(bins) for t in done)) - y[use]
            code = ((bins if whole else bins[:, slots]) + (at * cells)[:, None] + first).reshape(-1)
            sums += np.bincount(code, np.repeat(g, len(slots)), len(sums))
            counts += np.bincount(code, minlength=len(counts))
        if not counts.any():
            return
        sums, counts = sums.reshape(len(active), cells), counts.reshape(len(active), cells)
        for i, a, n in zip(slots, first.tolist(), own.tolist()):
            on = np.flatnonzero(counts[:, a:a + n].any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(on), i), pa.int32()), pa.array(on, pa.int32()), _bytes(np.ascontiguousarray(sums[on, a:a + n]).view(np.uint8)),
                 _bytes(np.ascontiguousarray(counts[on, a:a + n]).view(np.uint8))], names=["slot", "place", "g", "n"])
    return run


def _score(g: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """What a leaf of these sums takes off the loss, twice; an empty one takes nothing."""
    soft = np.maximum(np.abs(g) - s.l1, 0.0)
    return np.where(n > 0, soft * soft / np.where(n > 0, n + s.l2, 1.0), 0.0)


def weight(g: float, n: float, s: Settings) -> float:
    soft = max(abs(g) - s.l1, 0.0)
    return -float(np.sign(g)) * soft / (n + s.l2) * s.rate if n else 0.0


CUTS = "place int, slot int, bin int, gain float, gl double, nl long, g double, n long"


def _added(s: Settings, sizes: list[int], places: int):
    """The best cut of each active node over the slots of this task, slot -1 if none is allowed; or, if trees are
    symmetric, the sides of all nodes at the one best cut.

    Gains are compared as floats, so that sums added in another order pick the same cut; ties go to the first
    slot, then the first bin. A node without an allowed cut has none but keeps its sums.
    """
    def run(batches):
        sums: dict[int, tuple] = {}
        for batch in batches:
            slot, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in np.unique(slot).tolist():
                mine = np.flatnonzero(slot == i)
                g, n = (batch.column(j).take(pa.array(mine)) for j in (2, 3))
                held = sums.setdefault(i, (np.zeros((places, sizes[i])), np.zeros((places, sizes[i]), np.int64)))
                for part, total, kind in ((g, held[0], np.float64), (n, held[1], np.int64)):
                    np.add.at(total, place[mine], np.frombuffer(b"".join(part.to_pylist()), kind).reshape(len(mine), sizes[i]))
        best = None
        for i in sorted(sums):
            cells, rows = sums[i]
            gl, nl = np.cumsum(cells, axis=1), np.cumsum(rows, axis=1)
            g, n = gl[:, -1:], nl[:, -1:]
            gain = (0.5 * (_score(gl, nl, s) + _score(g - gl, n - nl, s) - _score(g, n, s))).astype(np.float32)
            fits = (nl >= s.min_rows) & (n - nl >= s.min_rows)
            fits[:, -1] = False
            if s.symmetric:
                gain, fits = gain.sum(axis=0, dtype=np.float64).astype(np.float32)[None, :], fits.any(axis=0)[None, :]
            gain = np.where(fits & (gain > s.min_gain), gain, -np.inf)
            cut = gain.argmax(axis=1)
            top = np.take_along_axis(gain, cut[:, None], 1)[:, 0]
            if s.symmetric:
                cut, top = np.repeat(cut, places), np.repeat(top, places)
            at = np.arange(places)
            found = [np.where(np.isfinite(top), i, -1), np.where(np.isfinite(top), cut, 0), top, gl[at, cut], nl[at, cut], g[:, 0], n[:, 0]]
            better = np.ones(places, bool) if best is None else top > best[2]
            best = found if best is None else [np.where(better, x, y) for x, y in zip(found, best)]
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([np.arange(places), *best], (
                pa.int32(), pa.int32(), pa.int32(), pa.float32(), pa.float64(), pa.int64(), pa.float64(), pa.int64()))],
                names=["place", "slot", "bin", "gain", "gl", "nl", "g", "n"])
    return run


def _cuts(hist: DataFrame, s: Settings, sizes: list[int], slots: list[int], places: int, parts: int | None) -> dict[int, dict]:
    """The best cut by place among the active nodes, from the best ones of all tasks; ``parts`` tasks make ``hist``."""
    add = _added(s, sizes, places)
    if parts is not None and parts * places * sum(sizes[i] for i in slots) * 16 <= SENT:
        return {r["place"]: r for batch in add(hist.toArrow().to_batches()) for r in batch.to_pylist()}
    cuts: dict[int, dict] = {}
    for r in hist.repartition(min(len(slots), -(-places * len(slots) // ADDED), ADDERS), "slot").mapInArrow(add, CUTS).collect():
        old = cuts.get(r["place"])
        if old is None or (r["slot"] >= 0, r["gain"], -r["slot"]) > (old["slot"] >= 0, old["gain"], -old["slot"]):
            cuts[r["place"]] = r
    return cuts


def grow(rows: DataFrame, s: Settings, width: int, sizes: list[int], done: list[Tree], turn: int, shift: float = 0.0,
         parts: int | None = None) -> Tree:
    """One tree more, a job a level; ``shift`` is missing in the margins, ``parts`` tasks read the rows, if known."""
    tree = Tree()
    tree.add(0.0)
    rng = np.random.default_rng([s.seed, turn])
    slots = sorted(rng.choice(width, max(1, int(s.columns * width)), replace=False).tolist()) if width else []
    active, leaves = [0], 1
    for level in range(s.depth):
        if not active or not slots:
            break
        hist = rows.mapInArrow(_histogram(s, width, sizes, done, tree, active, slots, turn, shift), "slot int, place int, g binary, n binary")
        found = _cuts(hist, s, sizes, slots, len(active), parts)
        if level == 0 and found and not s.symmetric:
            tree.value[0] = weight(found[0]["g"], found[0]["n"], s)
        if s.symmetric:
            picked = [(active[p], found[p]) for p in sorted(found) if found[p]["slot"] >= 0]
        else:
            picked = [(node, c) for _, node, c in sorted((-c["gain"], active[p], c) for p, c in found.items() if c["slot"] >= 0)]
            picked = picked if s.leaves is None else picked[:max(0, s.leaves - leaves)]
        active = []
        for node, c in picked:
            tree.slot[node], tree.cut[node], tree.kid[node] = c["slot"], c["bin"], len(tree.slot)
            active.append(tree.add(weight(c["gl"], c["nl"], s)))
            active.append(tree.add(weight(c["g"] - c["gl"], c["n"] - c["nl"], s)))
        leaves += len(picked)
        tree.depth = level + 1 if picked else tree.depth
        if s.leaves is not None and leaves >= s.leaves:
            break
    return tree


def prefix_errors(rows: DataFrame, s: Settings, width: int, trees: list[Tree], shift: float = 0.0) -> list[float] | None:
    """Mean squared error on the held-out rows after each of the trees, from one pass; None without such rows."""
    def run(batches):
        sums, n = np.zeros(len(trees)), 0
        for draw, y, margin, bins in (rows for batch in batches for rows in _rows(batch, width)):
            out = chance(draw, 0) < s.held
            y, margin, bins = y[out], margin[out] + shift, bins[out]
            n += len(y)
            for i, t in enumerate(trees):
                margin += t.of(bins)
                sums[i] += ((margin - y) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees)), pa.int32()), pa.array(sums), pa.array(np.full(len(trees), n))],
                                         names=["i", "e", "n"])
    got = rows.mapInArrow(run, "i int, e double, n long").groupBy("i").agg(F.sum("e").alias("e"), F.sum("n").alias("n")).orderBy("i").collect()
    return [r["e"] / r["n"] for r in got] if got and got[0]["n"] else None


def _mean(rows: DataFrame, s: Settings) -> float:
    """Mean label of the rows that are not held out; 0 without any."""
    def run(batches):
        total, n = 0.0, 0
        for batch in batches:
            draw, y = _held(batch.column(0))[0].view(np.int64), _held(batch.column(1))[0].view(np.float64)
            use = chance(draw, 0) >= s.held
            total, n = total + float(y[use].sum()), n + int(use.sum())
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], names=["t", "n"])
    got = rows.mapInArrow(run, "t double, n long").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    return got["t"] / got["n"] if got["n"] else 0.0


def _moved(width: int, trees: list[Tree], shift: float):
    def run(batches):
        for batch in batches:
            moved = [margin + shift + sum(t.of(bins) for t in trees) for _, _, margin, bins in _rows(batch, width)]
            if moved:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _split(np.concatenate(moved), _held(batch.column(1))[1]), batch.column(3)],
                                                 names=["draw", "y", "margin", "bins"])
    return run


class HistogramBoost(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosting by the module's method. Rows without a label do not count; all draws follow the row key's hash."""

    settings = Param(Params._dummy(), "settings", "fields of Settings", TypeConverters.identity)

    def __init__(self, settings: dict | None = None):
        super().__init__()
        self._set(settings=settings or {})

    def setPredictionCol(self, name: str) -> "HistogramBoost":  # noqa: N802 - as Spark's own estimators
        return self._set(settings={**self.getOrDefault("settings"), "prediction": name})

    def _fit(self, df):
        s = Settings(**self.getOrDefault("settings"))
        if not 2 <= s.bins <= 250:
            raise ValueError(f"bins must lie between 2 and 250, for one byte a value; got {s.bins}")
        spark = df.sparkSession
        reach(spark)
        known = df.where(col(s.label).isNotNull())
        first = known.select(F.size(vector_to_array(col(s.features))).alias("w")).first()
        width = first["w"] if first else 0
        name = f"boost-{s.seed}"
        hashed = row_hash(s.key, name) if s.key else F.md5(F.concat(F.lit(f"{name}:"), vector_to_array(col(s.features)).cast("string")))
        v = F.unwrap_udt(col(s.features))
        rows = known.select(hash_int(hashed, DIGITS).alias("draw"), col(s.label).cast("double").alias("y"), v.alias("v")).select(
            "draw", "y", *places())
        cuts = cut_points(known, s.features, width, s.bins)
        live = [i for i, c in enumerate(cuts) if c]
        sizes = [len(cuts[i]) + 1 for i in live]

        def put(made: DataFrame) -> tuple[DataFrame, str, int]:
            path = new_path(spark, "boost")
            made.write.option("compression", "zstd").parquet(path)
            table = spark.read.schema(ROWS).parquet(path)
            return table, path, table.rdd.getNumPartitions()

        table, path, parts = put(spread(rows.mapInArrow(_encode(width, cuts, live), ROWS)))
        shift = base = _mean(table.select("draw", "y"), s)  # not yet in the margins
        trees: list[Tree] = []
        pending: list[Tree] = []
        best, best_error, errors, stop = 0, float("inf"), [], False
        while not stop and len(trees) < s.rounds and live:
            pending.append(grow(table, s, len(live), sizes, pending, len(trees), shift, parts))
            trees.append(pending[-1])
            if len(pending) < BLOCK and len(trees) < s.rounds:
                continue
            found = prefix_errors(table, s, len(live), pending, shift) if s.held else None
            for turn, error in enumerate(found or [], len(trees) - len(pending) + 1):
                errors.append(error)
                if error < best_error * (1 - s.tolerance):
                    best, best_error = turn, error
                elif s.patience and turn - best >= s.patience:
                    stop = True
                    break
            if not stop and len(trees) < s.rounds:
                old = path
                table, path, parts = put(table.mapInArrow(_moved(len(live), pending, shift), ROWS))
                discard(spark, old)
                pending, shift = [], 0.0
        discard(spark, path)
        kept = trees[:best] if best else trees
        return BoostModel({"features": s.features, "prediction": s.prediction, "base": base, "cuts": [cuts[i] for i in live], "live": live,
                           "trees": [[t.slot, t.cut, t.kid, t.value, t.depth] for t in kept], "errors": errors})


class BoostModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Base value, cut points and trees; predicts for batches of rows."""

    state = Param(Params._dummy(), "state", "base, cuts, live, trees, errors, features, prediction", TypeConverters.identity)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    @property
    def trees(self) -> list[Tree]:
        return [Tree(*t) for t in self.getOrDefault("state")["trees"]]

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - as Spark's own models
        return len(self.getOrDefault("state")["trees"])

    def _transform(self, df):
        reach(df.sparkSession)
        s, trees = self.getOrDefault("state"), self.trees

        @F.pandas_udf("double")
        def predict(rows: pd.Series) -> pd.Series:
            if len(rows) == 0:
                return pd.Series([], dtype=float)
            out = np.full(len(rows), s["base"])
            if trees:
                x = np.stack(rows.to_numpy())[:, s["live"]]
                bins = binned(x, s["cuts"], list(range(len(s["live"]))))
                for t in trees:
                    out += t.of(bins)
            return pd.Series(out)

        return df.withColumn(s["prediction"], predict(vector_to_array(col(s["features"]))))
