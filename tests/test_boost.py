"""Boosted trees against a brute-force version on tables with few distinct values."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessel.operators.boost import BoostModel, HistogramBoost, chance
from tessel.operators.models import LabelStats, Spec
from tessel.session import new_path, shared_dir


def fixture(spark, n=300, seed=3):
    shared_dir(spark)
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 7, n), rng.integers(0, 2, n), rng.integers(-3, 3, n) * 0.5, np.ones(n)]).astype(float)
    y = 3 + 2 * x[:, 0] * x[:, 1] - x[:, 2] ** 2 + np.round(rng.normal(size=n), 3)
    rows = [(i, float(b), Vectors.sparse(4, [(j, v) for j, v in enumerate(a) if v]) if i % 3 else Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["id", "y", "features"]).repartition(5)


def score(g, n, s):
    return max(abs(g.sum()) - s["l1"], 0) ** 2 / (n + s["l2"]) if n else 0.0


def leaf(g, s):
    return -np.sign(g.sum()) * max(abs(g.sum()) - s["l1"], 0) / (len(g) + s["l2"]) * s["rate"] if len(g) else 0.0


def gains(x, g, at, s):
    """Gain of every allowed cut of one node."""
    out = {}
    for j in range(x.shape[1]):
        for c in np.unique(x[:, j])[:-1]:
            low = x[at, j] <= c
            a, b = g[at][low], g[at][~low]
            out[j, c] = (0.5 * (score(a, len(a), s) + score(b, len(b), s) - score(g[at], len(at), s)), min(len(a), len(b)) >= s["min_rows"])
    return out


def brute(x, y, s):
    """Margins after boosting, level by level."""
    margin = np.full(len(y), y.mean())
    for _ in range(s["rounds"]):
        g = margin - y
        nodes = [np.arange(len(y))]
        final = []
        for level in range(s["depth"]):
            found = [gains(x, g, at, s) for at in nodes]
            if s.get("symmetric"):
                total = {k: np.float32(sum(np.float32(f[k][0]) for f in found)) for k in found[0] if any(f[k][1] for f in found)}
                top = max(total, key=lambda k: (total[k], -k[0], -k[1])) if total else None
                picks = [top if top and total[top] > s["min_gain"] else None] * len(nodes)
            else:
                picks = []
                for f in found:
                    ok = {k: np.float32(v) for k, (v, fits) in f.items() if fits and v > s["min_gain"]}
                    picks.append(max(ok, key=lambda k: (ok[k], -k[0], -k[1])) if ok else None)
                if s.get("leaves"):
                    order = sorted((i for i, p in enumerate(picks) if p), key=lambda i: (-np.float32(found[i][picks[i]][0]), i))
                    for i in order[max(0, s["leaves"] - len(nodes) - len(final)):]:
                        picks[i] = None
            later = []
            for at, p in zip(nodes, picks):
                if p is None:
                    final.append(at)
                else:
                    later += [at[x[at, p[0]] <= p[1]], at[x[at, p[0]] > p[1]]]
            nodes = later
            if not nodes:
                break
        for at in final + nodes:
            margin[at] += leaf(g[at], s)
    return margin


BASE = {"rounds": 4, "rate": 0.4, "depth": 3, "l1": 0.0, "l2": 1.0, "min_gain": 0.0, "min_rows": 1}


@pytest.mark.parametrize("change", [{}, {"l1": 6.0, "l2": 20.0}, {"min_gain": 15.0, "min_rows": 12}, {"symmetric": True, "l2": 3.0},
                                    {"leaves": 5}])
def test_equals_brute_force(spark, change):
    s = {**BASE, **change}
    x, y, df = fixture(spark)
    model = HistogramBoost({**s, "label": "y", "features": "features", "key": ["id"]}).fit(df)
    got = {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}
    np.testing.assert_allclose([got[i] for i in range(len(y))], brute(x, y, s), rtol=1e-9)
    if "symmetric" in change:
        for t in model.trees:
            assert len(t.slot) == 2 ** (t.depth + 1) - 1 and len({(a, b) for a, b in zip(t.slot, t.cut) if a >= 0}) <= t.depth
    if "leaves" in change:
        assert max(t.slot.count(-1) for t in model.trees) <= 5


def test_penalties_change_leaves_as_the_closed_form_says(spark):
    rows = [(i, float(y), Vectors.dense([float(i >= 3)])) for i, y in enumerate([1, 2, 3, 10, 11, 15])]
    df = spark.createDataFrame(rows, ["id", "y", "features"])
    for l1, l2 in ((0.0, 0.0), (0.0, 4.0), (5.0, 2.0)):
        model = HistogramBoost({"label": "y", "rounds": 1, "rate": 1.0, "depth": 1, "l1": l1, "l2": l2, "features": "features", "key": ["id"]}).fit(df)
        t = model.trees[0]
        # sums of gradients are 15 left of the cut and -15 right of it
        assert [t.value[t.kid[0]], t.value[t.kid[0] + 1]] == pytest.approx([-(15 - l1) / (3 + l2), (15 - l1) / (3 + l2)])


def test_patience_keeps_the_best_round(spark):
    x, y, df = fixture(spark, 200, 5)
    noise = np.random.default_rng(8).normal(size=200) * 12
    df = spark.createDataFrame([(i, float(y[i] + noise[i]), Vectors.dense(x[i])) for i in range(200)], ["id", "y", "features"])
    s = {"label": "y", "features": "features", "key": ["id"], "rounds": 24, "rate": 0.5, "depth": 4, "held": 0.3, "l2": 0.0}
    whole = HistogramBoost(s).fit(df)
    part = HistogramBoost({**s, "patience": 3}).fit(df)
    errors = whole.getOrDefault("state")["errors"]
    assert len(errors) == 24 and whole.getNumTrees == int(np.argmin(errors)) + 1
    best = 0
    for turn in range(1, 24):  # the rule, read off the errors of the run that did not stop
        if errors[turn] < errors[best]:
            best = turn
        elif turn - best >= 3:
            break
    seen = part.getOrDefault("state")["errors"]
    assert part.getNumTrees == best + 1 and len(seen) == turn + 1 < 24
    np.testing.assert_allclose(seen, errors[:turn + 1])


def test_column_and_row_draws(spark):
    x, y, df = fixture(spark)
    s = {"label": "y", "features": "features", "key": ["id"], "rounds": 8, "depth": 2, "columns": 0.4, "subsample": 0.5}
    first, again = (HistogramBoost(s).fit(d) for d in (df, df.repartition(2)))
    assert [t.slot for t in first.trees] == [t.slot for t in again.trees]
    assert all(len({i for i in t.slot if i >= 0}) <= 1 for t in first.trees) and len({i for t in first.trees for i in t.slot if i >= 0}) == 3
    share = (chance(np.arange(100_000) * 977, 4) < 0.5).mean()
    assert abs(share - 0.5) < 0.01


def test_saved_model_and_edges(spark):
    x, y, df = fixture(spark, 60)
    model = Spec("xgb", {"n_estimators": 3}).build(LabelStats.of(df, "y", 4, key=("id",)), "y").fit(df)
    path = new_path(spark, "saved")
    PipelineModel(stages=[model]).write().save(path)
    back = PipelineModel.load(path)
    a, b = (m.transform(df).orderBy("id").select("prediction").toPandas() for m in (model, back))
    assert a.equals(b) and isinstance(back.stages[0], BoostModel)
    # no rows, null labels only, and features that never vary give the base value and no tree
    for rows, base in ((df.limit(0), 0.0), (df.selectExpr("id", "cast(null as double) as y", "features"), 0.0)):
        empty = HistogramBoost({"label": "y", "features": "features", "key": ["id"]}).fit(rows)
        assert empty.getNumTrees == 0 and empty.transform(df).first()["prediction"] == base
    with pytest.raises(ValueError):
        HistogramBoost({"label": "y", "bins": 300}).fit(df)
    flat = spark.createDataFrame([(i, float(i), Vectors.dense([2.0])) for i in range(4)], ["id", "y", "features"])
    assert HistogramBoost({"label": "y", "features": "features"}).fit(flat).transform(flat).first()["prediction"] == 1.5


def test_binned_rows_are_dealt_out(spark, monkeypatch):
    """Levels of a tree read the binned rows with more than one task, also if the input has one."""
    from tessel.operators import boost

    seen = []
    kept = boost.grow
    monkeypatch.setattr(boost, "grow", lambda rows, *rest: seen.append(len(rows.inputFiles())) or kept(rows, *rest))
    df = spark.range(300_000).coalesce(1).select("id", F.rand(1).alias("y"), array_to_vector(F.array(F.rand(2), F.rand(3))).alias("features"))
    HistogramBoost({"label": "y", "rounds": 1, "depth": 1, "key": ["id"]}).fit(df)
    assert seen[0] > 1


def test_sums_meet_in_tasks_or_on_the_driver(spark, monkeypatch):
    """The same trees whether the driver adds the sums of a level up or tasks do, and with many rows a record."""
    from tessel.operators import boost

    x, y, df = fixture(spark, 120)
    s = {**BASE, "rounds": 2, "label": "y", "features": "features", "key": ["id"], "subsample": 0.7}
    for symmetric in (False, True):
        seen = []
        for sent, added, record in ((boost.SENT, boost.ADDED, boost.RECORD), (0, 4, 8192), (0, 256, 1)):
            monkeypatch.setattr(boost, "SENT", sent)
            monkeypatch.setattr(boost, "ADDED", added)
            monkeypatch.setattr(boost, "RECORD", record)
            seen.append([(t.slot, t.cut) for t in HistogramBoost({**s, "symmetric": symmetric}).fit(df).trees])
        assert seen[0] == seen[1] == seen[2] and seen[0][0][0][0] >= 0


def test_rows_share_records(spark, monkeypatch):
    """Rows go to Python in records of many, and the rows come in one table of bytes."""
    from tessel.operators import boost

    seen = []
    kept = boost.grow
    monkeypatch.setattr(boost, "grow", lambda rows, *rest: seen.append((rows.count(), rows.agg(F.sum(F.length("y")) / 8).first()[0])) or kept(rows, *rest))
    df = spark.range(20_000).select("id", F.rand(1).alias("y"), array_to_vector(F.array(F.rand(2), F.rand(3))).alias("features"))
    HistogramBoost({"label": "y", "rounds": 1, "depth": 1, "key": ["id"]}).fit(df)
    assert seen[0][1] == 20_000 and seen[0][0] < 20_000 / 50
