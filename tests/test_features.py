import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessel.operators import derive as d
from tessel.operators.encode import explode_vector
from tessel.operators.mutual import bin_of, information, joint_counts, level_information, mutual_info, top_features
from tessel.plans.features import FeaturePlan, feature_stages, fit_features
from tessel.sources.sinks import load_model, run_report, save_model, score, write_report


@pytest.fixture(scope="module")
def table(spark):
    """600 rows with gaps, outliers, an infinity, a constant, an empty column and a rare level."""
    i = F.col("id")
    return spark.range(600).select(
        i, F.when(i % 7 != 0, (i * 13 % 101).cast("double")).alias("a"),
        F.when(i == 5, 1e6).otherwise((i * 7 % 50).cast("double")).alias("b"),
        F.when(i == 9, float("inf")).otherwise(3.0).alias("steady"),
        F.lit(2.0).alias("flat"), F.lit(None).cast("double").alias("empty"),
        F.when(i % 5 == 0, None).when(i < 12, "rare").otherwise(F.concat(F.lit("c"), (i % 3).cast("string"))).alias("c"),
        F.when(i % 11 == 0, "odd").when(i % 2 == 0, "lo").otherwise("hi").alias("o"),
        (i % 2 == 0).alias("truth"),
        (i * 13 % 101 + F.when(i % 2 == 0, 50).otherwise(0)).cast("double").alias("y"))


def plan(**more):
    return FeaturePlan(key=["id"], target="y", ordinals={"o": ["lo", "hi"]},
                       recipes=[d.product("ab", "a", "b"), d.winsorize("b_cap", "b", 0.9)], **more)


def vectors(fitted, df):
    made = fitted.transform(df).select("id", vector_to_array("features").alias("v"))
    return {r["id"]: r["v"] for r in made.collect()}


def test_single_stages_and_fused_fit_agree(table):
    fitted = fit_features(table, plan(variance_threshold=None))
    step = feature_stages(table, plan()).fit(table).transform(table)
    rows = {r["id"]: r for r in step.collect()}
    names = fitted.names
    assert names[-5:] == ["a", "b", "steady", "flat", "ab"] or "b_cap" in names
    for key, v in vectors(fitted, table).items():
        for name, x in zip(names, v):
            if name in ("o", "a", "b", "steady", "flat", "ab", "b_cap"):
                assert math.isclose(x, rows[key][name], rel_tol=1e-9, abs_tol=1e-9), (key, name)
            else:
                assert x == float(rows[key]["c"] == name[2:])


def test_names_and_selection(table):
    fitted = fit_features(table, plan())
    assert fitted.names == ["c_Other", "c_c0", "c_c1", "c_c2", "c_nan", "o", "a", "b", "ab", "b_cap"]
    assert fit_features(table, plan(k_best=3)).names and len(fit_features(table, plan(k_best=3)).names) == 3
    assert len(fit_features(table, plan(k_best=500)).names) == len(fitted.names)


def test_indicators_reach_the_vector_only_when_carried(table):
    more = fit_features(table, plan(carry=("indicators", "target_enc"), target_encode=["c"]))
    added = [n for n in more.names if n.endswith("_was_missing") or n.startswith("TE_")]
    assert set(added) == {"a_was_missing", "ab_was_missing", "o_was_missing", "TE_c"}
    row = dict(zip(more.names, vectors(more, table.where("id = 7"))[7]))
    assert row["a_was_missing"] == 1.0
    plain = fit_features(table, plan(target_encode=["c"]))
    assert not any("was_missing" in n or n.startswith("TE_") for n in plain.names)
    assert len(fit_features(table, plan(carry=("indicators",), k_best=4)).names) == 4


def test_transform_does_not_depend_on_other_rows(table):
    fitted = fit_features(table, plan())
    whole = vectors(fitted, table)
    part = vectors(fitted, table.where("id % 10 = 3"))
    assert part and all(whole[k] == v for k, v in part.items())


def test_partitioning_does_not_matter(table):
    a, b = fit_features(table.coalesce(1), plan(k_best=6)), fit_features(table.repartition(13), plan(k_best=6))
    assert a.names == b.names
    va, vb = vectors(a, table), vectors(b, table)
    assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for k in va for x, y in zip(va[k], vb[k]))


def test_new_rows_with_gaps_and_unseen_levels(spark, table):
    fitted = fit_features(table, plan())
    new = spark.createDataFrame([(1, None, None, None, None, None, "new", "odd", None)],
                                "id bigint, a double, b double, steady double, flat double, empty double, c string, o string, truth boolean")
    v = dict(zip(fitted.names, vectors(fitted, new)[1]))
    assert v["c_Other"] == 1.0 and all(x is not None for x in v.values())


def test_save_and_load(table, tmp_path):
    fitted = fit_features(table, plan(target_encode=["c"]))
    path = save_model({"features": fitted.model}, "features", str(tmp_path))
    name, model = load_model(path)
    assert name == "features"
    back = model.transform(table).select("id", vector_to_array("features").alias("v"))
    assert {r["id"]: r["v"] for r in back.collect()} == vectors(fitted, table)


def test_transform_is_a_projection(table):
    text = fit_features(table, plan()).transform(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def brute_mi(pairs):
    n = len(pairs)
    out = 0.0
    for p in set(pairs):
        joint = pairs.count(p) / n
        px, py = sum(a == p[0] for a, _ in pairs) / n, sum(b == p[1] for _, b in pairs) / n
        out += joint * math.log(joint / (px * py))
    return out


def test_level_information_against_brute_force(spark):
    rows = [("a", 0), ("a", 0), ("b", 1), ("b", 0), ("c", 2), ("c", 2), ("a", 1), ("b", 1), ("b", 1)]
    df = spark.createDataFrame(rows, "x string, y int")
    counts = joint_counts(df, {"x": F.col("x")}, F.col("y"))
    got = {r["feature"]: r["mi"] for r in level_information(counts).collect()}
    for level in "abc":
        assert math.isclose(got[f"x_{level}"], brute_mi([(x == level, y) for x, y in rows]), abs_tol=1e-12)
    assert math.isclose(information(counts).first()["mi"], brute_mi(rows), abs_tol=1e-12)


def test_mutual_info_ranks_the_informative_column(spark):
    df = spark.range(500).select((F.col("id") % 50).cast("double").alias("good"), F.lit(1.0).alias("flat"),
                                 F.when(F.col("id") % 3 > 0, F.col("id") * 7919 % 500).cast("double").alias("noise"),
                                 (F.col("id") % 50 * 2).cast("double").alias("y"))
    best = top_features(mutual_info(df, ["flat", "good", "noise"], "y"), 1).collect()
    assert [r["feature"] for r in best] == ["good"]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 1.5, 2.0, 3.0, None]], "x double")
    assert [r[0] for r in df.select(bin_of(F.col("x"), [1.0, 2.0])).collect()] == [0, 0, 1, 1, 2, None]


def test_long_form(table):
    fitted = fit_features(table, plan())
    long = explode_vector(fitted.transform(table), ["id"], fitted.names)
    assert long.where("value = 0").count() == 0 and long.select("id").distinct().count() == 600


def test_score_columns(table):
    from tessel.operators.models import LabelStats, Spec
    from pyspark.ml import PipelineModel

    fitted = fit_features(table, plan())
    enc = fitted.transform(table)
    model = Spec("ridge", {}).build(LabelStats.of(enc, "y", len(fitted.names)), "y").fit(enc)
    out = score(PipelineModel(stages=[fitted.model, model]), table.drop("y"), "id")
    assert out.columns == ["id", "prediction"] and out.count() == 600


def test_report_lists_what_was_learned(spark, table, tmp_path):
    report = run_report(fit_features(table, plan()).model, spark)
    stats = {(r["column"], r["stat"]): r["value"] for r in report.collect()}
    assert ("b_cap", "cap") in stats and ("a", "median") in stats and ("o", "mode") in stats
    write_report(report, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == report.count()


def test_nan_in_a_plan_is_missing(spark):
    from tessel.plans.features import FeaturePlan, fit_features

    rows = [(i, float("nan") if i % 10 == 0 else float(i % 7), float(i)) for i in range(200)]
    given = spark.createDataFrame(rows, "id int, a double, y double")
    blank = given.withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    plan = FeaturePlan(key=["id"], target="y", carry=("indicators",))
    one, two = (fit_features(df, plan) for df in (given, blank))
    assert one.names == two.names and any("missing" in n for n in one.names)
    assert [r[0] for r in one.transform(given).orderBy("id").select("features").collect()] == [
        r[0] for r in two.transform(blank).orderBy("id").select("features").collect()]


def test_slots_with_equal_names_stay_apart(spark):
    rows = [(i, float(i % 2), "b_c" if i % 2 else "z", ("c", "d")[i // 2 % 2]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, y double, a string, a_b string")
    plan = FeaturePlan(key=["id"], target="y", min_freq=1, k_best=2)
    assert sorted(fit_features(df, plan).names) == ["a_b_c", "a_z"]
    every = fit_features(df, FeaturePlan(key=["id"], target="y", min_freq=1))
    assert sorted(every.names) == ["a_b_c", "a_b_c", "a_b_d", "a_z"]
    long = explode_vector(every.transform(df), ["id"], every.names)
    assert long.count() == 160 and long.filter("feature = 'a_b_c'").count() == 80
