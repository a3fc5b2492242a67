import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessel.functions.numbering import dense_numbers
from tessel.operators import stages as st
from tessel.operators.encode import explode_vector
from tessel.plans import features
from tessel.plans.features import FeaturePlan, fit_features
from tessel.sources.sinks import load_model, run_report, save_model


def test_numbers_are_dense_in_every_group(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("g"), F.format_string("%05d", F.col("id") * 7919 % 5003).alias("v"))
    rows = dense_numbers(df.repartition(9), "g", "v").collect()
    for g in {r["g"] for r in rows}:
        mine = sorted((r["v"], r["slot"]) for r in rows if r["g"] == g)
        assert [n for _, n in mine] == list(range(len(mine)))


def long_rows(fitted, df, names):
    return sorted((r["id"], r["feature"], round(r["value"], 9)) for r in explode_vector(fitted.transform(df), ["id"], names).collect())


@pytest.fixture(scope="module")
def mixed(spark):
    i = F.col("id")
    return spark.range(900).select(
        i, F.concat(F.lit("a"), (i % 40).cast("string")).alias("a"), F.when(i % 9 > 0, F.concat(F.lit("b"), (i * i % 23).cast("string"))).alias("b"),
        F.when(i % 3 > 0, "Other").otherwise("z").alias("c"), (i % 17).cast("double").alias("x"), (i % 40 + i % 5).cast("double").alias("y"))


@pytest.mark.parametrize("more", [{}, {"k_best": 9}, {"target_encode": ["a", "b"], "carry": ("target_enc",)}, {"variance_threshold": 0.03}, {"variance_threshold": None}])
def test_wide_and_narrow_fits_agree(mixed, monkeypatch, more):
    plan = FeaturePlan(key=["id"], target="y", min_freq=23, **more)
    narrow = fit_features(mixed, plan)
    monkeypatch.setattr(features, "INLINE", 1)
    wide = fit_features(mixed, plan)
    assert wide.wide is not None and sorted(wide.names) == sorted(narrow.names) and wide.width == narrow.width
    new = mixed.withColumn("a", F.when(F.col("id") % 50 == 0, "unseen").otherwise(F.col("a")))
    for df in (mixed, new):
        want = long_rows(narrow, df, narrow.names)
        assert long_rows(wide, df, wide.names) == want
        assert long_rows(wide, df, wide.names_table(df.sparkSession)) == want


def test_wide_model_saves_its_dictionary(spark, mixed, monkeypatch, tmp_path):
    monkeypatch.setattr(features, "INLINE", 1)
    fitted = fit_features(mixed, FeaturePlan(key=["id"], target="y", min_freq=23, target_encode=["a"], carry=("target_enc",)))
    path = save_model({"m": fitted.model}, "m", str(tmp_path))
    _, model = load_model(path)
    slots = next(s for s in model.stages if isinstance(s, st.LevelSlotsModel))
    assert slots.learned["table"].startswith(path)

    def rows(m):
        return {r["id"]: r["v"].tolist() if hasattr(r["v"], "tolist") else list(r["v"]) for r in m.transform(mixed).select("id", vector_to_array("features").alias("v")).collect()}

    assert rows(model) == rows(fitted.model)
    kept = {(r["column"], r["stat"]) for r in run_report(model, spark).where("stat like 'kept:%'").collect()}
    assert {("a", "kept:Other"), ("b", "kept:nan")} <= kept


@pytest.mark.parametrize("stage", [st.RareGroup(columns=["c"], min_freq=2, inline=0), st.TargetEncode(columns=["c"], target="y", inline=0)])
def test_stored_levels_are_part_of_a_saved_stage(spark, tmp_path, stage):
    df = spark.createDataFrame([(i, f"l{i % 5}" if i % 5 else None, float(i)) for i in range(50)], "id int, c string, y double")
    model = PipelineModel(stages=[stage.fit(df)])
    model.write().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert back.stages[0].learned["table"].startswith(str(tmp_path / "m"))
    assert back.transform(df).orderBy("id").collect() == model.transform(df).orderBy("id").collect()
    # and once more, over itself
    back.write().save(str(tmp_path / "again"))
    assert PipelineModel.load(str(tmp_path / "again")).transform(df).count() == 50


def test_a_hundred_and_fifty_thousand_levels(spark):
    n = 150_000
    df = spark.range(2 * n).select("id", F.concat(F.lit("u"), (F.col("id") % n).cast("string")).alias("user"),
                                   F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), (F.col("id") % 10).cast("double").alias("y"))
    fitted = fit_features(df, FeaturePlan(key=["id"], target="y", min_freq=2))
    assert fitted.width == n + 2 and fitted.names_table(spark).count() == n + 2
    v = F.unwrap_udt("features")
    got = fitted.transform(df).select(F.max(v["size"]), F.countDistinct(F.element_at(v["indices"], -1)), F.sum(F.size(v["indices"])), F.min(F.size(v["indices"]))).first()
    assert tuple(got) == (n + 2, n, 4 * n, 2)
    hot = st.OneHot(columns=["user"], outputCol="hot").fit(df)
    assert hot.transform(df.limit(5)).select(F.unwrap_udt("hot")["size"]).first()[0] == n


def test_null_and_unknown_levels_set_no_slot(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, None, None)], "id int, a string, e string")
    model = st.OneHot(columns=["a", "e"], outputCol="hot").fit(df)
    new = spark.createDataFrame([(1, "a", "q"), (2, "z", None), (3, None, "b"), (4, "b", "x")], "id int, a string, e string")
    assert [list(r[0]) for r in model.transform(new).orderBy("id").select(vector_to_array("hot")).collect()] == [[1, 0], [0, 0], [0, 0], [0, 1]]
    assert model.transform(new).columns == ["id", "a", "e", "hot"]
