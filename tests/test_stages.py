import math

import pytest
from pyspark.sql import functions as F

from tessel.operators import derive as d
from tessel.operators import stages as st
from tessel.operators.encode import HOT, one_hot
from tessel.operators.roles import infer_roles

NAN, INF = float("nan"), float("inf")


def column(df, c):
    return [r[c] for r in df.orderBy("id").collect()]


def fit(stage, df):
    return stage.fit(df).transform(df)


def test_sums_differ_on_missing(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 2.0)], "id int, a double, b double")
    made = d.derive(df, [d.weighted_sum("safe", {"a": 1, "b": 0.5}), d.strict_sum("strict", ["a", "b", "absent"])])
    assert column(made, "safe") == [1.0, 2.0]
    assert column(made, "strict") == [None, 3.0]


def test_flags_and_ratio_on_missing(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, None, 1), (4, 5, None)], "id int, a int, b int")
    made = d.derive(df, [d.differs("ne", "a", "b"), d.above("up", "a", 1), d.ratio("r", "a", "b"),
                         d.ratio("over_absent", "a", "none"), d.ratio("absent_over", "none", "b")])
    assert column(made, "ne") == [0, 1, 1, 1]
    assert column(made, "up") == [0, 0, 0, 1]
    assert column(made, "r") == [1.0, 0.5, None, None]
    assert column(made, "over_absent") == [1.0, 1.0, None, 5.0]
    assert column(made, "absent_over") == [0.0, 0.0, 0.0, None]


def test_optional_recipes_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "id int")
    made = d.derive(df, [d.cycle("m", "month", 12), d.cross("x", "a", "b"), d.product("p", "a", "b"),
                         d.winsorize("w", "a")])
    assert made.columns == ["id"]


def test_cross_writes_missing_as_text(spark):
    df = spark.createDataFrame([(1, None, "b")], "id int, a string, b string")
    assert column(d.derive(df, [d.cross("x", "a", "b")]), "x") == ["nan|b"]


def test_house_preset(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 50.0, None, 2, 1, 2000, 1990, 1995, 6, "N", "T", 7, 1000.0, 3, 8000.0),
         (2, 100.0, 50.0, 20.0, 1, 0, 2010, 2010, 2010, 12, None, "T", 5, None, 0, 900.0)],
        "Id int, TotalBsmtSF double, `1stFlrSF` double, `2ndFlrSF` double, FullBath int, HalfBath int, YrSold int, "
        "YearBuilt int, YearRemodAdd int, MoSold int, Neighborhood string, BldgType string, OverallQual int, "
        "GrLivArea double, BedroomAbvGr int, LotArea double")
    rows = st.Derive(recipes=d.HOUSE_SALES).fit(df).transform(df).orderBy("Id").collect()
    a, b = rows
    assert (a["TotalSF"], a["TotalBath"], a["HouseAge"], a["RemodAge"], a["GarageAge"]) == (150.0, 2.5, 10.0, 5.0, None)
    assert (a["IsRemodeled"], b["IsRemodeled"], a["Has2ndFlr"], b["Has2ndFlr"]) == (1, 0, 0, 1)
    assert a["TotalPorchSF"] == 0.0 and a["BathPerBedroom"] == 2.5 / 3 and b["BathPerBedroom"] == 1.0
    assert a["RoomsPerArea"] == 0.0 and a["LotAreaRatio"] == 8.0 and b["LotAreaRatio"] is None
    assert math.isclose(a["MoSold_sin"], 0.0, abs_tol=1e-12) and math.isclose(a["MoSold_cos"], -1.0)
    assert (a["Neighborhood_BldgType"], b["Neighborhood_BldgType"]) == ("N|T", "nan|T")
    assert math.isclose(a["Ln_TotalSF"], math.log(151))
    assert (a["IQ_OQ_GrLiv"], b["IQ_OQ_GrLiv"], a["IQ_OQ_TotalSF"]) == (7000.0, None, 1050.0)
    assert math.isclose(a["LotArea_clip"], 900 + 0.99 * 7100) and b["LotArea_clip"] == 900.0


def test_winsorize_learns_when_fitting_unless_told_otherwise(spark):
    train = spark.createDataFrame([(i, float(i)) for i in range(101)], "id int, a double")
    other = spark.createDataFrame([(1, 1000.0), (2, 500.0)], "id int, a double")
    once = st.Derive(recipes=[d.winsorize("w", "a", 0.5)]).fit(train)
    assert column(once.transform(other), "w") == [50.0, 50.0]
    each = st.Derive(recipes=[d.winsorize("w", "a", 0.5, per_batch=True)]).fit(train)
    assert column(each.transform(other), "w") == [750.0, 500.0]


def test_ordinal_levels(spark):
    df = spark.createDataFrame([(1, "lo"), (2, "hi"), (3, "odd"), (4, None)], "id int, a string")
    assert column(st.OrdinalMap(mapping={"a": ["lo", "hi"], "b": ["x"]}).transform(df), "a") == [1.0, 2.0, None, None]
    assert column(st.OrdinalMap(mapping={"a": {"lo": -1}}).transform(df), "a") == [-1.0, None, None, None]


def test_flags_only_for_columns_missing_at_fit(spark):
    train = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 2.0)], "id int, a double, b double")
    new = spark.createDataFrame([(1, None, None)], "id int, a double, b double")
    model = st.MissingFlags(exclude=["id"]).fit(train)
    assert model.transform(new).columns == ["id", "a", "b", "a_was_missing"]
    assert column(model.transform(new), "a_was_missing") == [1]


@pytest.mark.parametrize("inline", [100, 0])
def test_rare_levels(spark, inline):
    """Inclusive threshold, missing is a level, unseen becomes Other; same result from a stored table."""
    values = ["a"] * 3 + ["b"] * 2 + ["c"] + [None] * 2
    df = spark.createDataFrame(list(enumerate(values)), "id int, a string")
    model = st.RareGroup(columns=["a"], min_freq=2, inline=inline).fit(df)
    assert ("table" in model.learned) == (inline == 0)
    assert column(model.transform(df), "a") == ["a"] * 3 + ["b"] * 2 + ["Other"] + ["nan"] * 2
    assert column(model.transform(spark.createDataFrame([(1, "z")], "id int, a string")), "a") == ["Other"]


@pytest.mark.parametrize("inline", [100, 0])
def test_target_encoding(spark, inline):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", 5.0), (4, None, 7.0)], "id int, a string, y double")
    model = st.TargetEncode(columns=["a"], target="y", inline=inline).fit(df)
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, a string")
    assert column(model.transform(new), "TE_a") == [2.0, 4.0, 4.0]


def test_target_encoding_needs_target(spark):
    with pytest.raises(ValueError):
        st.TargetEncode(columns=["a"]).fit(spark.createDataFrame([("x",)], "a string"))


def test_clip_leaves_columns_without_spread(spark):
    df = spark.createDataFrame([(i, v, 5.0) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0, None])],
                               "id int, a double, flat double")
    made = fit(st.ClipOutliers(exclude=["id"]), df)
    assert column(made, "a") == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert column(made, "flat") == [5.0] * 6


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 1.0), (3, None, None)], "id int, a string, x double")
    made = fit(st.ModeFill(columns=["a", "x"]), df)
    assert column(made, "a")[2] == "a" and column(made, "x")[2] == 1.0


def test_median_of_even_count_and_empty_column(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 3.0, None), (3, None, None)], "id int, a double, e double")
    made = fit(st.MedianFill(exclude=["id"]), df)
    assert column(made, "a") == [2.0, 3.0, 2.5] and "e" not in made.columns


def test_standardize_without_spread(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, 4.0)], "id int, a double, flat double")
    made = fit(st.Standardize(exclude=["id"]), df)
    assert column(made, "a") == [-1.0, 1.0] and column(made, "flat") == [0.0, 0.0]


def test_finite_clean(spark):
    df = spark.createDataFrame([(1, NAN), (2, INF), (3, -INF), (4, 1.0), (5, None)], "id int, a double")
    assert column(st.FiniteClean(exclude=["id"]).transform(df), "a") == [None, None, None, 1.0, None]


def test_drop_empty_is_decided_when_fitting(spark):
    train = spark.createDataFrame([(1, None, "x")], "id int, a double, b string")
    new = spark.createDataFrame([(1, 5.0, None)], "id int, a double, b string")
    assert st.DropEmpty().fit(train).transform(new).columns == ["id", "b"]


def test_variance_is_strict(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0)], "id int, a double, flat double")
    assert fit(st.VarianceKeep(exclude=["id"]), df).columns == ["id", "a"]
    assert fit(st.VarianceKeep(exclude=["id"], threshold=0.5), df).columns == ["id"]


def test_one_hot_unknown_is_empty(spark):
    """Texts that look alike across columns keep their own slots."""
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", "z"), (3, "z", None), (4, None, "a")], "id int, a string, b string")
    made = df
    for step in one_hot({"a": ["b", "a"], "b": ["a", "b", "1=a"]}):
        made = step.transform(made)
    assert [list(v.toArray()) for v in column(made, HOT)] == [
        [1, 0, 0, 0, 1], [0, 1, 0, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 1, 0]]


def test_roles(spark):
    df = spark.createDataFrame([], "k bigint, a string, b int, c boolean, d date, o string, code int, y double")
    roles = infer_roles(df, ["o", "absent"], ["k", "y"], {"code": "category"})
    assert (roles.ordinal, roles.category, roles.numeric, roles.dropped) == (["o"], ["a", "code"], ["b"], ["c", "d"])


def test_stage_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id int, a double")
    model = st.MedianFill(exclude=["id"]).fit(df)
    model.save(str(tmp_path / "m"))
    assert column(st.FillModel.load(str(tmp_path / "m")).transform(df), "a") == [1.0, 1.0]
    st.MedianFill(columns=["a"]).save(str(tmp_path / "e"))
    assert st.MedianFill.load(str(tmp_path / "e")).get("columns") == ["a"]


def test_no_python_in_transforms(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y")], "id int, a double, b string")
    made = fit(st.Standardize(columns=["a"]), fit(st.MedianFill(columns=["a"]), fit(st.RareGroup(columns=["b"]), df)))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert made.select(F.count("*")).first()[0] == 2


def test_null_and_its_text_are_one_level_at_every_size(spark):
    rows = [(i, None if i < 30 else "nan" if i < 60 else "x" if i < 90 else "rare") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, c string")
    held = column(fit(st.RareGroup(columns=["c"], min_freq=20), df), "c")
    stored = column(fit(st.RareGroup(columns=["c"], min_freq=20, inline=1), df), "c")
    assert held == stored and len(stored) == 100 and held[-1] == "Other"
