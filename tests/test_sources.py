import pytest
from pyspark.sql import functions as F

from tessel.sources.sinks import load_model, results_table, save_model, trial_summary, write_results
from tessel.sources.tables import drop_ids, format_of, read_table, split_features_target

CSV = "id,a,b,c,flag,code,empty\n1,1.5,x,NA,True,1d,\n2,None,NA,2,False,2f,\n3, 3 ,,n/a,True,3d,NaN\n"


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "t.CSV"
    path.write_text(CSV)
    return str(path)


def test_csv_types_and_tokens(spark, csv):
    df = read_table(spark, csv)
    kinds = dict(df.dtypes)
    assert kinds == {"id": "bigint", "a": "double", "b": "string", "c": "bigint", "flag": "boolean",
                     "code": "string", "empty": "double"}
    rows = df.orderBy("id").collect()
    assert [r["a"] for r in rows] == [1.5, None, 3.0]
    assert [r["b"] for r in rows] == ["x", None, None]
    assert [r["c"] for r in rows] == [None, 2, None]
    assert [r["empty"] for r in rows] == [None] * 3


def test_csv_with_schema_and_own_tokens(spark, csv):
    df = read_table(spark, csv, schema="id int, b string, c string", na_tokens=["", "x", "n/a"])
    rows = df.orderBy("id").collect()
    assert [r["b"] for r in rows] == [None, "NA", None]
    assert [r["c"] for r in rows] == ["NA", "2", None]


def test_json_document_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "NA"}, {"a": 2.5, "b": "z"}]')
    (tmp_path / "b.json").write_text('{"a": 1, "b": "NA"}\n{"a": 2, "b": "z"}\n')
    one = read_table(spark, str(tmp_path / "a.json")).orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in one] == [(1.0, None), (2.5, "z")]
    two = read_table(spark, str(tmp_path / "b.json"), json_lines=True)
    assert dict(two.dtypes)["a"] == "bigint" and two.count() == 2


def test_parquet_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id int, a double").write.parquet(path)
    assert read_table(spark, path).where(F.col("a").isNull()).count() == 1


@pytest.mark.parametrize("path", ["a.txt", "a", "csv"])
def test_unknown_format(path):
    with pytest.raises(ValueError):
        format_of(path)


def test_ids_and_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, x int, y int")
    assert drop_ids(df, ["id", "absent"]).columns == ["x", "y"]
    x, y = split_features_target(df, "y", key=["id"])
    assert x.columns == ["id", "x"] and y.columns == ["id", "y"]
    assert split_features_target(df, None, id_cols=["id"]) [1] is None
    with pytest.raises(ValueError):
        split_features_target(df, "absent")


def test_results_table_columns(spark, tmp_path):
    df = results_table(spark, {"a": {"cv_rmse_mean": 1.0, "test_rmse": 2.0}})
    write_results(df, str(tmp_path / "r.csv"))
    back = spark.read.csv(str(tmp_path / "r.csv"), header=True)
    assert back.columns == ["model", "cv_rmse_mean", "cv_rmse_std", "cv_r2_mean", "cv_r2_std", "test_rmse", "test_r2"]
    assert back.first()["cv_rmse_std"] is None


def test_trial_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "stack_combo string, value double")
    assert sorted(map(tuple, trial_summary(df).collect())) == [("a", 2, 1.0, 2.0), ("b", 1, 2.0, 2.0)]


def test_unknown_model_name(tmp_path):
    with pytest.raises(ValueError):
        save_model({}, "none", str(tmp_path))
    with pytest.raises(Exception):
        load_model(str(tmp_path / "none"))
