import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessel.functions import quantiles
from tessel.functions.quantiles import exact_quantiles, quantile_report

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values, parts=3):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(parts)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_matches_numpy(spark, values):
    known = [v for v in values if v is not None]
    got = quantile_report(frame(spark, values), ["x"], PROBS)
    assert got.present["x"] == len(known) and got.rows == len(values)
    if known:
        np.testing.assert_allclose(got.values["x"], np.quantile(known, PROBS), rtol=1e-12, atol=1e-9)
    else:
        assert got.values["x"] == [None] * len(PROBS)


@pytest.mark.parametrize("accuracy,open_rows", [(10, 50), (100, 10), (10_000, 1_000_000)])
def test_coarse_sketch_is_cut_again(spark, accuracy, open_rows):
    """A coarse sketch leaves wide intervals; results stay exact."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.exp(rng.normal(size=3000) * 3), np.full(1500, 2.0)])  # a third on one value
    got = exact_quantiles(frame(spark, values), ["x"], PROBS, accuracy=accuracy, open_rows=open_rows)
    np.testing.assert_allclose(got["x"], np.quantile(values, PROBS), rtol=1e-12)


def test_partitioning_does_not_matter(spark):
    values = np.random.default_rng(5).normal(size=2000)
    a = exact_quantiles(frame(spark, values, 1), ["x"], PROBS, accuracy=20)
    b = exact_quantiles(frame(spark, values, 7), ["x"], PROBS, accuracy=20)
    assert a == b


def test_infinities_take_part(spark):
    got = exact_quantiles(frame(spark, [float("-inf"), 1.0, 2.0, 3.0, float("inf")]), ["x"], [0.25, 0.5, 0.75])
    assert got["x"] == [1.0, 2.0, 3.0]


def test_sketch_only(spark):
    got = quantile_report(frame(spark, range(101)), ["x"], [0.5], exact=False)
    assert got.values["x"] == [50.0] and got.present["x"] == 101


def test_many_columns_at_once(spark):
    df = spark.range(1000).select(*[(F.col("id") * i % 97).cast("double").alias(f"c{i}") for i in range(1, 9)])
    got = exact_quantiles(df, df.columns, [0.25, 0.5])
    ids = np.arange(1000)
    for i in range(1, 9):
        np.testing.assert_allclose(got[f"c{i}"], np.quantile(ids * i % 97, [0.25, 0.5]))


def test_sketch_is_built_from_thinned_values(spark):
    """Every value of a column went into one sketch a task; now one of sixteen does, and counts still decide."""
    values = np.random.default_rng(8).normal(size=5000)
    thin = quantiles._values(frame(spark, values), [F.col("x"), -F.col("x")]).mapInArrow(quantiles._thinned(2), "c int, v double")
    assert 500 < thin.count() < 700
    got = exact_quantiles(frame(spark, [*values, float("nan"), float("nan"), None]), ["x"], [0.25, 0.5], open_rows=40)
    np.testing.assert_allclose(got["x"], np.quantile([*values, np.inf, np.inf], [0.25, 0.5]), rtol=1e-12)
