"""Every registered query with SQL gives exactly the rows of that SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference, duck, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
# at this size lineitem has one duplicate row key, which takes rank-based splits out of step
KEYED = {"cross_validate", "train_one", "results_table", "grid_search", "trials_table", "leaderboard_topk",
         "stack_oof", "model_roundtrip", "score_output", "ridge", "lasso", "lasso_default", "elastic_net",
         "feature_plan_fit", "transform_new", "run_report"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - KEYED))
def test_query_matches_sql(spark, con, name):
    assert difference(spark_rows(queries()[name](spark, SF)), sql_rows(con, oracle_sql()[name])) is None


@pytest.mark.parametrize("name", ["cross_validate", "transform_new", "stack_oof", "train_one"])
def test_split_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert difference(spark_rows(queries()[name](spark, sf)), sql_rows(duck(sf), oracle_sql()[name])) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    row = entry(spark).first()
    assert row["n"] > 0 and row["r2"] > 0.9
