import pytest
from pyspark.sql import functions as F

from tessel.operators.splits import random_split, stratified_split, target_bin, with_folds


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(1000).select("id", (F.col("id") * 37 % 211).cast("double").alias("y"))


def test_every_row_is_on_one_side_with_equal_shares(table):
    split = stratified_split(table, "id", "y", 0.2)
    train, test = split.apply(table)
    assert train.count() + test.count() == 1000
    assert train.join(test, "id").count() == 0
    per_bin = table.select(target_bin(table, "y").alias("b"), split.is_test.alias("t")).groupBy("b").agg(
        F.count("*").alias("n"), F.sum(F.col("t").cast("int")).alias("k")).collect()
    assert len(per_bin) == 15 and all(r["k"] == round(r["n"] * 0.2) for r in per_bin)


def test_split_ignores_row_order_and_partitions(table):
    ids = [{r["id"] for r in stratified_split(t, "id", "y").apply(t)[1].collect()}
           for t in (table, table.repartition(11), table.orderBy(F.desc("y")))]
    assert ids[0] == ids[1] == ids[2]
    other = {r["id"] for r in stratified_split(table, "id", "y", seed=7).apply(table)[1].collect()}
    assert other != ids[0]


def test_repeated_edges_and_a_hot_value(spark):
    """A third of the rows share one target value: edges collapse, shares stay exact."""
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("y"))
    assert df.select(target_bin(df, "y").alias("b")).distinct().count() < 15
    assert stratified_split(df, "id", "y", 0.1).apply(df)[1].count() == pytest.approx(90, abs=8)


def test_constant_target_falls_back_to_one_stratum(spark):
    df = spark.range(100).select("id", F.lit(1.0).alias("y"))
    assert stratified_split(df, "id", "y", 0.2).apply(df)[1].count() == 20


def test_random_split_is_exact(table):
    assert random_split(table, "id", 0.25).apply(table)[1].count() == 250


def test_empty_side(table):
    assert random_split(table, "id", 0.0).apply(table)[1].count() == 0


def test_folds_partition_the_rows(table):
    counts = [r["count"] for r in with_folds(table, "id", 5).groupBy("fold").count().collect()]
    assert len(counts) == 5 and sum(counts) == 1000 and min(counts) > 150


@pytest.mark.parametrize("rankable", [1, 5, 100_000])
def test_cut_is_the_rank_however_deep_the_digits_go(table, rankable):
    from tessel.functions.hashing import row_hash
    from tessel.operators.splits import cut_hashes

    rows = table.select((F.col("id") % 3).cast("int").alias("s"), row_hash("id", 42).alias("h"))
    cuts = cut_hashes(rows, F.col("s"), F.col("h"), 0.3, rankable)
    for s in range(3):
        hashes = sorted(r["h"] for r in rows.where(F.col("s") == s).collect())
        assert cuts[s] == hashes[round(len(hashes) * 0.3) - 1]
