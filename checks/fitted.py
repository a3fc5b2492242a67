"""Fitted transforms."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    LINE_GAPS_SQL, LINES_SQL, PART_GAPS_SQL, PRIORITIES, line_gaps, lines, part_gaps, table)
from tessel.operators import stages as st
from tessel.operators.encode import HOT, assemble, explode_vector, one_hot, slot_names
from tessel.operators.mutual import mutual_info, top_features
from tessel.plans.features import FeaturePlan, fit_features
from tessel.session import new_path
from tessel.sources.sinks import load_model, run_report, save_model


@query("ordinal_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 1.0::DOUBLE WHEN '4-NOT SPECIFIED' THEN 2.0
  WHEN '2-HIGH' THEN 3.0 WHEN '1-URGENT' THEN 4.0 END AS o_orderpriority,
  CASE o_orderstatus WHEN 'F' THEN 10.0::DOUBLE WHEN 'O' THEN 2.5 END AS o_orderstatus FROM orders""")
def ordinal_map(spark, sf_dir):
    """Ranks from a list that lacks one level, and numbers from a dict."""
    stage = st.OrdinalMap(mapping={
        "o_orderpriority": [p for p in PRIORITIES if p != "3-MEDIUM"],
        "o_orderstatus": {"F": 10.0, "O": 2.5}, "absent": ["x"]})
    return stage.transform(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("missing_indicator", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, CAST(quantity IS NULL AS INT) AS quantity_was_missing,
  CAST(discount IS NULL AS INT) AS discount_was_missing,
  CAST(tax_units IS NULL AS INT) AS tax_units_was_missing FROM gaps""")
def missing_indicator(spark, sf_dir):
    df = line_gaps(spark, sf_dir)
    made = st.MissingFlags().fit(df).transform(df)
    return made.select("row_key", *[c for c in made.columns if c.endswith("_was_missing")])


@query("rare_group", f"""WITH {PART_GAPS_SQL},
names AS (SELECT coalesce(p_name, 'nan') AS v FROM parts GROUP BY 1 HAVING count(*) >= 30),
brands AS (SELECT coalesce(p_brand, 'nan') AS v FROM parts GROUP BY 1 HAVING count(*) >= 65)
SELECT p_partkey,
  CASE WHEN coalesce(p_name, 'nan') IN (SELECT v FROM names) THEN coalesce(p_name, 'nan') ELSE 'Other' END AS p_name,
  CASE WHEN coalesce(p_brand, 'nan') IN (SELECT v FROM brands) THEN coalesce(p_brand, 'nan') ELSE 'Other' END AS p_brand
FROM parts""")
def rare_group(spark, sf_dir):
    df = part_gaps(spark, sf_dir).select("p_partkey", "p_name", "p_brand")
    for column, least in (("p_name", 30), ("p_brand", 65)):
        df = st.RareGroup(columns=[column], min_freq=least).fit(df).transform(df)
    return df


@query("rare_group_stored", """
WITH kept AS (SELECT c_name AS v FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1 HAVING count(*) >= 10)
SELECT o_orderkey, CASE WHEN c_name IN (SELECT v FROM kept) THEN c_name ELSE 'Other' END AS c_name
FROM customer JOIN orders ON c_custkey = o_custkey""")
def rare_group_stored(spark, sf_dir):
    """Many levels: the level table is written and joined instead of held inline."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    df = (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
          .join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"))
    return st.RareGroup(columns=["c_name"], min_freq=10, inline=100).fit(df).transform(df)


@query("target_encode", f"""WITH {LINES_SQL}, known AS (
  SELECT row_key, charge, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS p_brand, p_type
  FROM lines JOIN part ON l_partkey = p_partkey),
b AS (SELECT p_brand, avg(charge) AS m FROM known GROUP BY 1), t AS (SELECT p_type, avg(charge) AS m FROM known GROUP BY 1),
g AS (SELECT avg(charge) AS m FROM known)
SELECT row_key, known.p_brand, known.p_type,
  round(CASE WHEN known.p_brand IS NULL THEN g.m ELSE b.m END, 5) AS "TE_p_brand", round(t.m, 5) AS "TE_p_type"
FROM known LEFT JOIN b ON known.p_brand = b.p_brand LEFT JOIN t ON known.p_type = t.p_type, g""")
def target_encode(spark, sf_dir):
    df = (lines(spark, sf_dir).join(part_gaps(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
          .select("row_key", "charge", "p_brand", "p_type"))
    made = st.TargetEncode(columns=["p_brand", "p_type"], target="charge").fit(df).transform(df)
    return made.select("row_key", "p_brand", "p_type", F.round("TE_p_brand", 5).alias("TE_p_brand"),
                       F.round("TE_p_type", 5).alias("TE_p_type"))


@query("target_encode_stored", """
WITH m AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY 1)
SELECT o_orderkey, round(m.m, 7) AS "TE_o_custkey" FROM orders o JOIN m ON o.o_custkey = m.o_custkey""")
def target_encode_stored(spark, sf_dir):
    """One level per customer: the means are written and joined."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    made = st.TargetEncode(columns=["o_custkey"], target="o_totalprice").fit(df).transform(df)
    return made.select("o_orderkey", F.round("TE_o_custkey", 7).alias("TE_o_custkey"))


@query("iqr_clip", f"""WITH {LINE_GAPS_SQL},
q AS (SELECT quantile_cont(spend, 0.25) AS s1, quantile_cont(spend, 0.75) AS s3,
  quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.75) AS q3 FROM gaps)
SELECT row_key, round(greatest(least(spend, s3 + 0.75 * (s3 - s1)), s1 - 0.75 * (s3 - s1)), 6) AS spend,
  CASE WHEN quantity IS NOT NULL
    THEN greatest(least(quantity, q3 + 0.75 * (q3 - q1)), q1 - 0.75 * (q3 - q1)) END AS quantity,
  constant FROM (SELECT *, 7.0::DOUBLE AS constant FROM gaps), q""")
def iqr_clip(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select("row_key", "spend", "quantity", F.lit(7.0).alias("constant"))
    made = st.ClipOutliers(factor=0.75).fit(df).transform(df)
    return made.select("row_key", F.round("spend", 6).alias("spend"), "quantity", "constant")


@query("mode_impute", f"""WITH {PART_GAPS_SQL},
b AS (SELECT p_brand FROM parts WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT CAST(p_size AS DOUBLE) AS p_size FROM parts WHERE p_size % 7 <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT p_partkey, coalesce(p.p_brand, b.p_brand) AS p_brand,
  coalesce(CASE WHEN p.p_size % 7 <> 0 THEN CAST(p.p_size AS DOUBLE) END, s.p_size) AS p_size FROM parts p, b, s""")
def mode_impute(spark, sf_dir):
    df = part_gaps(spark, sf_dir).select(
        "p_partkey", "p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("double")).alias("p_size"))
    return st.ModeFill(columns=["p_brand", "p_size"]).fit(df).transform(df)


@query("median_impute", f"""WITH {LINE_GAPS_SQL},
m AS (SELECT median(quantity) AS q, median(discount) AS d, median(CASE WHEN l_linenumber <> 1 THEN spend END) AS s FROM gaps)
SELECT row_key, coalesce(quantity, q) AS quantity, coalesce(discount, d) AS discount,
  round(coalesce(CASE WHEN l_linenumber <> 1 THEN spend END, s), 4) AS spend FROM gaps, m""")
def median_impute(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select(
        "row_key", "quantity", "discount", F.when(F.col("l_linenumber") != 1, F.col("spend")).alias("spend"),
        F.lit(None).cast("double").alias("empty"))
    made = st.MedianFill().fit(df).transform(df)
    return made.withColumn("spend", F.round("spend", 4))


@query("standardize", f"""WITH {LINE_GAPS_SQL},
m AS (SELECT avg(quantity) AS qm, stddev_pop(quantity) AS qs, avg(price) AS pm, stddev_pop(price) AS ps FROM gaps)
SELECT row_key, round((quantity - qm) / qs, 5) AS quantity, round((price - pm) / ps, 5) AS price,
  0.0::DOUBLE AS constant FROM gaps, m""")
def standardize(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select("row_key", "quantity", "price", F.lit(3.0).alias("constant"))
    made = st.Standardize().fit(df).transform(df)
    return made.select("row_key", F.round("quantity", 5).alias("quantity"), F.round("price", 5).alias("price"), "constant")


def _hot(df, columns):
    """Fitted one-hot stages for all levels present in ``columns``."""
    pairs = st.value_counts(df, columns).where(F.col("value").isNotNull()).collect()
    levels = {c: sorted(r["value"] for r in pairs if r["column"] == c) for c in columns}
    return levels, one_hot(levels)


@query("one_hot", f"""WITH {PART_GAPS_SQL}
SELECT p_partkey, 'p_brand_' || p_brand AS feature, 1.0::DOUBLE AS value FROM parts WHERE p_brand IS NOT NULL
UNION ALL SELECT p_partkey, 'p_type_' || p_type, 1.0 FROM parts""")
def one_hot_query(spark, sf_dir):
    """Non-zero slots in long form; a missing brand has none."""
    df = part_gaps(spark, sf_dir)
    levels, steps = _hot(df, ["p_brand", "p_type"])
    made = df
    for step in [*steps, *assemble(True, [], [])]:
        made = step.transform(made)
    return explode_vector(made, ["p_partkey"], slot_names(levels, [], []))


@query("one_hot_width", f"""WITH {PART_GAPS_SQL}
SELECT p_partkey, (SELECT count(DISTINCT p_brand) FROM parts) AS width,
  CASE WHEN p_brand IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY p_brand NULLS LAST) - 1 END AS slot FROM parts""")
def one_hot_width(spark, sf_dir):
    """Vector width and the position of the set slot, in sorted level order."""
    df = part_gaps(spark, sf_dir).select("p_partkey", "p_brand")
    made = df
    for step in _hot(df, ["p_brand"])[1]:
        made = step.transform(made)
    slots = vector_to_array(HOT)
    return made.select("p_partkey", F.size(slots).cast("bigint").alias("width"),
                       (F.array_position(slots, 1.0) - 1).alias("slot"))


@query("finite_clean", f"""WITH {LINES_SQL}
SELECT row_key, CASE WHEN l_linenumber NOT IN (1, 2, 3) THEN l_quantity END AS quantity FROM lines""")
def finite_clean(spark, sf_dir):
    line = F.col("l_linenumber")
    df = lines(spark, sf_dir).select(
        "row_key", F.when(line == 1, float("inf")).when(line == 2, float("-inf")).when(line == 3, float("nan"))
        .otherwise(F.col("l_quantity")).alias("quantity"))
    return st.FiniteClean().transform(df)


@query("drop_all_null", f"""WITH {LINE_GAPS_SQL} SELECT row_key, quantity FROM gaps""")
def drop_all_null(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select(
        "row_key", "quantity", F.lit(None).cast("double").alias("empty"), F.lit(None).cast("string").alias("blank"))
    return st.DropEmpty().fit(df).transform(df)


@query("variance_select", f"""WITH {LINE_GAPS_SQL} SELECT row_key, price, quantity FROM gaps""")
def variance_select(spark, sf_dir):
    df = line_gaps(spark, sf_dir).select("row_key", "price", "quantity", F.lit(1.5).alias("constant"), "discount")
    return st.VarianceKeep(threshold=0.01).fit(df).transform(df)


def _bin(c: str) -> str:
    return f"len(list_filter({c}_e, lambda e: e < {c}))"


_MI_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_EDGES = "[" + ", ".join(f"{i / 8!r}" for i in range(1, 8)) + "]"


@query("mutual_info_rank", f"""WITH {LINES_SQL},
e AS (SELECT {", ".join(f"list_distinct(quantile_cont({c}, {_EDGES})) AS {c}_e" for c in [*_MI_COLUMNS, "charge"])} FROM lines),
b AS (SELECT {_bin("charge")} AS yb, {", ".join(f"{_bin(c)} AS {c}" for c in _MI_COLUMNS)} FROM lines, e),
u AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS xb, yb FROM b" for c in _MI_COLUMNS)}),
n AS (SELECT feature, xb, yb, count(*)::DOUBLE AS n FROM u GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER (PARTITION BY feature, xb) AS nx, sum(n) OVER (PARTITION BY feature, yb) AS ny,
  sum(n) OVER (PARTITION BY feature) AS al FROM n)
SELECT feature, round(sum(n / al * ln(n * al / (nx * ny))), 7) AS mi FROM t GROUP BY 1 ORDER BY sum(n / al * ln(n * al / (nx * ny))) DESC, 1 LIMIT 3""")
def mutual_info_rank(spark, sf_dir):
    """The three columns that tell most about the charge."""
    scores = mutual_info(lines(spark, sf_dir), _MI_COLUMNS, "charge", bins=8)
    return top_features(scores, 3).select("feature", F.round("mi", 7).alias("mi"))




# --- levels by the thousand: dictionaries stored as tables, and kept in saved models ---------

CUSTOMERS_SQL = "o AS (SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)"


def _customers(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice"))


@query("one_hot_wide", f"""WITH {CUSTOMERS_SQL}
SELECT o_orderkey, (SELECT count(DISTINCT c_name) FROM o) + 2 AS width, dense_rank() OVER (ORDER BY c_name) - 1 AS slot FROM o""")
def one_hot_wide(spark, sf_dir):
    """A slot for every customer, before those of a narrow column: the vector's width and the customer's slot."""
    df = _customers(spark, sf_dir).withColumn("parity", F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd"))
    made = st.OneHot(columns=["c_name", "parity"], outputCol="hot").fit(df).transform(df)
    v = F.unwrap_udt("hot")
    return made.select("o_orderkey", v["size"].cast("bigint").alias("width"), F.array_min(v["indices"]).cast("bigint").alias("slot"))


@query("encode_wide", f"""WITH {CUSTOMERS_SQL},
g AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY c_name) >= 4 THEN c_name ELSE 'Other' END AS name FROM o)
SELECT o_orderkey, 'c_name_' || name AS feature, 1.0::DOUBLE AS value FROM g""")
def encode_wide(spark, sf_dir):
    """The feature plan over a category of many levels, in long form."""
    df = _customers(spark, sf_dir)
    fitted = fit_features(df, FeaturePlan(key=["o_orderkey"], target="o_totalprice", min_freq=4))
    return explode_vector(fitted.transform(df), ["o_orderkey"], fitted.names_table(spark))


@query("model_roundtrip_stored", """
WITH m AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY 1)
SELECT o_orderkey, round(m.m, 7) AS "TE_o_custkey" FROM orders o JOIN m ON o.o_custkey = m.o_custkey""")
def model_roundtrip_stored(spark, sf_dir):
    """Target means by customer from a saved and loaded model, which holds its level table."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    model = PipelineModel(stages=[st.TargetEncode(columns=["o_custkey"], target="o_totalprice").fit(df)])
    path = save_model({"means": model}, "means", new_path(spark, "models"))
    made = load_model(path)[1].transform(df)
    return made.select("o_orderkey", F.round("TE_o_custkey", 7).alias("TE_o_custkey"))


@query("run_report_stored", """
SELECT 'RareGroupModel' AS stage, 'c_name' AS column_name, 'kept:' || c_name AS stat, CAST(count(*) AS VARCHAR) AS value
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name HAVING count(*) >= 10""")
def run_report_stored(spark, sf_dir):
    """The levels that a stage kept in a table, with their counts."""
    fitted = st.RareGroup(columns=["c_name"], min_freq=10, inline=0).fit(_customers(spark, sf_dir))
    report = run_report(PipelineModel(stages=[fitted]), spark)
    return report.select("stage", F.col("column").alias("column_name"), "stat", "value")
