"""Sources, roles and derived columns."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    KEY_SQL, LINE_GAPS_SQL, PART_GAPS_SQL, SHIPMENTS_SQL, line_gaps, lines, part_gaps, shipments, table)
from tessel.operators import derive as d
from tessel.operators.roles import infer_roles
from tessel.operators.stages import upper_caps
from tessel.session import new_path
from tessel.sources.tables import read_table, split_features_target


@query("scan_na_tokens", f"""WITH {PART_GAPS_SQL}
SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_name END AS p_name, p_brand, p_type,
  CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS BIGINT) END AS p_size, p_retailprice
FROM parts""")
def scan_na_tokens(spark, sf_dir):
    """Parts written as CSV with several missing-value tokens, read back with types."""
    path = new_path(spark, "parts") + ".csv"
    parts = part_gaps(spark, sf_dir)
    parts.select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, "None").otherwise(F.col("p_name")).alias("p_name"),
        F.coalesce("p_brand", F.lit("NA")).alias("p_brand"), "p_type",
        F.when(F.col("p_size") % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string")).alias("p_size"),
        "p_retailprice").write.csv(path, header=True)
    return read_table(spark, path)


@query("scan_json", f"""WITH {PART_GAPS_SQL}
SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM parts""")
def scan_json(spark, sf_dir):
    """Parts written as JSON lines, read back with types inferred."""
    path = new_path(spark, "parts") + ".json"
    part_gaps(spark, sf_dir).drop("p_type").write.json(path)
    return read_table(spark, path, json_lines=True).select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query("feature_target_split", """
SELECT o.o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice AS target FROM orders o""")
def feature_target_split(spark, sf_dir):
    features, target = split_features_target(
        table(spark, sf_dir, "orders"), "o_totalprice", key=["o_orderkey"], id_cols=["o_orderdate", "absent"])
    return features.join(target.withColumnRenamed("o_totalprice", "target"), "o_orderkey")


@query("column_roles", """
SELECT 'o_custkey' AS column_name, 'numeric' AS role, count(o_custkey) AS present FROM orders
UNION ALL SELECT 'o_orderstatus', 'category', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', 'dropped', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'ordinal', count(o_orderpriority) FROM orders""")
def column_roles(spark, sf_dir):
    """Roles of the columns of orders with their number of present values."""
    orders = table(spark, sf_dir, "orders")
    roles = infer_roles(orders, ordinal=["o_orderpriority"], exclude=["o_orderkey", "o_totalprice"]).rows()
    counted = orders.agg(*[F.count(c).alias(c) for c, _ in roles])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("role"), F.col(c).alias("present"))
        for c, r in roles])).alias("x")).select("x.*")


@query("null_safe_sum", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, coalesce(quantity, 0) + coalesce(discount, 0) * 0.5 + coalesce(tax_units, 0) AS total FROM gaps""")
def null_safe_sum(spark, sf_dir):
    recipe = d.weighted_sum("total", {"quantity": 1, "discount": 0.5, "tax_units": 1})
    return d.derive(line_gaps(spark, sf_dir), [recipe]).select("row_key", "total")


@query("null_prop_sum", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, quantity + discount + tax_units AS total FROM gaps""")
def null_prop_sum(spark, sf_dir):
    recipe = d.strict_sum("total", ["quantity", "discount", "tax_units"])
    return d.derive(line_gaps(spark, sf_dir), [recipe]).select("row_key", "total")


@query("difference", f"""WITH {SHIPMENTS_SQL}
SELECT row_key, CAST(ship_year - order_year AS DOUBLE) AS age FROM ships""")
def difference(spark, sf_dir):
    return d.derive(shipments(spark, sf_dir), [d.difference("age", "ship_year", "order_year")]).select("row_key", "age")


@query("inequality_flag", f"""WITH {SHIPMENTS_SQL}
SELECT row_key, CASE WHEN ship_year IS NULL OR order_year IS NULL OR ship_year <> order_year
  THEN 1 ELSE 0 END AS moved FROM ships""")
def inequality_flag(spark, sf_dir):
    return d.derive(shipments(spark, sf_dir), [d.differs("moved", "ship_year", "order_year")]).select("row_key", "moved")


@query("threshold_flag", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, CASE WHEN discount > 0 THEN 1 ELSE 0 END AS discounted FROM gaps""")
def threshold_flag(spark, sf_dir):
    return d.derive(line_gaps(spark, sf_dir), [d.above("discounted", "discount")]).select("row_key", "discounted")


@query("floored_ratio", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, quantity / CASE WHEN tax_units IS NOT NULL THEN greatest(tax_units, 1.0) END AS per_unit,
  CAST(0 AS DOUBLE) / CASE WHEN tax_units IS NOT NULL THEN greatest(tax_units, 1.0) END AS none_per_unit,
  price / 1.0 AS per_absent FROM gaps""")
def floored_ratio(spark, sf_dir):
    return d.derive(line_gaps(spark, sf_dir), [
        d.ratio("per_unit", "quantity", "tax_units"), d.ratio("none_per_unit", "absent", "tax_units"),
        d.ratio("per_absent", "price", "absent")]).select("row_key", "per_unit", "none_per_unit", "per_absent")


@query("cyclical_month", f"""WITH {SHIPMENTS_SQL}
SELECT row_key, round(sin(month / 12.0::DOUBLE * {2 * math.pi!r}), 7) AS month_sin,
  round(cos(month / 12.0::DOUBLE * {2 * math.pi!r}), 7) AS month_cos FROM ships""")
def cyclical_month(spark, sf_dir):
    made = d.derive(shipments(spark, sf_dir), [d.cycle("month", "month", 12)])
    return made.select("row_key", F.round("month_sin", 7).alias("month_sin"), F.round("month_cos", 7).alias("month_cos"))


@query("category_cross", f"""WITH {PART_GAPS_SQL}
SELECT p_partkey, coalesce(p_brand, 'nan') || '|' || coalesce(p_type, 'nan') AS brand_type FROM parts""")
def category_cross(spark, sf_dir):
    return d.derive(part_gaps(spark, sf_dir), [d.cross("brand_type", "p_brand", "p_type")]).select("p_partkey", "brand_type")


@query("log1p_feature", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, round(ln(1 + price), 7) AS ln_price, round(ln(1 + quantity), 7) AS ln_quantity FROM gaps""")
def log1p_feature(spark, sf_dir):
    made = d.derive(line_gaps(spark, sf_dir), [d.log1p("a", "price"), d.log1p("b", "quantity")])
    return made.select("row_key", F.round("a", 7).alias("ln_price"), F.round("b", 7).alias("ln_quantity"))


@query("interaction", f"""WITH {LINE_GAPS_SQL}
SELECT row_key, quantity * price AS quantity_price, quantity * 0.0::DOUBLE AS quantity_absent FROM gaps""")
def interaction(spark, sf_dir):
    return d.derive(line_gaps(spark, sf_dir), [
        d.product("quantity_price", "quantity", "price"),
        d.product("quantity_absent", "quantity", "absent")]).select("row_key", "quantity_price", "quantity_absent")


@query("winsorize_upper", f"""WITH {LINE_GAPS_SQL},
caps AS (SELECT quantile_cont(spend, 0.99) AS s, quantile_cont(quantity, 0.9) AS q FROM gaps)
SELECT row_key, round(least(spend, s), 6) AS spend_cap,
  CASE WHEN quantity IS NOT NULL THEN least(quantity, q) END AS quantity_cap FROM gaps, caps""")
def winsorize_upper(spark, sf_dir):
    df = line_gaps(spark, sf_dir)
    recipes = [d.winsorize("spend_cap", "spend", 0.99), d.winsorize("quantity_cap", "quantity", 0.9)]
    made = d.derive(df, recipes, upper_caps(df, recipes))
    return made.select("row_key", F.round("spend_cap", 6).alias("spend_cap"), "quantity_cap")


@query("backfill_columns", f"""
SELECT {KEY_SQL} AS row_key, l_quantity AS quantity, 0.0::DOUBLE AS bonus, CAST(NULL AS DOUBLE) AS built
FROM lineitem""")
def backfill_columns(spark, sf_dir):
    whole = lines(spark, sf_dir).select("row_key", F.col("l_quantity").alias("quantity"))
    made = d.derive(whole, [
        d.backfill(["quantity", "bonus"]), d.backfill(["built"], None)])
    return made.select("row_key", "quantity", "bonus", "built")
