"""Views over the given tables, once for Spark and once as SQL.

The tables hold no NULL, so missing values are set by the same rule on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.functions.hashing import row_key

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def charge():
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


def lines(spark, sf_dir) -> DataFrame:
    """Line items with a text key and the target ``charge``."""
    return table(spark, sf_dir, "lineitem").select("*", row_key(LINE_KEYS).alias("row_key"), charge().alias("charge"))


KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
LINES_SQL = f"""lines AS (
  SELECT *, {KEY_SQL} AS row_key, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem)"""


def line_gaps(spark, sf_dir) -> DataFrame:
    """Line items whose quantity, discount and tax are missing on some line numbers."""
    line = F.col("l_linenumber")
    return lines(spark, sf_dir).select(
        "row_key", line,
        F.when(line != 3, F.col("l_quantity")).alias("quantity"),
        F.when(line != 5, F.col("l_discount")).alias("discount"),
        F.when(~line.isin(2, 3), F.col("l_tax") * 50).alias("tax_units"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("spend"),
        F.col("l_returnflag").alias("flag"), "charge")


LINE_GAPS_SQL = LINES_SQL + """, gaps AS (
  SELECT row_key, l_linenumber,
    CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
    CASE WHEN l_linenumber <> 5 THEN l_discount END AS discount,
    CASE WHEN l_linenumber NOT IN (2, 3) THEN l_tax * 50 END AS tax_units,
    l_extendedprice AS price, l_extendedprice * l_quantity AS spend, l_returnflag AS flag, charge
  FROM lines)"""


def part_gaps(spark, sf_dir) -> DataFrame:
    """Parts whose brand is missing for some sizes."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("p_brand"),
        "p_type", "p_size", "p_retailprice")


PART_GAPS_SQL = """parts AS (
  SELECT p_partkey, p_name, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS p_brand, p_type, p_size, p_retailprice
  FROM part)"""


def shipments(spark, sf_dir) -> DataFrame:
    """Line items with their order: years of both dates, the ship year missing on line 4."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("row_key",
                    F.when(F.col("l_linenumber") != 4, F.year("l_shipdate")).alias("ship_year"),
                    F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("month")))


SHIPMENTS_SQL = LINES_SQL + """, ships AS (
  SELECT row_key, CASE WHEN l_linenumber <> 4 THEN year(l_shipdate) END AS ship_year,
    year(o_orderdate) AS order_year, month(o_orderdate) AS month
  FROM lines JOIN orders ON l_orderkey = o_orderkey)"""


def sales(spark, sf_dir) -> DataFrame:
    """Line items with their part, order, customer and nation.

    Orders meet their customers first, so that the line items are shuffled by order and by part
    only; Spark picks each join by size and splits hot keys. The text key and the target are made after the
    joins and take no room in their shuffles.
    """
    line = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    bought = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return (line.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(row_key(LINE_KEYS).alias("row_key"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "p_brand",
                    "p_type", "p_size", "o_orderpriority", "c_mktsegment", "n_name", "l_linenumber", charge().alias("charge")))


SALES_SQL = LINES_SQL + """, sales AS (
  SELECT row_key, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, p_brand, p_type, p_size,
    o_orderpriority, c_mktsegment, n_name, l_linenumber, charge
  FROM lines JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
