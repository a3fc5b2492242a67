"""Holdout and folds. Sides are decided by the hash of the row key, never by row order.

A stratified holdout takes the exact share of every stratum: the rows with the smallest hashes.
No stratum is sorted. Hash prefixes are counted, the rows of the one prefix that holds the cut are
ranked, and what remains is one cut hash per stratum, so that splitting is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessel.functions.hashing import fold_of, row_hash
from tessel.functions.nulls import col
from tessel.operators.mutual import bin_of, quantile_edges

N_BINS = 15
DIGITS = 3
RANKABLE = 100_000


def target_bin(df: DataFrame, target: str, bins: int = N_BINS) -> Column:
    """Right-closed quantile bin of the target, repeated edges dropped.

    Inner edges are enough: the lowest bin takes the minimum, the highest the maximum.
    """
    return bin_of(col(target).cast("double"), quantile_edges(df, [target], bins)[target])


HELD = "is_test"


@dataclass
class Split:
    """Rows at or below the cut hash of their stratum are the holdout. Strata are 0, 1, 2 ..."""

    stratum: Column
    hashed: Column
    cuts: dict[int, str]

    @property
    def is_test(self) -> Column:
        if not self.cuts:
            return F.lit(False)
        cuts = F.array(*[F.lit(self.cuts.get(s)).cast("string") for s in range(max(self.cuts) + 1)])
        return F.coalesce(self.hashed <= F.get(cuts, self.stratum), F.lit(False))

    def mark(self, df: DataFrame, name: str = HELD) -> DataFrame:
        """Adds the holdout flag: one scan serves both sides."""
        return df.select("*", self.is_test.alias(name))

    def apply(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return df.where(~self.is_test), df.where(self.is_test)


def cut_hashes(
    df: DataFrame, stratum: Column, hashed: Column, share: float, rankable: int = RANKABLE,
) -> dict[int, str]:
    """Per stratum the hash at rank ``round(rows * share)``; strata must be few.

    Counts rows by the next digits of the hash, keeps to the digits that hold the wanted rank, and
    goes on until what is left of a stratum is small enough to rank. Counts combine before the
    shuffle: there are at most ``strata * 16**DIGITS`` groups.
    """
    rows = df.select(stratum.alias("s"), hashed.alias("h")).where(F.col("s").isNotNull())
    held: dict[int, tuple[str, int]] = {}
    depth = 0
    while True:
        found = _next_digits(_inside(rows, held, depth), held, depth, share)
        depth += DIGITS
        held = {r["s"]: (held.get(r["s"], ("", 0))[0] + r["p"], r["rank"]) for r in found}
        if not held:
            return {}
        if max(r["n"] for r in found) <= rankable or depth >= 32 - DIGITS:
            break
    at = F.row_number().over(Window.partitionBy("s").orderBy("h"))
    cuts = (_inside(rows, held, depth).withColumn("at", at)
            .where(F.col("at") == _of_stratum({s: r for s, (_, r) in held.items()}, "bigint"))
            .select("s", "h").collect())
    return {r["s"]: r["h"] for r in cuts}


def _of_stratum(values: dict[int, object], kind: str) -> Column:
    """The value of the row's stratum, from a literal array."""
    return F.get(F.array(*[F.lit(values.get(s)).cast(kind) for s in range(max(values) + 1)]), F.col("s"))


def _inside(rows: DataFrame, held: dict[int, tuple[str, int]], depth: int) -> DataFrame:
    if not held:
        return rows
    return rows.where(F.substring("h", 1, depth) == _of_stratum({s: p for s, (p, _) in held.items()}, "string"))


def _next_digits(rows: DataFrame, held: dict, depth: int, share: float) -> list:
    """Per stratum the next digits that hold the wanted rank, their rows, and the rank inside."""
    counts = rows.groupBy("s", F.substring("h", depth + 1, DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    take = (_of_stratum({s: r for s, (_, r) in held.items()}, "bigint") if held else
            F.round(F.sum("n").over(Window.partitionBy("s")) * F.lit(share)).cast("bigint"))
    ranked = counts.select("s", "p", "n", F.sum("n").over(upto).alias("cum"), take.alias("take"))
    before = F.col("cum") - F.col("n")
    return (ranked.where((F.col("cum") >= F.col("take")) & (before < F.col("take")))
            .select("s", "p", "n", (F.col("take") - before).alias("rank")).collect())


def stratified_split(
    df: DataFrame, keys: list[str] | str, target: str,
    test_size: float = 0.2, seed: int = 42, bins: int = N_BINS,
) -> Split:
    """Falls back to a plain random holdout when the target cannot be binned."""
    edges = quantile_edges(df, [target], bins)[target]
    if not edges:
        return random_split(df, keys, test_size, seed)
    stratum, hashed = bin_of(col(target).cast("double"), edges), row_hash(keys, seed)
    return Split(stratum, hashed, cut_hashes(df, stratum, hashed, test_size))


def random_split(df: DataFrame, keys: list[str] | str, test_size: float = 0.2, seed: int = 42) -> Split:
    stratum, hashed = F.lit(0), row_hash(keys, seed)
    return Split(stratum, hashed, cut_hashes(df, stratum, hashed, test_size))


def with_folds(df: DataFrame, keys: list[str] | str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    return df.select("*", fold_of(keys, k, seed).alias(name))
