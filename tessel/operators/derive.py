"""Derived columns: a list of recipes that compiles to one projection.

A recipe is a small dict, so a fitted list can be saved with a model. Later recipes may use
the columns of earlier ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.functions.nulls import cap_at, col, floor_at


def backfill(columns: list[str], value: float | None = 0) -> dict:
    """Add the columns that the table lacks, filled with ``value``."""
    return {"op": "backfill", "columns": columns, "value": value}


def weighted_sum(out: str, terms: dict[str, float]) -> dict:
    """Sum in which missing counts as 0."""
    return {"op": "weighted_sum", "out": out, "terms": terms}


def strict_sum(out: str, columns: list[str]) -> dict:
    """Sum that is missing when any part is."""
    return {"op": "strict_sum", "out": out, "columns": columns}


def difference(out: str, left: str, right: str) -> dict:
    return {"op": "difference", "out": out, "left": left, "right": right}


def differs(out: str, left: str, right: str) -> dict:
    """1 where the two differ or either is missing."""
    return {"op": "differs", "out": out, "left": left, "right": right}


def above(out: str, column: str, threshold: float = 0) -> dict:
    """1 above the threshold, 0 at or below it or missing."""
    return {"op": "above", "out": out, "column": column, "threshold": threshold}


def ratio(out: str, top: str, bottom: str) -> dict:
    """Ratio whose denominator is at least 1; an absent column counts as 0 above, 1 below."""
    return {"op": "ratio", "out": out, "top": top, "bottom": bottom}


def cycle(out: str, column: str, period: float) -> dict:
    """``out_sin`` and ``out_cos``; skipped if the column is absent."""
    return {"op": "cycle", "out": out, "column": column, "period": period}


def cross(out: str, left: str, right: str) -> dict:
    """Both texts joined by ``|``, missing as ``nan``; skipped if either column is absent."""
    return {"op": "cross", "out": out, "left": left, "right": right}


def log1p(out: str, column: str) -> dict:
    return {"op": "log1p", "out": out, "column": column}


def product(out: str, left: str, right: str) -> dict:
    """Product; skipped without the left column, an absent right column counts as 0."""
    return {"op": "product", "out": out, "left": left, "right": right}


def winsorize(out: str, column: str, q: float = 0.99, per_batch: bool = False) -> dict:
    """Cap at an upper quantile, learned when fitting; ``per_batch`` learns it anew on every table."""
    return {"op": "winsorize", "out": out, "column": column, "q": q, "per_batch": per_batch}


def _number(value) -> Column:
    return F.lit(value).cast("double")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("nan"))


def compile_recipes(names: list[str], recipes: list[dict], caps: dict[str, float | None]) -> dict[str, Column]:
    """New columns in order, each expressed over the table's own columns."""
    made: dict[str, Column] = {}

    def get(name: str, absent: float | None = None) -> Column:
        if name in made:
            return made[name]
        return col(name) if name in names else _number(absent)

    def has(*wanted: str) -> bool:
        return all(w in made or w in names for w in wanted)

    for r in recipes:
        op, out = r["op"], r.get("out")
        if op == "backfill":
            made.update({c: _number(r["value"]) for c in r["columns"] if not has(c)})
        elif op == "weighted_sum":
            total = None
            for c, w in r["terms"].items():
                part = F.coalesce(get(c).cast("double"), F.lit(0.0))
                part = part if w == 1 else part * F.lit(float(w))
                total = part if total is None else total + part
            made[out] = total
        elif op == "strict_sum":
            total = get(r["columns"][0], 0).cast("double")
            for c in r["columns"][1:]:
                total = total + get(c, 0).cast("double")
            made[out] = total
        elif op == "difference":
            made[out] = (get(r["left"]) - get(r["right"])).cast("double")
        elif op == "differs":
            a, b = get(r["left"]), get(r["right"])
            made[out] = F.coalesce((a != b).cast("int"), F.lit(1))
        elif op == "above":
            made[out] = F.coalesce(get(r["column"]) > F.lit(r["threshold"]), F.lit(False)).cast("int")
        elif op == "ratio":
            made[out] = get(r["top"], 0).cast("double") / floor_at(get(r["bottom"], 1).cast("double"), 1.0)
        elif op == "cycle" and has(r["column"]):
            angle = get(r["column"]).cast("double") / F.lit(float(r["period"])) * F.lit(2 * math.pi)
            made[f"{out}_sin"], made[f"{out}_cos"] = F.sin(angle), F.cos(angle)
        elif op == "cross" and has(r["left"], r["right"]):
            made[out] = F.concat(_text(get(r["left"])), F.lit("|"), _text(get(r["right"])))
        elif op == "log1p":
            made[out] = F.log1p(get(r["column"], 0).cast("double"))
        elif op == "product" and has(r["left"]):
            made[out] = get(r["left"]).cast("double") * get(r["right"], 0).cast("double")
        elif op == "winsorize" and has(r["column"]):
            cap = caps.get(out)
            value = get(r["column"]).cast("double")
            made[out] = value if cap is None else cap_at(value, float(cap))
    return made


def derive(df: DataFrame, recipes: list[dict], caps: dict[str, float | None] | None = None) -> DataFrame:
    made = compile_recipes(df.columns, recipes, caps or {})
    kept = [col(c) for c in df.columns if c not in made]
    return df.select(*kept, *[e.alias(c) for c, e in made.items()])


# The recipes of the house-sales preset.
HOUSE_SALES = [
    backfill(["TotalBsmtSF", "1stFlrSF", "2ndFlrSF"]),
    weighted_sum("TotalSF", {"TotalBsmtSF": 1, "1stFlrSF": 1, "2ndFlrSF": 1}),
    backfill(["FullBath", "HalfBath", "BsmtFullBath", "BsmtHalfBath"]),
    weighted_sum("TotalBath", {"FullBath": 1, "HalfBath": 0.5, "BsmtFullBath": 1, "BsmtHalfBath": 0.5}),
    backfill(["YrSold", "YearBuilt", "YearRemodAdd", "GarageYrBlt"], None),
    difference("HouseAge", "YrSold", "YearBuilt"),
    difference("RemodAge", "YrSold", "YearRemodAdd"),
    difference("GarageAge", "YrSold", "GarageYrBlt"),
    differs("IsRemodeled", "YearRemodAdd", "YearBuilt"),
    above("Has2ndFlr", "2ndFlrSF"),
    backfill(["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "WoodDeckSF"]),
    strict_sum("TotalPorchSF", ["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "WoodDeckSF"]),
    ratio("BathPerBedroom", "TotalBath", "BedroomAbvGr"),
    ratio("RoomsPerArea", "TotRmsAbvGrd", "GrLivArea"),
    ratio("LotAreaRatio", "LotArea", "GrLivArea"),
    cycle("MoSold", "MoSold", 12),
    cross("Neighborhood_BldgType", "Neighborhood", "BldgType"),
    log1p("Ln_TotalSF", "TotalSF"),
    product("IQ_OQ_GrLiv", "OverallQual", "GrLivArea"),
    product("IQ_OQ_TotalSF", "OverallQual", "TotalSF"),
    winsorize("LotArea_clip", "LotArea", 0.99),
]

# Ordinal levels of the house-sales preset, lowest first.
HOUSE_ORDINALS = {
    "ExterQual": ["Po", "Fa", "TA", "Gd", "Ex"],
    "ExterCond": ["Po", "Fa", "TA", "Gd", "Ex"],
    "BsmtQual": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "BsmtCond": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "BsmtExposure": ["NA", "No", "Mn", "Av", "Gd"],
    "BsmtFinType1": ["NA", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "BsmtFinType2": ["NA", "Unf", "LwQ", "Rec", "BLQ", "ALQ", "GLQ"],
    "HeatingQC": ["Po", "Fa", "TA", "Gd", "Ex"],
    "KitchenQual": ["Po", "Fa", "TA", "Gd", "Ex"],
    "FireplaceQu": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "GarageFinish": ["NA", "Unf", "RFn", "Fin"],
    "GarageQual": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "GarageCond": ["NA", "Po", "Fa", "TA", "Gd", "Ex"],
    "PoolQC": ["NA", "Fa", "TA", "Gd", "Ex"],
    "Fence": ["NA", "MnWw", "GdWo", "MnPrv", "GdPrv"],
    "Functional": ["Sal", "Sev", "Maj2", "Maj1", "Mod", "Min2", "Min1", "Typ"],
    "PavedDrive": ["N", "P", "Y"],
    "Street": ["Grvl", "Pave"],
    "Alley": ["NA", "Grvl", "Pave"],
    "CentralAir": ["N", "Y"],
}

# Columns of the house-sales preset that may be target encoded.
HOUSE_TARGET_ENCODED = [
    "Neighborhood", "MSZoning", "Exterior1st", "Exterior2nd", "SaleType", "SaleCondition",
]
