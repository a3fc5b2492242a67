"""Repeatable random choices: everything is decided by ``md5(seed:key)`` of the row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessel.functions.nulls import col


def row_key(keys: list[str]) -> Column:
    return F.concat_ws("-", *[col(k).cast("string") for k in keys])


def row_hash(keys: list[str] | str, seed: int | str) -> Column:
    keys = [keys] if isinstance(keys, str) else keys
    return F.md5(F.concat(F.lit(f"{seed}:"), row_key(keys)))


def hash_int(hashed: Column, digits: int = 8) -> Column:
    """The first hex digits as a number."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def fold_of(keys: list[str] | str, k: int, seed: int | str = 42) -> Column:
    return (hash_int(row_hash(keys, seed)) % k).cast("int")
