"""Column roles from the schema alone; no job runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass
class Roles:
    ordinal: list[str] = field(default_factory=list)
    category: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)

    def rows(self) -> list[tuple[str, str]]:
        return [(c, r) for r in ("ordinal", "category", "numeric", "dropped") for c in getattr(self, r)]


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def infer_roles(schema: T.StructType | DataFrame, ordinal=(), exclude=(), roles: dict[str, str] | None = None) -> Roles:
    """Ordinals as listed and present; text columns are categories; numbers are numeric.

    Any other type is dropped. ``roles`` overrides single columns, say a nominal code that is
    stored as a number. ``exclude`` names keys and target.
    """
    schema = schema.schema if isinstance(schema, DataFrame) else schema
    roles = roles or {}
    found = Roles(ordinal=[c for c in ordinal if c in schema.names and c not in exclude and c not in roles])
    for f in schema.fields:
        if f.name in exclude or f.name in found.ordinal:
            continue
        if f.name in roles:
            role = roles[f.name]
        elif isinstance(f.dataType, T.StringType):
            role = "category"
        else:
            role = "numeric" if is_numeric(f.dataType) else "dropped"
        getattr(found, role).append(f.name)
    return found
