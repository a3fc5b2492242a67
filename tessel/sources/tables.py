"""Reading tables, and telling keys, features and target apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.functions.nulls import col, nan_to_null

# Texts that mean "missing" in a delimited or JSON table.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def format_of(path: str) -> str:
    lowered = path.lower().rstrip("/")
    for suffix, name in FORMATS.items():
        if lowered.endswith(suffix):
            return name
    raise ValueError(f"unknown table format: {path} (known: {', '.join(FORMATS)})")


def blank_tokens(df: DataFrame, na_tokens=NA_TOKENS) -> DataFrame:
    """NULL in place of every missing-value token in text columns."""
    tokens = list(na_tokens)
    return df.select(*[
        F.when(~col(f.name).isin(tokens), col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else col(f.name)
        for f in df.schema.fields
    ])


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?[iI]nf(inity)?$"


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns whose present values are all whole numbers, numbers or truth values.

    One aggregation over all text columns.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    checks = []
    for c in texts:
        text = F.trim(col(c))
        checks += [
            F.count(text),
            F.count_if(text.try_cast("bigint").isNull() & text.isNotNull() | text.contains(".")),
            F.count_if(~text.rlike(NUMBER)),
            F.count_if(text.isNull() | ~F.lower(text).isin("true", "false")),
        ]
    row = df.agg(*[e.alias(f"x{i}") for i, e in enumerate(checks)]).first()
    kinds = {}
    for i, c in enumerate(texts):
        present, not_whole, not_number, not_truth = row[4 * i: 4 * i + 4]
        if not_number == 0:
            kinds[c] = "bigint" if present and not_whole == 0 else "double"
        elif not_truth == 0:
            kinds[c] = "boolean"
    return df.select(*[
        F.trim(col(c)).cast(kinds[c]).alias(c) if c in kinds else col(c) for c in df.columns
    ])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_tokens=NA_TOKENS,
    json_lines: bool = False,
    **options,
) -> DataFrame:
    """Read CSV, JSON or Parquet by extension.

    Text formats are read as strings, tokens become NULL, then columns are cast: to ``schema``
    if given, which saves a pass, else to the narrowest number type that fits all values.
    """
    kind = format_of(path)
    if kind == "parquet":
        df = nan_to_null(spark.read.options(**options).parquet(path))
        return df if schema is None else cast_to(df, schema)
    if kind == "csv":
        raw = spark.read.options(header=True, inferSchema=False, **options).csv(path)
    else:
        raw = spark.read.options(multiLine=not json_lines, primitivesAsString=True, **options).json(path)
    df = blank_tokens(raw, na_tokens)
    return nan_to_null(infer_types(df) if schema is None else cast_to(df, schema))


def cast_to(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.select(*[
        (F.trim(col(f.name)) if isinstance(df.schema[f.name].dataType, T.StringType)
         and not isinstance(f.dataType, T.StringType) else col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def drop_ids(df: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Drop the named columns; absent ones are skipped."""
    return df.drop(*[c for c in id_cols or [] if c in df.columns])


def split_features_target(df: DataFrame, target: str | None = None, key: list[str] = (), id_cols=None):
    """``(features, target)`` as two projections; both keep the row key.

    Without a target only the features come back, with ``None``.
    """
    df = drop_ids(df, [c for c in id_cols or [] if c not in key])
    if target is None:
        return df, None
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    features = df.select(*[col(c) for c in df.columns if c != target])
    return features, df.select(*[col(c) for c in [*key, target]])
