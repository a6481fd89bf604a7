"""Column contracts: declared columns, sentinels and templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.jsonpath import WRITE_OPTIONS

# Declared type names and the Spark types they stand for.
TYPES = {
    "text": "string",
    "bigint": "bigint",
    "bool": "boolean",
    "timestamp": "timestamp",
    "decimal": "decimal(38,9)",
    "json": "string",
}


def columns(**by_type: Sequence[str]) -> dict[str, str]:
    """Contract from lists of columns per type: ``columns(text=["a"], bigint=["b"])``."""
    unknown = set(by_type) - set(TYPES)
    if unknown:
        raise ValueError(f"unknown column types: {sorted(unknown)}")
    return {name: kind for kind, names in by_type.items() for name in names}


def cast_to(value: Column, have: T.DataType, kind: str) -> Column:
    """``value`` in the declared type; NULL where it does not convert."""
    want = TYPES[kind]
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value, WRITE_OPTIONS)
        return text if want == "string" else F.lit(None).cast(want)
    if have.simpleString() == want:
        return value
    if want == "timestamp" and isinstance(have, T.NumericType):
        return F.lit(None).cast(want)
    return value.try_cast(want)


def ensure_columns(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Every declared column, nullable and in its type; other columns stay as they are."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: cast_to(F.col(f"`{name}`"), have[name], kind)
            if name in have
            else F.lit(None).cast(TYPES[kind])
            for name, kind in contract.items()
        }
    )


def with_sentinel(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """An empty result becomes exactly one all-NULL row; any other stays as it is.

    A global count over at most one row gives the row, so nothing is counted in full.
    """
    missing = [k for k in key if k not in df.columns]
    df = df.withColumns({k: F.lit(None).cast("string") for k in missing})
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    empty = df.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(*nulls)
    return df.unionByName(empty)


def drop_sentinel(df: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """Rows with a key."""
    return df.dropna(how="any", subset=list(key))


def align_to_template(df: DataFrame, template: Mapping[str, str]) -> DataFrame:
    """Exactly the template's columns in its order, missing ones NULL."""
    return ensure_columns(df, template).select(*template)
