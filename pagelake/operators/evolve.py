"""Column types that change from run to run."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """A type that holds values of both: larger numbers, merged structs, else text."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, WHOLE) and isinstance(new, WHOLE):
        return T.LongType()
    if isinstance(old, (*WHOLE, *FRACTION)) and isinstance(new, (*WHOLE, *FRACTION)):
        return T.DoubleType()
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType))
    return T.StringType()


def merged_schema(
    old: T.StructType, new: T.StructType, old_empty: Collection[str] = (), new_empty: Collection[str] = ()
) -> T.StructType:
    """All columns of both. A column without any value on one side has the type of the other."""
    fresh = {f.name: f.dataType for f in new.fields}
    fields = []
    for f in old.fields:
        kind = f.dataType
        if f.name in fresh and f.name not in new_empty:
            kind = fresh[f.name] if f.name in old_empty else widened(kind, fresh[f.name])
        fields.append(T.StructField(f.name, kind))
    known = {f.name for f in old.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with exactly the columns and types of ``schema``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_as(F.col(f"`{f.name}`") if f.name in have else None, have.get(f.name), f.dataType).alias(f.name) for f in schema.fields])


def _as(value: Column | None, have: T.DataType | None, want: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(want)
    if have == want:
        return value
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        inner = {f.name: f.dataType for f in have.fields}
        fields = [_as(value[f.name] if f.name in inner else None, inner.get(f.name), f.dataType).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _as(x, have.elementType, want.elementType))
    return value.try_cast(want)
