"""Staging views over loaded tables: JSON paths, types, block text, associations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.jsonpath import json_field
from pagelake.operators.contract import TYPES


def json_fields(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Values at dotted paths of a JSON text column as text columns."""
    return df.withColumns({name: json_field(F.col(column), path) for name, path in paths.items()})


def typed(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Columns in a declared type; NULL where a value does not convert."""
    return df.withColumns({c: F.col(c).try_cast(TYPES[kind]) for c, kind in kinds.items()})


def block_text(kind: Column, block_json: Column) -> Column:
    """Plain text of a block, which holds its content under the name of its type."""
    content = F.try_element_at(F.from_json(block_json, "map<string,string>"), kind)
    rich = F.from_json(content, "rich_text array<struct<plain_text:string>>")["rich_text"]
    return F.array_join(F.transform(rich, lambda x: x["plain_text"]), "")


def association_rows(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per id in a JSON list column."""
    return df.withColumn(name, F.explode(F.from_json(column, "array<bigint>"))).drop(column)
