"""One row per key, and key reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key by ``order`` (names sort newest first).

    Keeping only row number 1 lets Spark prune every map task to one row per key
    before the shuffle, so a key with very many versions stays cheap.
    """
    by = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def canonical_by(df: DataFrame, key: str, choose: str) -> DataFrame:
    """One row per key: the one with the smallest ``choose``."""
    return latest_by_key(df, [key], [F.col(choose).asc_nulls_last()])


def current_view(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Latest row of every key of an append table, sentinels left out."""
    return latest_by_key(df.dropna(subset=list(keys)), keys, order)


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are repeated or partly null; rows with no key at all are sentinels."""
    nulls = [F.col(k).isNull() for k in keys]
    none = reduce(lambda a, b: a & b, nulls)
    some = reduce(lambda a, b: a | b, nulls)
    return (
        df.where(~none)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("problem", F.when(some, "null_key").when(F.col("n_rows") > 1, "duplicate"))
        .where(F.col("problem").isNotNull())
    )


def union_tables(*frames: DataFrame) -> DataFrame:
    """Rows of several resources that share a table; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
