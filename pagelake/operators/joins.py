"""Joins of a large, possibly skewed side with a side that is unique per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.session import settle

# A lookup side is broadcast only when measured to be within both of these.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread over several tasks. Pages are large rows.
HOT_ROWS = 1_000_000
HOT_PAGES = 10_000


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    spread: Sequence[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``facts`` with ``lookup``, which has one narrow row per key.

    The lookup is written to the checkpoint folder once and measured there. If it has at
    most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` bytes it is broadcast, so the
    facts are not shuffled at all. Beyond that the join shuffles, with hot keys split
    (:func:`split_join`).
    """
    watch, measures = _size_watch(lookup)
    lookup = settle(lookup.observe(watch, *measures))
    seen = watch.get
    if seen["n"] <= broadcast_rows and (seen["size"] or 0) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(lookup), list(on), how)
    return split_join(facts, lookup, on, how, spread=spread, hot_rows=hot_rows)


def _size_watch(df: DataFrame) -> tuple[Observation, list[Column]]:
    """Measures of the rows and bytes of ``df``, taken while it is written.

    Nested values count with their JSON length.
    """
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(value), F.lit(0))
    return Observation(), [F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")]


def split_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    spread: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffle join in which a hot key's facts are spread over several tasks.

    A key with ``n`` facts gets ``ceil(n / hot_rows)`` pieces. Its lookup row is
    repeated once per piece and its facts are dealt over the pieces by a hash of their
    ``spread`` columns (all but maps if not given), so no task gets much more than
    ``hot_rows`` rows of one key and a repeated task deals alike. There are at most
    ``count(facts) / hot_rows`` hot keys; the list is broadcast only if measured small.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    on = list(on)
    # A null key matches nothing: its rows go past the join, so they never meet in one task.
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    aside = facts.where(keyless) if how in ("left", "left_anti") else None
    facts = facts.where(~keyless)
    watch, measures = _size_watch(facts.select(*on).withColumn("_pieces", F.lit(1)))
    hot = settle(hot_keys(facts, on, hot_rows).observe(watch, *measures))
    seen = watch.get
    # The list of hot keys grows with the facts; beyond the limits it is joined by shuffle, on its few columns.
    small = seen["n"] <= BROADCAST_ROWS and (seen["size"] or 0) <= BROADCAST_BYTES
    hot = F.broadcast(hot) if small else hot
    pieces = F.coalesce("_pieces", F.lit(1))
    dealt_by = F.xxhash64(*(spread or _hashable(facts)))
    dealt = (
        facts.join(hot, on, "left")
        .withColumn("_piece", F.pmod(dealt_by, pieces).cast("int"))
        .drop("_pieces")
    )
    repeated = (
        lookup.join(hot, on, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    joined = dealt.join(repeated, [*on, "_piece"], how).drop("_piece")
    return joined if aside is None else joined.unionByName(aside, allowMissingColumns=True)


def _hashable(df: DataFrame) -> list[str]:
    return [
        f"`{f.name}`"
        for f in df.schema.fields
        if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()
    ]


def hot_keys(facts: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of pieces each is split into.

    Counted with map-side combine over the key columns alone.
    """
    return (
        facts.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_pieces"))
    )
