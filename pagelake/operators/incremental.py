"""Cursor operators. ``start`` is always the mark as it stood when the run began."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagelake.operators.joins import lookup_join
from pagelake.operators.pages import PAGE, POSITION
from pagelake.session import settle

# Fixed value: the floor of a text cursor.
EPOCH_TEXT = "1970-01-01T00:00:00Z"

MISSING = ("raise", "include", "stale")


def _on_missing(cursor: Column, fresh: Column, missing: str) -> Column:
    if missing == "raise":
        absent = F.raise_error(F.lit("cursor value is missing")).cast("boolean")
    elif missing == "include":
        absent = F.lit(True)
    elif missing == "stale":
        absent = F.lit(False)
    else:
        raise ValueError(f"missing must be one of {MISSING}")
    return F.when(cursor.isNull(), absent).otherwise(fresh)


def incremental(
    df: DataFrame,
    cursor: str,
    start: object | None,
    *,
    range_start: str = "open",
    missing: str = "raise",
) -> DataFrame:
    """Rows past the mark: ``cursor > start`` (open) or ``cursor >= start`` (closed).

    The comparison is in the column's own type: text compares as text. ``start`` None
    means no mark yet. ``missing`` says what a null cursor means.
    """
    value = F.col(cursor)
    if start is None:
        fresh = F.lit(True)
    else:
        mark = start if isinstance(start, Column) else F.lit(start)
        fresh = value > mark if range_start == "open" else value >= mark
    if missing == "stale" and start is not None:
        return df.where(fresh)
    return df.where(_on_missing(value, fresh, missing))


def skip_stale(df: DataFrame, cursor: str, start: str) -> DataFrame:
    """Rows past the mark of an unsorted feed; a missing cursor counts as old."""
    return df.where(F.coalesce(F.col(cursor), F.lit("")) > F.lit(start))


def late_rows(df: DataFrame, cursor: str, start: str) -> DataFrame:
    """The rows :func:`skip_stale` drops."""
    return df.where(F.coalesce(F.col(cursor), F.lit("")) <= F.lit(start))


def skip_stale_counted(df: DataFrame, cursor: str, start: str) -> tuple[DataFrame, Observation]:
    """:func:`skip_stale` that reports ``late`` and ``fresh`` counts once the rows were used."""
    watch = Observation()
    fresh = F.coalesce(F.col(cursor), F.lit("")) > F.lit(start)
    seen = df.observe(
        watch, F.count_if(~fresh).alias("late"), F.count_if(fresh).alias("fresh")
    )
    return skip_stale(seen, cursor, start), watch


def take_while_fresh(
    rows: DataFrame,
    cursor: str,
    start: object | None,
    *,
    feed: Sequence[str] = (f"{PAGE}.feed",),
    position: Sequence[str] = (f"{PAGE}.page_no", POSITION),
    missing: str = "stale",
    inclusive: bool = False,
) -> DataFrame:
    """Rows of each newest-first feed before its first old row.

    Old means ``cursor <= start``, or ``<`` with ``inclusive``. The first old position
    of a feed is a minimum (combined map-side, so one long feed is no problem), and
    there is at most one per feed; the rows are then compared with it. With
    ``missing="raise"`` a missing cursor before the first old row fails the job; rows after
    the cut are not looked at.
    """
    if start is None:
        return rows
    value = F.col(cursor)
    old = value < F.lit(start) if inclusive else value <= F.lit(start)
    # A missing cursor that must raise ends the feed like an old row; only the row at the cut is an error.
    old = F.coalesce(old, F.lit(missing != "include"))
    place = F.struct(*[F.col(p).alias(f"p{i}") for i, p in enumerate(position)])
    names = [f"_feed{i}" for i in range(len(feed))]
    keyed = rows.withColumns({n: F.col(f) for n, f in zip(names, feed, strict=True)})
    keyed = keyed.withColumn("_place", place)
    if missing == "raise":
        first = F.min(F.struct(F.col("_place").alias("place"), value.isNull().alias("missing")))
        place = F.when(F.col("_first.missing"), F.raise_error(F.lit("cursor value is missing"))).otherwise(F.lit("")) == ""
        cut = keyed.where(old).groupBy(*names).agg(first.alias("_first")).where(place).select(*names, F.col("_first.place").alias("_cut"))
    else:
        cut = keyed.where(old).groupBy(*names).agg(F.min("_place").alias("_cut"))
    joined = lookup_join(keyed, cut, names, "left", spread=["_place"])
    return joined.where(F.col("_cut").isNull() | (F.col("_place") < F.col("_cut"))).select(
        *[F.col(f"`{c}`") for c in rows.columns]
    )


def high_water(df: DataFrame, cursor: str, by: Sequence[str] = ()) -> DataFrame:
    """Largest cursor value, over all rows or per group."""
    return df.groupBy(*by).agg(F.max(cursor).alias("high_water"))


def or_floor(mark: object | None, floor: object = EPOCH_TEXT) -> object:
    """The stored mark, or the floor on a first run."""
    return floor if mark is None else mark


def ordered_slice(df: DataFrame, order: Sequence[str], start_position: int, max_rows: int) -> DataFrame:
    """One slice of the ordered rows; positions count from 1."""
    return df.orderBy(*order).offset(start_position - 1).limit(max_rows)


def numbered_slices(
    df: DataFrame, order: Sequence[str], max_rows: int, column: str = "slice_no"
) -> DataFrame:
    """Every row with the number (from 1) of the ordered slice it falls in.

    Rows are range-partitioned and sorted, numbered inside their partition and written
    once; the partitions' row counts (one per partition) then give each its offset. No
    task holds more than its range.
    """
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_index", index)
    )
    counts = sorted(
        (r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()
    )
    if not counts:
        return ranged.drop("_part", "_index").withColumn(column, F.lit(1).cast("bigint"))
    sizes = dict(counts)
    offsets = [0]
    for part in range(counts[-1][0]):
        offsets.append(offsets[-1] + sizes.get(part, 0))
    before = F.get(F.lit(offsets).cast("array<bigint>"), F.col("_part"))
    number = F.floor((before + F.col("_index")) / F.lit(max_rows)) + 1
    return ranged.withColumn(column, number.cast("bigint")).drop("_part", "_index")
