"""Deep slices by distributed selection: a few counting passes find the range that holds the slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bins of one counting pass, and rows of a range that needs no further pass.
BINS, SMALL = 4096, 100_000

_LEAST = -(1 << 63)
#: Bytes of a text that one number holds, and numbers of a text.
_CHUNK, _CHUNKS = 7, 8


def _digits(name: str, kind: T.DataType) -> list[Column]:
    """Numbers that never contradict the order of a column; rows that all of them leave equal may still differ."""
    value = F.col(name)
    if isinstance(kind, T.DateType):
        return [F.unix_date(value).cast("bigint")]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.unix_micros(value.cast("timestamp"))]
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return [value.cast("bigint")]
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        wide = F.least(F.greatest(value.cast("double"), F.lit(-9.2e18)), F.lit(9.2e18))
        whole = F.floor(wide)
        return [whole, F.floor((wide - whole) * (1 << 52)).cast("bigint")]
    if isinstance(kind, T.StringType):
        raw = value.cast("binary")
        part = lambda i: F.rpad(F.hex(F.substring(raw, 1 + _CHUNK * i, _CHUNK)), 2 * _CHUNK, "0")
        return [F.when(value.isNotNull(), F.conv(part(i), 16, 10).cast("bigint")) for i in range(_CHUNKS)]
    raise TypeError(f"{name}: no order by {kind.simpleString()}")


class Selection:
    """Rows of a table by their rank in an order; ranks count from 0, nulls come first."""

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.rows, self.order = df, list(order)
        #: (column, number) in order; only the ordered columns are read by the counting passes.
        self.steps = [(name, F.coalesce(d, F.lit(_LEAST))) for name in order for d in _digits(name, df.schema[name].dataType)]
        self.keys = df.select(*dict.fromkeys(order))

    def locate(self, rank: int) -> tuple[list[tuple[int, int]], int]:
        """Bounds of the numbers, one by one, of a small range that holds the rank, and the rank of its first row.

        Each pass counts the rows of ``BINS`` even bins (combined in map tasks) and goes on in the one
        that holds the rank; a single value with too many rows goes on in the next number. The range stays larger
        where a column differs beyond its numbers (texts that are alike for long), or rows are equal in all.
        """
        rows, before, bounds, last = self.keys, 0, [], None
        for name, digit in self.steps:
            if last not in (None, name) and not self._single(rows, last):
                break
            last = name
            ends = rows.agg(F.min(digit).alias("low"), F.max(digit).alias("high"), F.count("*").alias("n")).first()
            low, high, n = ends["low"], ends["high"], ends["n"]
            if not n:
                break
            while n > SMALL and low < high:
                # Not wider than a bigint may hold, whatever the ends.
                width = -(-(high - low + 1) // BINS)
                wide = [x.cast("decimal(20,0)") for x in (digit, F.lit(low), F.lit(width))]
                place = F.call_function("div", wide[0] - wide[1], wide[2])
                inside = rows.where(digit.between(low, high))
                counts = sorted((r["bin"], r["n"]) for r in inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n")).collect())
                for at, n in counts:
                    if before + n > rank or at == counts[-1][0]:
                        break
                    before += n
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
            bounds.append((low, high))
            rows = rows.where(digit.between(low, high))
            if n <= SMALL:
                break
        return bounds, before

    @staticmethod
    def _single(rows: DataFrame, name: str) -> bool:
        """Whether a column has one value, or only nulls."""
        seen = rows.agg(F.min(name).eqNullSafe(F.max(name)).alias("one"), F.count(name).alias("known"), F.count("*").alias("n")).first()
        return seen["one"] and seen["known"] in (0, seen["n"])

    def slice(self, start: int, n: int) -> DataFrame:
        """The ``n`` rows from rank ``start`` on, in order."""
        first, before = self.locate(start)
        last, _ = self.locate(start + n - 1)
        if not first:
            return self.rows.limit(0)
        # No row before the slice's own range is sorted, and few within it stand before the slice.
        return self.between(first, last).orderBy(*self.order).offset(start - before).limit(n)

    def between(self, first: list[tuple[int, int]], last: list[tuple[int, int]]) -> DataFrame:
        """Rows from the lower end of one range to the upper end of another."""
        digits = lambda bounds: F.struct(*(d for (_, d), _ in zip(self.steps, bounds)))
        low = F.struct(*(F.lit(x).cast("bigint") for x, _ in first))
        high = F.struct(*(F.lit(x).cast("bigint") for _, x in last))
        return self.rows.where((digits(first) >= low) & (digits(last) <= high))


def deep_slice(df: DataFrame, order: Sequence[str], start_position: int, max_rows: int) -> DataFrame:
    """One slice of the ordered rows, however deep; positions count from 1.

    The two keys that bound the slice are found by counting; then only the rows between them are
    sorted, so no task holds the rows before the slice.
    """
    if start_position < 1 or max_rows < 1:
        return df.limit(0)
    return Selection(df, order).slice(start_position - 1, max_rows)
