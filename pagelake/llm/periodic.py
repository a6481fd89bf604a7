"""Periodic runs: stretches of words that repeat with a period, found on tiles of every scale.

A run is a stretch of words with smallest period q and at least ``EXPONENT`` periods (``LEAST`` words) that neither
neighbour extends. Periods are taken by octaves [s, 2s). Over tiles of s words, q in that octave: a run
covers two tiles in a row at least, on which every word equals the one q further on. So each tile is
solved on its own: the periods that match all over it, and how far each goes on to the left and to the right of the tile's
boundaries (the values of the Z-functions there, up to the tile's size). All tiles of a batch, and of a whole octave, are
solved at once on prefix sums of word hashes, and each fragment that comes out is compared word by word. A period
whose block is itself a power is left to its root.

Fragments (document, period, from, to) are shuffled by document and period and stitched where they
touch. A document of over ``LONG_BYTES`` is cut, before anything else, into overlapping stretches of tiles per octave, which are dealt over
all tasks; shorter ones are solved where they are read, with fragments of a task joined first.

Defined results: words lie between spaces, tabs, line feeds, vertical tabs, form feeds and carriage
returns; a null or empty text has no words and no runs; each row is a document of its own, whatever its
id; an empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.stage import written
from pagelake.llm.textbits import mix, ranges, slices_by_bytes

#: Periods a run has at least, and words.
EXPONENT, LEAST = 4, 6
#: Text bytes solved at once, and those of a document from which it is cut.
BATCH_BYTES, LONG_BYTES = 1 << 20, 1 << 22
#: Words of a stretch of a long document, and the last octave of those that share stretches.
STRETCH, SMALL = 1 << 16, 12
#: Tile and period pairs tested at once, and words compared.
AT_ONCE = 1 << 19

#: Fixed values of the second hash: a prime and a base below it.
_PRIME, _BASE = 2_147_483_647, 1_103_515_245


class Words:
    """Word numbers with prefix sums that tell whether two windows are equal."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.ids, self.n = ids, n
        value = mix(ids.view(np.uint64) + np.uint64(1))
        self.power = np.ones(n + 1, np.uint64)
        self.power[1:] = np.uint64(0x5851F42D4C957F2D)
        np.multiply.accumulate(self.power, out=self.power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value * self.power[:n], out=self.sums[1:])
        # Sums modulo 2^64 alone can be fooled by some regular texts; a prime cannot by the same ones.
        self.second_power = _powers(n + 1)
        self.second = np.zeros(n + 1, np.uint64)
        np.cumsum((value % np.uint64(_PRIME)) * self.second_power[:n] % np.uint64(_PRIME), out=self.second[1:])

    def alike(self, at: np.ndarray, gap: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Whether ``length`` words from ``at`` equal those ``gap`` further on; all must lie inside."""
        left = (self.sums[at + length] - self.sums[at]) * self.power[gap]
        return left == self.sums[at + gap + length] - self.sums[at + gap]

    def equal(self, at: np.ndarray, gap: np.ndarray, length: np.ndarray) -> np.ndarray:
        """As :meth:`alike`, by both hashes; False where the words do not all lie inside."""
        inside = (at >= 0) & (at + gap + length <= self.n)
        out = np.zeros(len(at), bool)
        at, gap, length = at[inside], gap[inside], length[inside]
        prime = np.uint64(_PRIME)
        left = (self.second[at + length] - self.second[at]) % prime * self.second_power[gap] % prime
        right = (self.second[at + gap + length] - self.second[at + gap]) % prime
        out[inside] = self.alike(at, gap, length) & (left == right)
        return out


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base modulo the prime, by doubling."""
    out = np.ones(n, np.uint64)
    have, step = 1, np.uint64(_BASE)
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % np.uint64(_PRIME)
        have += more
        step = step * step % np.uint64(_PRIME)
    return out


def _full_tiles(words: Words, size: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the tiles in [first, last) on which a period of the octave matches, two in a row at least."""
    # The words after the last tile start may be cut off: then it cannot match.
    last = min(last, words.n - 2 * size + 1)
    starts = np.arange(first, last, size, dtype=np.int64)
    found_at, found_gap = [], []
    gaps = np.arange(size, 2 * size, dtype=np.int64)
    rows = max(1, AT_ONCE // size)
    for i in range(0, len(starts), rows):
        at = starts[i : i + rows]
        fits = at[:, None] + gaps[None, :] + size <= words.n
        if fits.all():
            hit = words.alike(at[:, None], gaps[None, :], size)
        else:
            a, g = np.nonzero(fits)
            hit = np.zeros(fits.shape, bool)
            hit[a, g] = words.alike(at[a], gaps[g], size)
        a, g = np.nonzero(hit)
        found_at.append(at[a])
        found_gap.append(gaps[g])
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, gap = np.concatenate(found_at), np.concatenate(found_gap)
    sure = words.equal(at, gap, np.full(len(at), size, np.int64))
    at, gap = at[sure], gap[sure]
    # Alone between two tiles that do not match, a fragment stays below three periods.
    order = np.lexsort((at, gap))
    at, gap = at[order], gap[order]
    with_next = np.zeros(len(at), bool)
    with_next[:-1] = (gap[1:] == gap[:-1]) & (at[1:] == at[:-1] + size)
    paired = with_next.copy()
    paired[1:] |= with_next[:-1]
    # What lies beyond the first and the last tile is unknown here.
    paired |= (at == first) | (at + size >= last)
    return at[paired], gap[paired]


def _smallest_factors(n: int) -> np.ndarray:
    out = np.arange(n, dtype=np.int64)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            multiples = out[p * p :: p]
            multiples[multiples == np.arange(p * p, n, p)] = p
    return out


def _roots_only(words: Words, at: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Whether the block of ``gap`` words at each place is no power of a shorter one."""
    keep = np.ones(len(at), bool)
    if not len(at):
        return keep
    factor = _smallest_factors(int(gap.max()) + 1)
    rest = gap.copy()
    while (rest > 1).any():
        prime = np.where(rest > 1, factor[rest], 1)
        root = gap // prime
        test = np.flatnonzero(keep & (rest > 1))
        keep[test[words.equal(at[test], root[test], gap[test] - root[test])]] = False
        rest = np.where(rest > 1, rest // prime, 1)
    return keep


def _reach(words: Words, at: np.ndarray, gap: np.ndarray, size: int, backward: bool) -> np.ndarray:
    """The boundary Z-values: how many more words match from ``at`` on, or before it, below twice the size."""
    reach = np.zeros(len(at), np.int64)
    step = size
    while step:
        length = np.full(len(at), step, np.int64)
        place = at - reach - step if backward else at + reach
        reach += np.where(words.equal(place, gap, length), step, 0)
        step //= 2
    return reach


def _checked(words: Words, low: np.ndarray, high: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches on which the words themselves are equal: as given, or what a false hash match leaves of them."""
    lengths = high - low
    ends = np.cumsum(lengths)
    out, start = [], 0
    while start < len(low):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        part, start = slice(start, stop), stop
        places = ranges(low[part], lengths[part])
        owner = np.repeat(np.arange(len(low))[part], lengths[part])
        same = words.ids[places] == words.ids[places + gap[owner]]
        if same.all():
            out.append((low[part], high[part], gap[part]))
            continue
        edge = np.ones(len(same), bool)
        edge[1:] = (same[1:] != same[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], len(same))
        begin, end = begin[same[begin]], end[same[begin]]
        out.append((places[begin], places[end - 1] + 1, gap[owner[begin]]))
    if not out:
        return low, high, gap
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _joined(low: np.ndarray, high: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of one period that touch become one."""
    if not len(low):
        return low, high, gap
    order = np.lexsort((high, low, gap))
    low, high, gap = low[order], high[order], gap[order]
    # The furthest end so far within a period: periods are lifted above each other.
    lift = (gap - gap[0]) * (high.max() + 1)
    furthest = np.maximum.accumulate(high + lift)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] + lift[1:] > furthest[:-1]
    starts = np.flatnonzero(new)
    return low[starts], np.maximum.reduceat(high, starts), gap[starts]


def fragments(ids: np.ndarray, octaves: range, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, period): stretches [low, high) of which every word equals the one a period further on.

    Covers the tiles that start in [first, last), for periods from 2 ** octave. What touches neither end
    of them is complete, and kept only if it makes a run.
    """
    words = Words(ids)
    whole = first == 0 and last is None
    last = words.n if last is None else last
    found = []
    for octave in octaves:
        size = 1 << octave
        if not whole and last - first < size or words.n < EXPONENT * size:
            continue
        at, gap = _full_tiles(words, size, first, last)
        keep = _roots_only(words, at, gap)
        at, gap = at[keep], gap[keep]
        low = at - _reach(words, at, gap, size, True)
        high = at + size + _reach(words, at + size, gap, size, False)
        low, high, gap = _checked(words, *_joined(low, high, gap))
        full = high - low >= least_matches(gap)
        if not whole:
            full |= (low < first + size) | (high > last - size)
        found.append((low[full], high[full], gap[full]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def least_matches(gap):
    """How many words in a row must equal the one a period further on."""
    return np.maximum(LEAST - gap, (EXPONENT - 1) * gap)


def _last_octave(n: int) -> int:
    """The octave of the longest period that a run of ``n`` words can have, -1 for none."""
    return (n // EXPONENT).bit_length() - 1


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by a number of its own, and the texts' starts."""
    numbers: dict[bytes, int] = {}
    out, starts = [], []
    size = 0
    for i, words in enumerate(texts):
        starts.append(size)
        out += [numbers.setdefault(w, len(numbers)) for w in words]
        out.append(-1 - i)
        size += len(words) + 1
    return np.array(out, np.int64), np.array(starts, np.int64)


_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
_SOLVED = """key long, n_words long, fragments array<struct<period: long, low: long, high: long>>, joined_sha256 string, words binary,
first_octave int, last_octave int, tiles_from long, tiles_to long, offset long"""


def _stretches(n: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(first octave, last octave, tiles from, tiles to, first word, end word) that cover a long document."""
    top = _last_octave(n)
    groups = [(0, min(SMALL, top))] + [(k, k) for k in range(SMALL + 1, top + 1)]
    for first, last in groups:
        size = 1 << last
        step = max(STRETCH, 4 * size)
        for low in range(0, n, step):
            high = min(n, low + step)
            # A match may go on for a tile on either side, and is compared with words up to two tiles further on.
            yield first, last, low, high, max(0, low - 2 * size), min(n, high + 6 * size)


def _solver(long_bytes: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        key = (task.partitionId() if task else 0) << 40
        for batch in batches:
            for part in slices_by_bytes(batch, "text", BATCH_BYTES):
                texts = part.column("text")
                split = [t.as_buffer().to_pybytes().split() if t.is_valid else [] for t in texts]
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
                short = [i for i, s in enumerate(sizes) if s <= long_bytes]
                per_row: list[list[dict] | None] = [None] * len(split)
                top = max((_last_octave(len(split[i])) for i in short), default=-1)
                if top >= 0:
                    ids, starts = _numbered([split[i] for i in short])
                    low, high, gap = fragments(ids, range(top + 1))
                    owner = np.searchsorted(starts, low, "right") - 1
                    for o, q, a, b in zip(owner.tolist(), gap.tolist(), (low - starts[owner]).tolist(), (high - starts[owner]).tolist(), strict=True):
                        mine = per_row[short[o]] = per_row[short[o]] or []
                        mine.append({"period": q, "low": a, "high": b})
                rows, columns = [], [[] for _ in range(10)]
                for i, words in enumerate(split):
                    joined = b" ".join(words)
                    whole = joined if per_row[i] or sizes[i] > long_bytes else None
                    made = [(key, len(words), per_row[i], hashlib.sha256(joined).hexdigest(), whole, None, None, None, None, None)]
                    if sizes[i] > long_bytes:
                        for first, last, low, high, a, b in _stretches(len(words)):
                            made.append((key, None, None, None, b" ".join(words[a:b]), first, last, low, high, a))
                    key += 1
                    for row in made:
                        rows.append(i)
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
                types = [pa.int64(), pa.int64(), _FRAGMENTS, pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["key", "n_words", "fragments", "joined_sha256", "words", "first_octave", "last_octave", "tiles_from", "tiles_to", "offset"]
                yield pa.record_batch([part.column("id").take(pa.array(rows, pa.int64())), *map(pa.array, columns, types)], ["id", *names])

    return solve


def _solve_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids, _ = _numbered([r["words"].split()])
            off = r["offset"]
            low, high, gap = fragments(ids, range(r["first_octave"], r["last_octave"] + 1), r["tiles_from"] - off, r["tiles_to"] - off)
            yield pa.record_batch(
                [pa.array([r["key"]] * len(low), pa.int64()), pa.array(gap), pa.array(low + off), pa.array(high + off)],
                ["key", "period", "low", "high"],
            )


def stitched(parts: DataFrame) -> DataFrame:
    """Runs (key, start, length, period) from fragments (key, period, low, high) that touch or overlap."""
    by_period = Window.partitionBy("key", "period").orderBy("low", "high")
    before = F.max("high").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        parts.withColumn("new", F.coalesce((F.col("low") > before).cast("int"), F.lit(1)))
        .withColumn("island", F.sum("new").over(by_period))
        .groupBy("key", "period", "island")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where(F.col("high") - F.col("low") >= F.greatest(LEAST - F.col("period"), (EXPONENT - 1) * F.col("period")))
    )
    # Of several periods of one stretch the smallest is its own.
    return (
        islands.select("key", F.col("low").alias("start"), (F.col("high") - F.col("low") + F.col("period")).alias("length"), "period")
        .groupBy("key", "start", "length")
        .agg(F.min("period").alias("period"))
    )


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for joined, runs in zip(batch.column("words"), batch.column("runs").to_pylist(), strict=True):
            words = joined.as_buffer().to_pybytes().split()
            marks = np.zeros(len(words) + 1, np.int64)
            for run in runs:
                marks[run["start"] + run["period"]] += 1
                marks[run["start"] + run["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(marks[:-1]) == 0)
            texts.append(b" ".join([words[i] for i in kept]))
        yield pa.record_batch(
            [*(batch.column(c) for c in ("id", "n_words", "runs")), pa.array(texts, pa.binary())], ["id", "n_words", "runs", "left"]
        )


def periodic_runs(docs: DataFrame, *, id_column: str = "doc_id", long_bytes: int = LONG_BYTES) -> DataFrame:
    """(``id_column``, n_words, runs, collapsed, collapsed_sha256) of every document.

    ``runs`` are structs of start, length and period by start, then period. ``collapsed`` is the text without the
    words that a run repeats, joined by spaces; null where no run is found and all words stay.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col("text").cast("binary").alias("text"))
    solved = written(texts.mapInArrow(_solver(long_bytes), f"id {kind}, {_SOLVED}"), "periodic-solved")
    rows = solved.where(F.col("n_words").isNotNull())
    cut = solved.where(F.col("n_words").isNull()).select("key", "first_octave", "last_octave", "tiles_from", "tiles_to", "offset", "words")
    spread = cut.repartition("key", "first_octave", "tiles_from")
    of_long = spread.mapInArrow(_solve_stretches, "key long, period long, low long, high long")
    of_short = rows.where(F.col("fragments").isNotNull()).select("key", F.inline("fragments"))
    by_document = (
        stitched(of_short.select(*of_long.columns).unionByName(of_long))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )
    runs_type = "array<struct<start: long, length: long, period: long>>"
    ordered = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    with_runs = (
        rows.where(F.col("words").isNotNull())
        .select("key", "id", "n_words", "words")
        .join(by_document, "key", "left")
        .select("id", "n_words", "words", F.coalesce(ordered, F.array().cast(runs_type)).alias("runs"))
        .mapInArrow(_collapse, f"id {kind}, n_words long, runs {runs_type}, left binary")
        .select("id", "n_words", "runs", F.when(F.size("runs") > 0, F.col("left").cast("string")).alias("collapsed"), F.sha2("left", 256).alias("collapsed_sha256"))
    )
    without = rows.where(F.col("words").isNull()).select(
        "id", "n_words", F.array().cast(runs_type).alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("joined_sha256").alias("collapsed_sha256")
    )
    return without.unionByName(with_runs).withColumnRenamed("id", id_column)
