"""URL filters: host and path rules looked up in a Bloom filter cascade.

A rule names a host and the beginning of a path, and allows or blocks what it fits: the host and all
its subdomains, where the path begins so. The keys a URL could be listed under are the label suffixes
of its host with the beginnings of its path, of the shapes (labels, path length) that rules have. All
keys of all pages are the universe the cascade must be right on:

* level 1 encodes the listed keys, with an error rate fitted to the size of the universe;
* one scan gathers the distinct keys of the corpus that pass it; those not listed are level 2;
* listed keys that pass level 2 are level 3, unlisted ones that pass level 3 are level 4, and so on
  until a level lets no key of the other side through.

The first level that a key fails tells whether it is listed, so every page is judged by bit tests alone:
no join, and no error on any key of the corpus. Keys are cut into shards of about ``SHARD_KEYS`` by their hash; a
shard's levels are built in one task from its listed keys and what passed. Filters are broadcast in
blocks of at most ``BLOCK_BYTES``; a longer list is tested block after block.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in
lower case, the path what follows it up to ``?``, ``#`` or the end; both are empty for a null URL or one
without ``://``. The longest rule (host and path together, then the longer host) wins; the same rule
listed both ways blocks. Rules of which host, path or verdict is null, or the verdict is another word,
fit nothing; repeated rules count once; an empty list gives every page the default. Columns of the
pages named like a result are replaced; repeated pages are each judged; no pages give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.stage import written
from pagelake.llm.textbits import mix

ALLOW, BLOCK = "allow", "block"
#: Listed keys of a shard, and the filter bytes that one pass over the pages broadcasts.
SHARD_KEYS, BLOCK_BYTES = 1 << 20, 64 << 20
#: A cascade halves what is left at each level; one that goes on so long has two keys of one hash.
MOST_LEVELS = 128

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

_LEVEL = "verdict string, shard long, level int, n_bits long, n_hashes int, bits binary"


def host_of(url: Column) -> Column:
    """The host of a URL, in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """The path of a URL as it stands."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class Bits:
    """A Bloom filter over keys of two hash numbers; the level salts both."""

    def __init__(self, level: int, n_bits: int, n_hashes: int, data: np.ndarray):
        self.level, self.n_bits, self.n_hashes, self.data = level, n_bits, n_hashes, data

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray, level: int, error: float) -> Bits:
        """The filter of these keys that lets others through at the rate ``error``."""
        n_hashes = max(1, math.ceil(-math.log2(error)))
        n_bits = max(8, math.ceil(n_hashes * len(first) / math.log(2)))
        made = cls(level, n_bits, n_hashes, np.zeros(-(-n_bits // 8), np.uint8))
        for place in made._places(first, second):
            np.bitwise_or.at(made.data, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        return made

    def _places(self, first: np.ndarray, second: np.ndarray) -> Iterator[np.ndarray]:
        salt = mix(np.array([self.level], np.uint64))
        start, step = mix(first ^ salt), mix(second ^ salt) | np.uint64(1)
        for _ in range(self.n_hashes):
            yield start % np.uint64(self.n_bits)
            start = start + step

    def passes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which keys have all their bits set."""
        out = np.ones(len(first), bool)
        for place in self._places(first, second):
            out &= (self.data[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


class Cascade:
    """Alternating levels over one shard of keys."""

    def __init__(self, levels: list[Bits]):
        self.levels = sorted(levels, key=lambda b: b.level)

    def listed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which keys are listed: those that stop at an even level, or pass an odd last one."""
        out = np.zeros(len(first), bool)
        left = np.arange(len(first))
        for bits in self.levels:
            through = bits.passes(first[left], second[left])
            out[left[~through]] = bits.level % 2 == 0
            left = left[through]
        out[left] = len(self.levels) % 2 == 1
        return out


def _as_bits(rows: list[dict]) -> dict[tuple[str, int], Cascade]:
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["verdict"], r["shard"]].append(Bits(r["level"], r["n_bits"], r["n_hashes"], np.frombuffer(r["bits"], np.uint8)))
    return {shard: Cascade(levels) for shard, levels in by_shard.items()}


def _unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) if isinstance(column, pa.Array) else _unsigned(column.combine_chunks())


def _rows(found: list[Bits], verdict: str, shard: int) -> pa.Table:
    return pa.table(
        {
            "verdict": pa.array([verdict] * len(found), pa.string()),
            "shard": pa.array([shard] * len(found), pa.int64()),
            "level": pa.array([b.level for b in found], pa.int32()),
            "n_bits": pa.array([b.n_bits for b in found], pa.int64()),
            "n_hashes": pa.array([b.n_hashes for b in found], pa.int32()),
            "bits": pa.array([b.data.tobytes() for b in found], pa.binary()),
        }
    )


def _first_level(error: float):
    def build(key: tuple, keys: pa.Table) -> pa.Table:
        verdict, shard = key[0].as_py(), key[1].as_py()
        return _rows([Bits.of(_unsigned(keys["h1"]), _unsigned(keys["h2"]), 1, error)], verdict, shard)

    return build


def _later_levels(error: float):
    def build(key: tuple, listed: pa.Table, passed: pa.Table) -> pa.Table:
        verdict, shard = key[0].as_py(), key[1].as_py()
        mine = (_unsigned(listed["h1"]), _unsigned(listed["h2"]))
        known = set(zip(listed["host"].to_pylist(), listed["path"].to_pylist(), strict=True))
        wrong = [k not in known for k in zip(passed["host"].to_pylist(), passed["path"].to_pylist(), strict=True)]
        other = (_unsigned(passed["h1"])[wrong], _unsigned(passed["h2"])[wrong])
        # Built again from the same keys rather than carried along.
        levels = [Bits.of(*mine, 1, error)]
        inside, outside = other, mine
        while len(inside[0]):
            if len(levels) == MOST_LEVELS:
                raise ValueError(f"two keys of shard {shard} share both hashes")
            levels.append(Bits.of(*inside, len(levels) + 1, 0.5))
            through = levels[-1].passes(*outside)
            inside, outside = (outside[0][through], outside[1][through]), inside
        return _rows(levels, verdict, shard)

    return build


def with_keys(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """``urls`` (with host and path) and ``_keys``: what each could be listed under, the longest first."""
    # Label by label from the right, and by path length, only where the URL has so many.
    chosen = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes))
    found = F.expr(
        """transform(
             filter(_shapes, s -> length(_host) > 0 and _dots + 1 >= s.labels and length(_path) >= s.chars),
             s -> struct(substring_index(_host, '.', -s.labels) as host, substring(_path, 1, s.chars) as path))"""
    )
    order = F.expr(
        """sort_array(transform(_found, k -> struct(
             -length(k.host) - length(k.path) as size, -length(k.host) as host_size, k.host as host, k.path as path,
             xxhash64(k.host, k.path) as h1, xxhash64(k.path, k.host) as h2)))"""
    )
    dots = F.length("_host") - F.length(F.replace("_host", F.lit("."), F.lit("")))
    return (
        urls.withColumns({"_shapes": chosen, "_dots": dots})
        .withColumn("_found", found)
        .withColumn("_keys", order)
        .drop("_shapes", "_dots", "_found")
    )


def _passing(sent, n_shards: int, verdict: str):
    """Keep the keys of a batch that pass the first level, each once."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {shard: c.levels[0] for (_, shard), c in _as_bits(sent.value).items()}
        for batch in batches:
            keys = pc.list_flatten(batch.column("_keys"))
            first, second = _unsigned(keys.field("h1")), _unsigned(keys.field("h2"))
            _, once = np.unique(first, return_index=True) if len(first) else (None, np.zeros(0, np.int64))
            # Keys of one h1 that differ in h2 are rare but must all be seen.
            if len(once) < len(first):
                _, once = np.unique(np.stack([first, second]), axis=1, return_index=True)
            first, second = first[once], second[once]
            shard = (first % np.uint64(n_shards)).astype(np.int64)
            through = np.zeros(len(first), bool)
            for s in np.unique(shard):
                if s in filters:
                    at = np.flatnonzero(shard == s)
                    through[at] = filters[s].passes(first[at], second[at])
            taken = keys.take(pa.array(once[through]))
            yield pa.record_batch(
                [
                    pa.array([verdict] * len(taken), pa.string()),
                    pa.array(shard[through], pa.int64()),
                    taken.field("host"),
                    taken.field("path"),
                    taken.field("h1"),
                    taken.field("h2"),
                ],
                ["verdict", "shard", "host", "path", "h1", "h2"],
            )

    return keep


def _blocks(levels: DataFrame) -> list[list[dict]]:
    """The filters in blocks of whole shards, of at most ``BLOCK_BYTES`` but for a single shard."""
    sizes = levels.groupBy("verdict", "shard").agg(F.sum(F.octet_length("bits")).alias("size")).orderBy("verdict", "shard").collect()
    blocks, room = [], 0
    for r in sizes:
        if not blocks or r["size"] > room:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append((r["verdict"], r["shard"]))
        room -= r["size"]
    return blocks


def _sent(levels: DataFrame, shards: list[tuple[str, int]]):
    spark = levels.sparkSession
    by_verdict = defaultdict(list)
    for verdict, shard in shards:
        by_verdict[verdict].append(shard)
    chosen = F.lit(False)
    for verdict, numbers in by_verdict.items():
        chosen |= (F.col("verdict") == verdict) & F.col("shard").between(min(numbers), max(numbers))
    return spark.sparkContext.broadcast([r.asDict() for r in levels.where(chosen).collect()])


class UrlFilter:
    """A list of rules as filters that are exact on the keys of the pages it was built for."""

    def __init__(self, levels: DataFrame, shapes: list[tuple[int, int]], shards: dict[str, int]):
        self.levels, self.shapes, self.shards = levels, shapes, shards

    @classmethod
    def build(cls, pages: DataFrame, rules: DataFrame, url: str = "url", *, shard_keys: int = SHARD_KEYS) -> UrlFilter:
        """Encode ``rules`` (host, path, verdict) over all keys of ``pages``."""
        given = F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK)
        labels = F.size(F.split("host", r"\."))
        hashes = {"h1": F.xxhash64("host", "path"), "h2": F.xxhash64("path", "host")}
        rules = written(rules.where(given).select("verdict", "host", "path").distinct().withColumns(hashes), "url-rules")
        # A host has at most 127 labels and a URL some thousand characters, so there are few shapes however long the list.
        shapes = sorted((r[0], r[1]) for r in rules.select(labels, F.length("path")).distinct().collect())
        counts = {r["verdict"]: r["n"] for r in rules.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
        shards = {v: -(-n // shard_keys) for v, n in counts.items()}
        if not counts:
            return cls(rules.sparkSession.createDataFrame([], _LEVEL), [], {})

        urls = pages.select(host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
        keys = with_keys(urls, shapes).select("_keys")
        universe = keys.select(F.explode("_keys.h1").alias("h1")).agg(F.approx_count_distinct("h1")).first()[0]
        tables = []
        for verdict, n in counts.items():
            # Sized so that about n / sqrt(2) unlisted keys pass, however many there are.
            error = min(0.5, n * math.sqrt(0.5) / max(1, universe))
            mine = rules.where(F.col("verdict") == verdict).withColumn("shard", F.pmod("h1", F.lit(1)) if shards[verdict] == 1 else _shard("h1", shards[verdict]))
            first = written(mine.groupBy("verdict", "shard").applyInArrow(_first_level(error), _LEVEL), "url-level")
            passed = None
            for block in _blocks(first):
                through = keys.mapInArrow(
                    _passing(_sent(first, block), shards[verdict], verdict),
                    "verdict string, shard long, host string, path string, h1 long, h2 long",
                )
                passed = through if passed is None else passed.unionByName(through)
            by = ["verdict", "shard"]
            tables.append(
                mine.groupBy(*by).cogroup(passed.distinct().groupBy(*by)).applyInArrow(_later_levels(error), _LEVEL)
            )
        levels = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
        return cls(written(levels, "url-cascade"), shapes, shards)

    def judge(self, pages: DataFrame, url: str = "url", *, default: str = ALLOW) -> DataFrame:
        """``pages`` with host, path, the longest rule that fits (else null) and the verdict."""
        out = pages.drop("host", "path", "rule", "verdict")
        out = out.withColumns({"_host": host_of(F.col(url)), "_path": path_of(F.col(url))})
        best, rule, verdict = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(default)
        if self.shapes:
            out = with_keys(out, self.shapes)
            first, second = F.col("_keys.h1"), F.col("_keys.h2")
            tests = [_tested(_sent(self.levels, block), self.shards)(first, second) for block in _blocks(self.levels)]
            out = out.withColumn("_best", tests[0] if len(tests) == 1 else F.least(*tests))
            best = F.col("_best")
            key = F.get("_keys", F.floor(best / 2).cast("int"))
            rule = F.when(best.isNotNull(), F.concat(key["host"], key["path"]))
            verdict = F.when(best.isNull(), F.lit(default)).when(best % 2 == 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
        added = {"host": F.col("_host"), "path": F.col("_path"), "rule": rule, "verdict": verdict}
        return out.withColumns(added).drop("_host", "_path", "_keys", "_best")


def _shard(column: str, n: int) -> Column:
    """The hash as an unsigned number modulo ``n``."""
    high = F.shiftrightunsigned(column, 1)
    low = F.col(column).bitwiseAND(1)
    return F.pmod(F.pmod(high, F.lit(n)) * 2 + low, F.lit(n))


def _tested(sent, shards: dict[str, int]):
    """A column of twice the place of the first listed key, and one if it is allowed; null for none."""

    @F.arrow_udf("int")
    def test(first: pa.Array, second: pa.Array) -> pa.Array:
        filters = _as_bits(sent.value)
        lengths = pc.fill_null(pc.list_value_length(first), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        a, b = _unsigned(pc.list_flatten(first)), _unsigned(pc.list_flatten(second))
        row = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(a)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        best = np.full(len(lengths), np.iinfo(np.int32).max, np.int64)
        for verdict, n in shards.items():
            shard = (a % np.uint64(n)).astype(np.int64)
            for s in np.unique(shard):
                if (verdict, s) in filters:
                    at = np.flatnonzero(shard == s)
                    hit = at[filters[verdict, s].listed(a[at], b[at])]
                    np.minimum.at(best, row[hit], 2 * place[hit] + (verdict == ALLOW))
        none = best == np.iinfo(np.int32).max
        return pa.array(np.where(none, 0, best).astype(np.int32), pa.int32(), mask=none)

    return test


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", *, default: str = ALLOW) -> DataFrame:
    """Every page with the verdict of the longest rule that fits its URL, or the default."""
    return UrlFilter.build(pages, rules, url).judge(pages, url, default=default)
