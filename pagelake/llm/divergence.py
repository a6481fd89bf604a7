"""Source divergence audit: how far the term frequencies of two sources of a language lie apart.

Terms are numbered by falling frequency within their language and packed 64 to a word. A group (a source of
a language) keeps, for each count, the bitset of the terms it has so often: rows (language, word,
source, count, bits). The divergence of two sources depends on a term only through its two counts, so
per word the AND of every two bitsets and its popcount give the joint cells of a pair, and each cell is
multiplied by its ``f`` once. Terms that a source lacks have no bitset; their cells follow by
complement, from the sizes of the other source's bitsets and the number of terms in the word.

Neighbours in frequency share a word, so the rare terms, which are nearly all, have few counts a word.
Words are dealt in chunks of 64, sources in blocks of ``SOURCES``: a task compares two blocks over one chunk, never
a whole language. Texts are counted where they are read, in tables of at most ``HELD`` terms.

Arithmetic is exact: p = 1 + floor(10^9 (count + 2) / (N + 2 V)), f = floor((p - q)^2 / (p + q)).

Defined results: a null text, lang or source counts as ''; each row is a document, repeated ones too;
terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; a language without
kept terms has pairs of value 0 and no term rows; ties are ordered by the item's UTF-8 bytes; an empty
table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.stage import written
from pagelake.operators.joins import lookup_join

#: Documents of a language that must have a term, and the ranks of the term report.
MIN_DOCS, TOP_TERMS = 10, 10
#: Scale of the probabilities.
SCALE = 1_000_000_000
#: Terms counted before a task lets them go, and bytes of a text that are cut into terms at once.
HELD, PIECE = 200_000, 1 << 20
#: A chunk has two to this many words, a block so many sources: what one task compares.
CHUNK_BITS, SOURCES = 6, 32

#: Every byte that is no part of a term becomes a space, A-Z its lower case.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces."""
    text = text.translate(_BYTES)
    start = 0
    while start < len(text):
        end = len(text) if len(text) - start <= PIECE else text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            yield pa.record_batch(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[t] for t in terms], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for terms in _terms(text.as_buffer().to_pybytes() if text.is_valid else b""):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from rows()
                held = 0
    yield from rows()


def count_terms(docs: DataFrame, *, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Occurrences (lang, source, term, n, total) of kept terms, and the groups (lang, source, place, n_terms, n_group, n_lang)."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.col("text").cast("binary").alias("text"))
    found = texts.mapInArrow(_count_terms, "lang string, source string, term binary, n long, docs long")
    # One shuffle by (lang, term) serves the sum per source and what a term has in all its language.
    summed = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    kept = (
        summed.withColumns(
            {
                "total": F.sum("n").over(of_term),
                "docs": F.sum("docs").over(of_term),
                "first": F.col("source") == F.min("source").over(of_term),
            }
        )
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    counts = written(kept, "divergence-counts")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = counts.where("first").groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("total").alias("n_lang"))
    groups = (
        texts.select("lang", "source").distinct()
        .join(sizes, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["n_group", "n_terms", "n_lang"])
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )
    return counts.drop("first"), written(groups, "divergence-groups")


def probability(count: Column, n: str) -> Column:
    """1 + floor(SCALE (count + 2) / (n + 2 n_terms)), whole and exact; null without terms."""
    shares = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    of = F.nullif(F.col(n) + 2 * F.col("n_terms"), F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", shares, of) + 1


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitsets of rows sorted by (lang, total, term), and the number of terms of each word (place -1)."""
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 34
    last, number = None, -1
    word_lang: str | None = None
    levels: dict[tuple[int, int, int], int] = {}
    size = 0
    names = ["lang", "word", "place", "count", "p", "bits"]
    out: dict[str, list] = {name: [] for name in names}

    def close():
        nonlocal size
        if size:
            for row in ((-1, 0, 0, size), *((*level, bits) for level, bits in levels.items())):
                values = (word_lang, base + number // 64, *row[:3], row[3] - (1 << 64) if row[3] >> 63 else row[3])
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
        levels.clear()
        size = 0

    def rows() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        made = pa.record_batch([pa.array(out[n], t) for n, t in zip(names, types, strict=True)], names)
        for column in out.values():
            column.clear()
        return made

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "term", "place", "n", "p")]
        for lang, term, place, n, p in zip(*columns, strict=True):
            if (lang, term) != last:
                # A language starts a word of its own.
                if last is None or lang != last[0] or number % 64 == 63:
                    close()
                    number = -(-(number + 1) // 64) * 64
                    word_lang = lang
                else:
                    number += 1
                last = (lang, term)
                size += 1
            level = (place, n, p)
            levels[level] = levels.get(level, 0) | 1 << number % 64
        if len(out["word"]) > 50_000:
            yield rows()
    close()
    yield rows()


def pack(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Bitsets (lang, word, place, count, p, bits); the row of place -1 has the word's number of terms instead."""
    own = groups.select("lang", "source", "place", "n_group", "n_terms")
    rated = lookup_join(counts, own, ["lang", "source"]).select(
        "lang", "total", "term", "place", "n", probability(F.col("n"), "n_group").alias("p")
    )
    # All rows of a term have one range key, so they meet in one task and in order.
    order = [F.col("lang"), F.col("total").desc(), F.col("term")]
    ordered = rated.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(_pack, "lang string, word long, place int, count long, p long, bits long"), "divergence-bits")


def _popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits.view(np.uint64))


def _by_source(cells: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``cells``, sorted by place, summed for each of ``n`` sources."""
    out = np.zeros((n, *cells.shape[1:]), np.int64)
    if len(places):
        starts = np.flatnonzero(np.diff(places, prepend=-1))
        out[places[starts]] = np.add.reduceat(cells, starts, axis=0, dtype=np.int64)
    return out


def _word_sums(size: int, a: tuple, b: tuple, zero_a: np.ndarray, zero_b: np.ndarray) -> np.ndarray:
    """Sums of f over the terms of one word, for each source of one block with each of the other.

    ``a`` and ``b`` are (place, p, bits) of the levels of either block, sorted by place; ``zero_a`` and
    ``zero_b`` what p is for a count of nothing.
    """
    (at_a, p_a, bits_a), (at_b, p_b, bits_b) = a, b
    n_a, n_b = len(zero_a), len(zero_b)
    joint = _popcount(bits_a[:, None] & bits_b[None, :])
    size_a, size_b = _popcount(bits_a).astype(np.int64), _popcount(bits_b).astype(np.int64)
    sums = np.zeros((n_a, n_b), np.int64)
    # Cells where both have the term.
    i, j = np.nonzero(joint)
    np.add.at(sums, (at_a[i], at_b[j]), joint[i, j] * _f(p_a[i], p_b[j]))
    # Those where one lacks it: what is left of the other's bitset.
    shared_a = _by_source(joint.T, at_b, n_b).T
    sums += _by_source((size_a[:, None] - shared_a) * _f(p_a[:, None], zero_b[None, :]), at_a, n_a)
    shared_b = _by_source(joint, at_a, n_a)
    sums += _by_source(((size_b[None, :] - shared_b) * _f(zero_a[:, None], p_b[None, :])).T, at_b, n_b).T
    # And those where both do.
    both = _by_source(shared_a, at_a, n_a)
    neither = size - _by_source(size_a, at_a, n_a)[:, None] - _by_source(size_b, at_b, n_b)[None, :] + both
    return sums + neither * _f(zero_a[:, None], zero_b[None, :])


def _compare(key: tuple, sizes: pa.Table, levels: pa.Table) -> pa.Table:
    """The sums of every pair of sources of two blocks over one chunk of words."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    zeros = {n: np.array(sizes[n][0].as_py(), np.int64) for n in ("zero_low", "zero_high")}
    words, counts = sizes["word"].to_numpy(), sizes["bits"].to_numpy()
    order = np.lexsort((levels["place"].to_numpy(), levels["word"].to_numpy()))
    word, place, p, bits = (np.ascontiguousarray(levels[c].to_numpy()[order]).astype(np.int64) for c in ("word", "place", "p", "bits"))
    block = place // SOURCES
    sums = np.zeros((len(zeros["zero_low"]), len(zeros["zero_high"])), np.int64)
    for w, size in zip(words, counts, strict=True):
        here = slice(*np.searchsorted(word, [w, w + 1]))
        sides = []
        for b in (low, high):
            mine = block[here] == b
            sides.append((place[here][mine] - b * SOURCES, p[here][mine], bits[here][mine]))
        sums += _word_sums(int(size), *sides, zeros["zero_low"], zeros["zero_high"])
    i, j = np.indices(sums.shape)
    i, j = i + low * SOURCES, j + high * SOURCES
    keep = i < j
    return pa.table(
        {
            "lang": pa.array([lang] * int(keep.sum()), pa.string()),
            "low": pa.array(i[keep].astype(np.int32), pa.int32()),
            "high": pa.array(j[keep].astype(np.int32), pa.int32()),
            "value": pa.array(sums[keep], pa.int64()),
        }
    )


def pair_values(bits: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, low, high, value) of every two sources, by their places; pairs without kept terms are missing."""
    blocks = (
        groups.where("n_terms > 0")
        .withColumn("block", F.floor(F.col("place") / SOURCES).cast("int"))
        .groupBy("lang", "block")
        .agg(F.array_sort(F.collect_list(F.struct("place", probability(F.lit(0).cast("bigint"), "n_group").alias("p")))).alias("zero"))
        .select("lang", "block", F.col("zero.p").alias("zero"))
    )
    low = blocks.select("lang", F.col("block").alias("low"), F.col("zero").alias("zero_low"))
    high = blocks.select("lang", F.col("block").alias("high"), F.col("zero").alias("zero_high"))
    of_two = low.join(high, "lang").where("low <= high")
    chunked = bits.withColumn("chunk", F.shiftright("word", CHUNK_BITS))
    # Names of their own, since the levels come from the same table.
    terms = chunked.where("place = -1").select(*(F.col(c).alias(c) for c in ("lang", "chunk", "word", "bits")))
    sizes = terms.join(of_two, "lang")
    n_blocks = blocks.groupBy("lang").agg((F.max("block") + 1).alias("n_blocks"))
    block = F.floor(F.col("place") / SOURCES).cast("int")
    levels = (
        lookup_join(chunked.where("place >= 0"), n_blocks, ["lang"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("lang", "chunk", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "word", "place", "p", "bits")
    )
    by = ["lang", "chunk", "low", "high"]
    parts = sizes.groupBy(*by).cogroup(levels.groupBy(*by)).applyInArrow(_compare, "lang string, low int, high int, value long")
    return parts.groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))


def audit_sources(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every source's distance to each other of its language, and the terms it stands out by."""
    counts, groups = count_terms(docs, min_docs=min_docs)
    values = written(pair_values(pack(counts, groups), groups), "divergence-pairs")

    one = groups.select("lang", "source", F.col("place").alias("low"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("high"))
    pairs = one.join(two, "lang").where("low < high").join(values, ["lang", "low", "high"], "left").na.fill(0, ["value"])
    back = pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = pairs.select("lang", "source", "item", "value").unionByName(back).withColumn("part", F.lit("pair"))

    rated = lookup_join(counts, groups, ["lang", "source"]).withColumns(
        {"p": probability(F.col("n"), "n_group"), "q": probability(F.col("total"), "n_lang")}
    )
    f = F.expr("((p - q) * (p - q)) div (p + q)")
    terms = rated.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), f.alias("value"), F.lit("term").alias("part"))

    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(best_first)) for part in (pairs, terms)]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked[0].select(*columns).unionByName(ranked[1].where(F.col("rank") <= top).select(*columns))
