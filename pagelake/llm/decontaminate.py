"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item leaks into a document when the document holds at least ``threshold`` of the item's distinct
five-word shingles (of an item with fewer words, its one shingle of all its words). Items are short
and documents long, so resemblance says nothing: what counts is containment, and how many MinHash
values prove a candidate depends on the item's size. Items are therefore partitioned by their
number of shingles (powers of two), and each partition keeps the ``floor((1 - threshold) * largest
size) + 1`` smallest hash values of each of its items. A document that misses none but the allowed
share of an item's shingles cannot miss all of these, so no leak escapes the search; the shingle
sets of each candidate pair are then compared as words.

Items are taken in blocks of ``BLOCK`` rows by item number, each block a measured broadcast and one
pass over the documents, so a benchmark of any size is searched and none is collected whole.

Defined results: words are runs of letters and digits in lower case; null and wordless items or
documents match nothing; repeated items and documents are each reported; a null item_id or doc_id
stays null; empty tables give no pairs; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.shingles import hashed_words, shingle_hashes, shingle_set, words
from pagelake.llm.stage import written
from pagelake.llm.textbits import slices_by_bytes

SHINGLE, THRESHOLD = 5, 0.8

#: Items searched in one pass, and the characters they may have; a block over that is halved.
BLOCK, BLOCK_CHARS = 20_000, 32 << 20

FOUND = "item_id long, n_item long, n_shared long, containment double"


class Sketches:
    """The smallest hash values of each item of a block, by shingle size and item size."""

    def __init__(self, items: list[tuple[int | None, str]], size: int, threshold: float):
        self.threshold = threshold
        self.ids, self.sets = [], []
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            found = words(text)
            if not found:
                continue
            k = min(size, len(found))
            shingles = shingle_set(found, k)
            place = len(self.ids)
            self.ids.append(item_id)
            self.sets.append((k, shingles))
            hashed = shingle_hashes(hashed_words(pa.array([text])), k)[0]
            # The partition's bound on sizes: every item of it keeps as many values as the largest may need.
            largest = 1 << max(len(shingles) - 1, 0).bit_length()
            keep = int((1 - threshold) * largest + 1e-9) + 1
            by_size[k] += [(int(h), place) for h in np.unique(hashed)[:keep]]
        self.index = {}
        for k, pairs in by_size.items():
            hashes = np.array([h for h, _ in pairs], np.uint64)
            places = np.array([p for _, p in pairs], np.int64)
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.index[k] = (hashes[order], places[order], seen)

    def candidates(self, texts: pa.Array) -> set[tuple[int, int]]:
        """(row, item place) pairs that share one of the kept values."""
        pairs: set[tuple[int, int]] = set()
        found = hashed_words(texts)
        for k, (hashes, places, seen) in self.index.items():
            mine, rows = shingle_hashes(found, k)
            near = seen[(mine >> np.uint64(44)).astype(np.int64)]
            mine, rows = mine[near], rows[near]
            low, high = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
            hit = high > low
            for row, a, b in zip(rows[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                pairs.update((row, p) for p in places[a:b].tolist())
        return pairs

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item place, shingles of the item, shared ones) of every pair over the threshold."""
        by_row: dict[int, list[int]] = defaultdict(list)
        for row, place in sorted(self.candidates(texts)):
            by_row[row].append(place)
        out = []
        for row, places in by_row.items():
            found = words(texts[row].as_py())
            sets: dict[int, set] = {}
            for place in places:
                k, item = self.sets[place]
                if k not in sets:
                    sets[k] = shingle_set(found, k)
                shared = len(item & sets[k])
                if shared >= self.threshold * len(item) - 1e-9:
                    out.append((row, place, len(item), shared))
        return out


def _search(block, size: int, threshold: float, columns: list[str]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = Sketches(block.value, size, threshold)
        for batch in batches:
            for part in slices_by_bytes(batch, "text", 1 << 20):
                found = sketches.leaks(part.column("text"))
                if not found:
                    continue
                rows = pa.array([f[0] for f in found])
                yield pa.record_batch(
                    [
                        *(part.column(c).take(rows) for c in columns),
                        pa.array([sketches.ids[f[1]] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.int64()),
                        pa.array([f[3] / f[2] for f in found], pa.float64()),
                    ],
                    [*columns, "item_id", "n_item", "n_shared", "containment"],
                )

    return search


def leaks(docs: DataFrame, benchmark: DataFrame, *, size: int = SHINGLE, threshold: float = THRESHOLD, block: int = BLOCK, keyed: bool = False) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every item that a document holds; ``keyed`` adds the hash of its text."""
    spark = docs.sparkSession
    own = ["doc_id", "text_key"] if keyed else ["doc_id"]
    chosen = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").select(*own, "text")
    numbered = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    total = numbered.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-total["n"] // block), -(-total["chars"] // BLOCK_CHARS))
    if blocks > 1:
        # Written once, so that a block holds the same items whenever it is read.
        numbered = written(numbered.withColumn("_block", (F.rand(7) * blocks).cast("int")), "benchmark-blocks", partition_by=("_block",))
    found = None
    for number in range(blocks):
        rows = numbered if blocks == 1 else numbered.where(F.col("_block") == number)
        items = [(r["item_id"], r["text"]) for r in rows.select("item_id", "text").collect()]
        sent = spark.sparkContext.broadcast(items)
        doc_type = chosen.schema["doc_id"].dataType.simpleString()
        pairs = chosen.mapInArrow(_search(sent, size, threshold, own), f"doc_id {doc_type}, {'text_key long, ' if keyed else ''}{FOUND}")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item.

    Each row is judged by its own text, whatever its doc_id.
    """
    held = leaks(docs, benchmark, size=size, threshold=threshold, keyed=True)
    held = written(held.select(F.col("doc_id").alias("_leak_doc"), F.col("text_key").alias("_leak_text")).distinct(), "leaking")
    same = F.col("doc_id").eqNullSafe(F.col("_leak_doc")) & (F.xxhash64("text") == F.col("_leak_text"))
    return docs.join(held, same, "left_anti").select(docs.columns)
