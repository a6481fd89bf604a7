"""Exact dedup through an extendible-hash index on shared files.

Texts are equal when they are identical after lower-casing A-Z. The key of a text is the 64-bit
hash of that form. The index is a directory of ``2**depth`` slots, indexed by the leading key bits,
that point at buckets; a bucket over its capacity is split by one more bit, and the directory
doubles when the bucket already uses every bit of it. Each bucket is a folder of Parquet files in
the shared folder. Owner tasks hold contiguous key ranges, so a bucket is written by one owner (two
where a range ends inside it), chain the distinct texts of a colliding key and number the chain.

Copies of a text are combined in map tasks before any shuffle, so a group of copies of any size
reaches the index as one entry and can never overfill a bucket that splitting cannot mend. Keys
that one row holds alone need no comparing; the bytes of all others are compared by grouping on
the normalised text itself.

Defined results: a null text counts as empty; empty texts equal each other; a null doc_id never
stays while its group has another row, and sorts as the smallest id; equal doc_ids of equal texts
are copies like any other, and each row is returned; an empty table gives an empty result; columns
other than doc_id and text are ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.stage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Entries a bucket holds before it is split.
CAPACITY = 50_000

#: Bits by which one pass over the keys looks ahead when overfull buckets are split.
BITS_A_PASS = 8

#: Slots of a directory that is broadcast (12 bytes each); a larger one is joined by its slots.
BROADCAST_SLOTS = 1_000_000

KEY_BITS = 64


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; ``lower`` is the same and quicker where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _leading(key: Column, bits: int) -> Column:
    """The leading ``bits`` bits of a key as a number."""
    return F.lit(0).cast("long") if bits == 0 else F.shiftrightunsigned(key, KEY_BITS - bits)


@dataclass(frozen=True)
class Directory:
    """Buckets as (leading bits, how many bits); together they cover every key once."""

    buckets: tuple[tuple[int, int], ...]

    @property
    def depth(self) -> int:
        return max(bits for _, bits in self.buckets)

    def bucket_of(self, df: DataFrame, key: str, name: str = "bucket") -> DataFrame:
        """Add the bucket number of each key: one lookup for each depth that buckets have."""
        found = F.lit(None).cast("int")
        spark = df.sparkSession
        slots = [
            (prefix << (self.depth - bits), (prefix + 1) << (self.depth - bits), number)
            for number, (prefix, bits) in enumerate(self.buckets)
        ]
        if len(slots) <= 64:
            slot = _leading(F.col(key), self.depth)
            for _, end, number in reversed(slots):
                found = F.when(slot < end, F.lit(number)).otherwise(found)
            return df.withColumn(name, found)
        # One row for each slot, as in a directory page; Spark makes them from the buckets, a few times rows / capacity.
        schema = T.StructType([T.StructField(n, T.LongType()) for n in ("_start", "_end")] + [T.StructField(name, T.IntegerType())])
        page = spark.createDataFrame(slots, schema).select(F.explode(F.sequence("_start", F.col("_end") - 1)).alias("_slot"), name)
        page = F.broadcast(page) if 1 << self.depth <= BROADCAST_SLOTS else page.hint("merge")
        return df.withColumn("_slot", _leading(F.col(key), self.depth)).join(page, "_slot", "left").drop("_slot")


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> Directory:
    """Split overfull buckets until each holds at most ``capacity`` of the distinct ``key`` values.

    Only counts by prefix come to the driver: at most ``2**BITS_A_PASS`` for each overfull bucket.
    """
    done: list[tuple[int, int]] = []
    overfull: list[tuple[int, int]] = [(0, 0)]
    while overfull:
        bits = overfull[0][1]
        ahead = min(bits + BITS_A_PASS, KEY_BITS - 1)
        rows = keys
        if bits:
            wanted = rows.sparkSession.createDataFrame([(p,) for p, _ in overfull], "_parent long")
            rows = rows.withColumn("_parent", _leading(F.col("key"), bits)).join(F.broadcast(wanted), "_parent", "left_semi")
        counts = {r["p"]: r["n"] for r in rows.groupBy(_leading(F.col("key"), ahead).alias("p")).agg(F.count("*").alias("n")).collect()}
        following = []
        for bucket in overfull:
            todo = [bucket]
            while todo:
                prefix, at = todo.pop()
                width = ahead - at
                held = sum(counts.get(p, 0) for p in range(prefix << width, (prefix + 1) << width))
                if held <= capacity or at >= KEY_BITS - 1:
                    done.append((prefix, at))
                elif width == 0:
                    following.append((prefix, at))
                else:
                    todo += [(prefix << 1, at + 1), ((prefix << 1) + 1, at + 1)]
        overfull = following
    depth = max(bits for _, bits in done)
    return Directory(tuple(sorted(done, key=lambda b: b[0] << (depth - b[1]))))


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame, Directory]:
    """Rows (doc_id, key, text_sha256), the bucket files and their directory.

    The bucket files hold an entry for each distinct text: key, chain (its place among the texts of
    its key), text_sha256, keep_id, group_size, bucket.
    """
    docs = docs.select("doc_id", "text")
    text = normalised(F.col("text"))
    rows = written(
        docs.select("doc_id", text.alias("norm")).select("doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256")),
        "exact-rows",
    )
    keys = written(
        rows.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"), F.max("text_sha256").alias("text_sha256")),
        "exact-keys",
    )
    directory = build_directory(keys, capacity)
    shared = keys.where("n > 1").select("key")
    # Only texts whose key another row has are fetched for comparing.
    with_copy = rows.join(shared, "key", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    compared = (
        docs.join(with_copy, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        .select("doc_id", text.alias("norm"))
        .groupBy(F.xxhash64("norm").alias("key"), "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("key", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
        .join(shared, "key", "left_semi")
    )
    alone = keys.where("n = 1").select("key", "text_sha256", "keep_id", F.col("n").alias("group_size"))
    entries = directory.bucket_of(alone.unionByName(compared), "key")
    return rows, written(owned(entries), "exact-index", partition_by=("bucket",)), directory


def owned(entries: DataFrame) -> DataFrame:
    """The entries dealt to owners of key ranges, with their place in the chain of their key.

    The window names bucket and key as the ranges do, so Spark keeps the ranges and shuffles once.
    """
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256", "keep_id")
    return entries.repartitionByRange("bucket", "key").withColumn("chain", F.row_number().over(chain))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Of equal texts the row with the largest doc_id stays.
    """
    rows, index, directory = build_index(docs, capacity)
    looked_up = directory.bucket_of(rows, "key").join(index, ["bucket", "key", "text_sha256"])
    return looked_up.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "bucket",
        "chain",
    )
