"""WARC records and their Merkle fixity audit.

Pages become response records of one archive in page order: a manifest gives each record's number,
offset, length and SHA-256. Over the records of a replica stands a tree: a node of level k covers
``FANOUT ** k`` consecutive records, that is one range of offsets. A leaf hashes its record's digest
and its range, a node its children's hashes and ranges in order, so a replica whose index has moved
differs even where its bytes do not. Each replica has offsets of its own. An audit compares the roots
of two replicas and descends only into the children of nodes that differ, down to the records whose
bytes or offsets differ, and says which of the two it is.

Record numbers come from range partitions written once and the row counts before each; no window
spans the archive. Every level is a written table that is ``FANOUT`` times smaller than the one
below.

Defined results: a null url or html counts as empty; null page_ids come first, equal ones follow
each other; records that one replica lacks differ; an empty table gives an empty tree, no root and
no damage; other columns are ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.llm.stage import written

FANOUT = 16


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's WARC response record."""
    html = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )


def manifest(pages: DataFrame, others: dict[str, Column] | None = None) -> DataFrame:
    """page_id, record_no, offset, length, digest of every record of the archive.

    ``others`` names the record bytes that further replicas hold of the same records; each gives
    columns ``<name>_offset``, ``<name>_length`` and ``<name>_digest``, made in the same pass.
    """
    replicas = {"": record(F.col("page_id"), F.col("url"), F.col("html"))} | {f"{name}_": held for name, held in (others or {}).items()}
    narrow = pages.select(
        "page_id",
        *(F.octet_length(held).cast("long").alias(f"{of}length") for of, held in replicas.items()),
        *(F.sha2(held, 256).alias(f"{of}digest") for of, held in replicas.items()),
        F.monotonically_increasing_id().alias("_tie"),
    )
    ranged = narrow.repartitionByRange("page_id", "_tie").sortWithinPartitions("page_id", "_tie")
    placed = written(ranged.withColumn("_part", F.spark_partition_id()), "warc-records")
    # A partition's rows and bytes: as many rows as partitions, whatever the archive holds.
    counts = [F.count("*").alias("rows")] + [F.sum(f"{of}length").alias(f"{of}length") for of in replicas]
    sums = sorted(tuple(r) for r in placed.groupBy("_part").agg(*counts).collect())
    before, passed = [], [0] * len(counts)
    for part, *held in sums:
        before.append((part, *passed))
        passed = [x + y for x, y in zip(passed, held, strict=True)]
    names = ["_part int", "_rows long"] + [f"_{of}bytes long" for of in replicas]
    bases = pages.sparkSession.createDataFrame(before, ", ".join(names))
    within = Window.partitionBy("_part").orderBy("page_id", "_tie")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = {f"_{of}end": F.sum(f"{of}length").over(so_far) for of in replicas}
    numbered = placed.withColumns({"_no": F.row_number().over(within)} | ends).join(F.broadcast(bases), "_part")
    columns = []
    for of in replicas:
        start = F.col(f"_{of}bytes") + F.col(f"_{of}end") - F.col(f"{of}length")
        columns += [start.alias(f"{of}offset"), F.col(f"{of}length"), F.col(f"{of}digest")]
    return numbered.select("page_id", (F.col("_rows") + F.col("_no") - 1).alias("record_no"), *columns)


@dataclass(frozen=True)
class Tree:
    """Nodes (place, hash, start, end; leaves also digest) by level, records first; the last level is the root."""

    levels: list[DataFrame]

    def root(self) -> str | None:
        top = self.levels[-1].select("hash").head()
        return top["hash"] if top else None


def build_tree(records: DataFrame, replica: str = "") -> Tree:
    """The hash tree over the records of a manifest, for the archive itself or a named replica."""
    of = f"{replica}_" if replica else ""
    start, digest = F.col(f"{of}offset"), F.col(f"{of}digest")
    end = start + F.col(f"{of}length")
    leaves = records.select(
        F.col("record_no").alias("place"), F.sha2(F.concat_ws(":", digest, start, end), 256).alias("hash"), start.alias("start"), end.alias("end"), digest.alias("digest")
    )
    levels = [written(leaves, "warc-level")]
    count = (levels[0].agg(F.max("place").alias("m")).first()["m"] or 0) + 1
    while count > 1:
        below = levels[-1]
        # At most FANOUT children to a node.
        children = F.array_sort(F.collect_list(F.struct("place", "hash", "start", "end")))
        held = F.transform(children, lambda c: F.concat_ws(":", c["hash"], c["start"], c["end"]))
        nodes = below.groupBy(F.expr(f"place div {FANOUT}").alias("parent")).agg(
            F.sha2(F.array_join(held, ","), 256).alias("hash"), F.min("start").alias("start"), F.max("end").alias("end")
        )
        levels.append(written(nodes.withColumnRenamed("parent", "place"), "warc-level"))
        count = -(-count // FANOUT)
    return Tree(levels)


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose hash is not the same in both, or that one lacks; of records, whether the bytes differ."""
    theirs = b.select(*(F.col(c).alias(f"_{c}") for c in b.columns))
    both = a.join(theirs, F.col("place") == F.col("_place"), "full").where(~F.col("hash").eqNullSafe(F.col("_hash")))
    bytes_ = [(~F.col("digest").eqNullSafe(F.col("_digest"))).alias("corrupt")] if "digest" in a.columns else []
    return both.select(*(F.coalesce(c, f"_{c}").alias(c) for c in ("place", "start", "end")), *bytes_)


def audit(a: Tree, b: Tree) -> DataFrame:
    """(place, start, end, corrupt) of the records that differ between two replicas.

    ``corrupt`` is false where only the offsets differ.
    """
    if a.root() == b.root() and len(a.levels) == len(b.levels):
        return a.levels[0].select("place", "start", "end", F.lit(False).alias("corrupt")).limit(0)
    top = max(len(a.levels), len(b.levels))
    suspects = None
    for level in range(top - 1, -1, -1):
        both = [t.levels[level] if level < len(t.levels) else t.levels[-1].drop("digest").limit(0) for t in (a, b)]
        if suspects is not None:
            parents = suspects.select(F.col("place").alias("_parent"))
            both = [x.join(parents, F.expr(f"place div {FANOUT}") == F.col("_parent"), "left_semi") for x in both]
        suspects = written(_differing(*both), "warc-suspects")
    return suspects
