"""Which landed runs can hold anything new: the range of cursors of each, and reading only the others.

A request that carries the mark makes an API leave out what is old. On landed pages the same is done
by a manifest: for each (source, resource, run) the least and greatest cursor of its records and how
many have none. Runs are partitions of the landing folder, so joining pages with the runs that are
worth reading lets Spark prune the others before a file is opened (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.jsonpath import record_texts
from pagelake.operators.joins import BROADCAST_ROWS
from pagelake.session import settle
from pagelake.sources.landing import PARTITIONS
from pagelake.specs import Cursor, Resource, Source

MANIFEST = "source string, resource string, run_id string, pages bigint, records bigint, missing bigint, least string, greatest string"


def typed_mark(value: Column, kind: str) -> Column:
    """A cursor as it stands in a body or a mark, in the type it is compared in."""
    if kind == "bigint":
        return value.try_cast("bigint")
    if kind == "timestamp":
        # Epoch seconds or text.
        return F.coalesce(F.timestamp_seconds(value.try_cast("double")), F.try_to_timestamp(value))
    return value


def _as_text(value: Column, kind: str) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if kind == "timestamp" else value.cast("string")


def run_ranges(pages: DataFrame, resource: Resource) -> DataFrame:
    """The manifest rows of a resource: one aggregate over its pages, combined in map tasks."""
    kind = resource.cursor.kind
    path = "$." + resource.cursor.path
    texts = pages.where(F.col("resource") == (resource.pages_of or resource.name)).select(
        *PARTITIONS, record_texts(F.col("body"), resource.selector).alias("_records")
    )
    # A page without records, or that cannot be read, still counts as a page of its run.
    each = texts.select(*PARTITIONS, F.posexplode_outer("_records").alias("_at", "_record"))
    cursor = typed_mark(F.get_json_object("_record", path), kind)
    return each.groupBy(*PARTITIONS).agg(
        F.count_if(F.coalesce(F.col("_at"), F.lit(0)) == 0).alias("pages"),
        F.count("_record").alias("records"),
        F.count_if(F.col("_record").isNotNull() & cursor.isNull()).alias("missing"),
        _as_text(F.min(cursor), kind).alias("least"),
        _as_text(F.max(cursor), kind).alias("greatest"),
    )


def build_manifest(pages: DataFrame, source: Source) -> DataFrame:
    """Manifest of every resource of a source that has a cursor; add the rows of new runs to those kept before."""
    found = [run_ranges(pages.where(F.col("source") == source.name), r) for r in source.resources if r.cursor is not None and r.build is None]
    out = found[0] if found else pages.sparkSession.createDataFrame([], MANIFEST)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def worth_reading(manifest: DataFrame, cursor: Cursor, mark: Column | object | None) -> DataFrame:
    """Runs that may hold a record past the mark, or one without a cursor."""
    if mark is None:
        return manifest
    greatest = typed_mark(F.col("greatest"), cursor.kind)
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    past = greatest >= mark if cursor.range_start == "closed" else greatest > mark
    return manifest.where(F.coalesce(past, F.lit(False)) | (F.col("missing") > 0))


def landed_runs(pages: DataFrame) -> DataFrame:
    """(source, resource, run_id) of the landing folder, from its listing: no file is opened."""
    spark, setting = pages.sparkSession, "spark.sql.optimizer.metadataOnly"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return settle(pages.select(*PARTITIONS).distinct())
    finally:
        spark.conf.set(setting, before)


def prune_runs(pages: DataFrame, manifest: DataFrame, resource: Resource, mark: Column | object | None) -> DataFrame:
    """``pages`` of a resource without the runs that hold nothing past the mark.

    A run that the manifest does not know is read. Up to ``BROADCAST_ROWS`` runs the files of the others are
    not opened; beyond, the runs are joined by shuffle.
    """
    if mark is None or resource.cursor is None:
        return pages
    on = list(PARTITIONS)
    known = settle(manifest.where(F.col("resource") == (resource.pages_of or resource.name)).select(*on, "greatest", "missing"))
    stale = known.join(worth_reading(known, resource.cursor, mark).select(*on), on, "left_anti")
    fresh = settle(landed_runs(pages).join(stale.select(*on), on, "left_anti"))
    if fresh.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return pages.join(fresh, on, "left_semi")
    # The filter tells the optimizer that this side is selective.
    return pages.join(F.broadcast(fresh.where(F.col("run_id") >= "")), on, "left_semi")
