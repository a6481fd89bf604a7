"""The landing table of API pages, and a way to land any table as pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.jsonpath import WRITE_OPTIONS, record_texts

PAGES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("resource", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("feed", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("request_key", T.MapType(T.StringType(), T.StringType())),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("link_next", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("body", T.StringType()),
    ]
)
PARTITIONS = ("source", "resource", "run_id")


def read_pages(
    spark: SparkSession,
    path: str,
    source: str | None = None,
    resource: str | None = None,
    run_id: str | None = None,
    *,
    fmt: str = "parquet",
) -> DataFrame:
    """Landed pages; the given values prune partitions."""
    return pick(spark.read.schema(PAGES).format(fmt).load(path), source, resource, run_id)


def pick(
    pages: DataFrame,
    source: str | None = None,
    resource: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Pages of one source, resource or run."""
    for name, value in zip(PARTITIONS, (source, resource, run_id), strict=True):
        if value is not None:
            pages = pages.where(F.col(name) == value)
    return pages


def write_pages(pages: DataFrame, path: str) -> None:
    """Add pages to a landing folder, laid out by source, resource and run."""
    pages.write.mode("append").option("compression", "zstd").partitionBy(*PARTITIONS).parquet(path)


def store_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write pages to a landing folder and read them from there.

    Operators that pass over the pages more than once then read files, pruned by
    resource, instead of making the pages again.
    """
    write_pages(pages, path)
    return read_pages(pages.sparkSession, path)


def make_pages(pages: DataFrame, **fixed: object) -> DataFrame:
    """Rows in the landing shape: given columns, fixed values, and defaults for the rest."""
    defaults = {"run_id": "run-1", "feed": "0", "page_no": 1, "http_status": 200}
    out = []
    for field in PAGES.fields:
        if field.name in fixed:
            value = fixed[field.name]
            value = value if isinstance(value, Column) else F.lit(value)
        elif field.name in pages.columns:
            value = F.col(field.name)
        else:
            value = F.lit(defaults.get(field.name))
        out.append(value.cast(field.dataType).alias(field.name))
    return pages.select(*out)


def land(
    rows: DataFrame,
    *,
    record: Column,
    order: Column,
    page_no: Column,
    feed: Column | None = None,
    envelope: Callable[[Column], Column] | None = None,
    **page: object,
) -> DataFrame:
    """Rows of any table as landed pages of JSON.

    ``record`` is the struct (or JSON-ready value) of one row, ``order`` its order in the
    page. The caller picks ``feed`` and ``page_no`` so that a page is small: rows of a
    page are collected into one body. ``envelope`` wraps the array of records (default:
    a struct with ``data``). Further page columns are given by name.
    """
    wrap = envelope or (lambda items: F.struct(items.alias("data")))
    keyed = rows.select(
        (feed if feed is not None else F.lit("0")).cast("string").alias("feed"),
        page_no.cast("bigint").alias("page_no"),
        F.struct(order.alias("o"), record.alias("r")).alias("item"),
    )
    grouped = keyed.groupBy("feed", "page_no").agg(F.sort_array(F.collect_list("item")).alias("items"))
    body = F.to_json(wrap(F.transform("items", lambda x: x["r"])), WRITE_OPTIONS)
    return make_pages(grouped.withColumn("body", body), **page)


def even_pages(rows: DataFrame, key: list[str], size: int) -> Column:
    """Page number that spreads rows evenly over pages of about ``size`` rows.

    By a hash of a unique key, so no page grows with a frequent value.
    """
    pages = max(1, -(-rows.count() // size))
    return F.pmod(F.xxhash64(*key), F.lit(pages)) + 1


def infer_record(pages: DataFrame, selector: str) -> T.StructType:
    """Record type found in the bodies: a distributed aggregate, one type text comes back.

    A field that is always null, mixed in type or an empty object becomes text.
    """
    texts = pages.select(F.explode(record_texts(F.col("body"), selector)).alias("t"))
    objects = texts.where(F.ltrim("t").startswith("{"))
    found = objects.agg(F.schema_of_variant_agg(F.try_parse_json("t")).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    return _plain(T.DataType.fromDDL(_ddl(found)))


def _ddl(variant_schema: str) -> str:
    """The type text with ``STRUCT`` for ``OBJECT``; quoted names are left alone."""
    parts = variant_schema.split("`")
    return "`".join(p.replace("OBJECT<", "STRUCT<") if i % 2 == 0 else p for i, p in enumerate(parts))


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        if not kind.fields:
            return T.StringType()
        # Of an array that was always empty nothing is known; a later run may find objects in it.
        told = [f for f in kind.fields if f.dataType != T.ArrayType(T.NullType())]
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in told]) if told else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    return kind


def overlay(found: T.StructType, declared: T.StructType) -> T.StructType:
    """Found fields with the declared ones put over them; declared structs are merged."""
    known = {f.name: f.dataType for f in declared.fields}
    fields = []
    for f in found.fields:
        want = known.pop(f.name, f.dataType)
        fields.append(T.StructField(f.name, _over(f.dataType, want)))
    return T.StructType(fields + [T.StructField(n, t) for n, t in known.items()])


def _over(found: T.DataType, want: T.DataType) -> T.DataType:
    if isinstance(found, T.StructType) and isinstance(want, T.StructType):
        return overlay(found, want)
    if isinstance(found, T.ArrayType) and isinstance(want, T.ArrayType):
        return T.ArrayType(_over(found.elementType, want.elementType))
    return want

