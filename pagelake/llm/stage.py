"""Written intermediate tables, which cut lineage and survive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagelake.session import scratch_dir


def written(df: DataFrame, name: str, *, codec: str = "zstd", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the rows read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
