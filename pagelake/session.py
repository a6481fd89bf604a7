"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType

# Runtime SQL settings; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a skewed sort-merge join be split even if that adds an exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.json.enablePartialResults": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only where that
    is unset (a test session) is a scratch folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        current = spark.sparkContext.getCheckpointDir()
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="pagelake-checkpoint-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name for one run's tables, below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Folders that settle() has written, by the scope that deletes them at its end.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is settled inside is deleted at the end; use it around work whose results are written."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet into the checkpoint folder and continue from the written rows."""
    if any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        # Files cannot hold a column without a type.
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    path = scratch_dir(df.sparkSession, "settled")
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
