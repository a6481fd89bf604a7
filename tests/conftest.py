from __future__ import annotations

import json
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from pagelake.session import tune
from pagelake.sources.landing import PAGES


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("pagelake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pagelake-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


def page(source, resource, body, *, feed="0", no=1, status=200, run="run-1", link=None, **key):
    text = body if isinstance(body, str) or body is None else json.dumps(body)
    return (source, resource, run, feed, no, key or None, status, link, None, text)


@pytest.fixture
def landed(spark):
    def make(*pages):
        names = [f.name for f in PAGES.fields]
        rows = [
            {n: list(v.items()) if isinstance(v, dict) else v for n, v in zip(names, p, strict=True)}
            for p in map(tuple, pages)
        ]
        # As an Arrow table the rows go to Spark once, without Python workers.
        arrow = pa.Table.from_pylist(rows, schema=to_arrow_schema(PAGES))
        return spark.createDataFrame(arrow, schema=PAGES)

    return make


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
