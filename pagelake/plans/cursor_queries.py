"""Queries on cursors: open and closed ranges, early stop, stale rows, marks, slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import incremental as I
from pagelake.operators import pages as P
from pagelake.operators import selection as S
from pagelake.plans.page_queries import EVENT, event_pages
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir
from pagelake.sources.landing import land, store_pages
from pagelake.sources.manifest import prune_runs, run_ranges
from pagelake.specs import Cursor, Resource

# Fixed value: the mark of the run before, for all queries here.
MARK = "2024-01-10T12:00:00"
MARK_SQL = "TIMESTAMP '2024-01-10 12:00:00'"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.drop_page(P.unwrap(event_pages(spark, sf_dir), "data", EVENT))


def _mark():
    return F.lit(MARK).cast("timestamp_ntz")


@query(f"SELECT * FROM events WHERE ts > {MARK_SQL}")
def incremental_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.incremental(_events(spark, sf_dir), "ts", _mark())


@query(
    f"""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS updated_at FROM events
    WHERE event_type = 'error' OR ts >= {MARK_SQL}
    """
)
def incremental_closed_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark itself is kept, and so are rows without a cursor."""
    rows = _events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("updated_at")
    )
    return I.incremental(rows, "updated_at", _mark(), range_start="closed", missing="include")


@query(
    f"""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS edited FROM events
    WHERE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') > '{MARK}Z'
    """
)
def incremental_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text cursor compares as text."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = _events(spark, sf_dir).select("event_id", text.alias("edited"))
    return I.incremental(rows, "edited", f"{MARK}Z")


_FEEDS = """
    WITH f AS (
      SELECT event_id, user_id, event_type, value,
             CASE WHEN value > 250 THEN ts - INTERVAL 25 DAY ELSE ts END AS cur,
             (SELECT max(event_id) FROM events) // 1000 - event_id // 1000 AS page_no
      FROM events)
"""


def _newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed per user, newest first, pages by id range. A few costly events carry a
    cursor far too old for their place."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    cursor = F.when(F.col("value") > 250, F.col("ts") - F.expr("INTERVAL 25 DAYS")).otherwise(F.col("ts"))
    pages = land(
        events,
        record=F.struct("event_id", "user_id", "event_type", cursor.alias("cur")),
        order=-F.col("event_id"),
        feed=F.col("user_id"),
        page_no=F.lit(last // 1000) - F.floor(F.col("event_id") / 1000),
        source="site",
        resource="by_user",
    )
    record = "event_id bigint, user_id bigint, event_type string, cur timestamp_ntz"
    return P.unwrap(pages, "data", record, position=True)


@query(
    _FEEDS
    + f"""
    SELECT event_id, user_id FROM (
      SELECT *, max(CASE WHEN cur <= {MARK_SQL} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_id DESC) AS stopped FROM f)
    WHERE stopped = 0
    """
)
def take_while_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.take_while_fresh(_newest_first(spark, sf_dir), "cur", _mark_text(), missing="stale")
    return rows.select("event_id", "user_id")


@query(
    _FEEDS
    + f"""
    SELECT event_id, user_id FROM (
      SELECT *, max(CASE WHEN event_type <> 'signup' AND cur < {MARK_SQL} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY event_id DESC) AS stopped FROM f)
    WHERE stopped = 0
    """
)
def take_while_include_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that keeps rows without a cursor and stops only below the mark."""
    rows = _newest_first(spark, sf_dir).withColumn(
        "cur", F.when(F.col("event_type") != "signup", F.col("cur"))
    )
    kept = I.take_while_fresh(rows, "cur", _mark_text(), missing="include", inclusive=True)
    return kept.select("event_id", "user_id")


def _mark_text():
    from datetime import datetime

    return datetime.fromisoformat(MARK)


def _edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    known = F.when(F.col("event_type") != "error", text)
    return _events(spark, sf_dir).select("event_id", known.alias("edited"))


@query(
    f"""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS edited FROM events
    WHERE event_type <> 'error' AND strftime(ts, '%Y-%m-%dT%H:%M:%SZ') > '{MARK}Z'
    """
)
def skip_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.skip_stale(_edited(spark, sf_dir), "edited", f"{MARK}Z")


@query(
    f"""
    SELECT event_id,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS edited
    FROM events
    WHERE event_type = 'error' OR strftime(ts, '%Y-%m-%dT%H:%M:%SZ') <= '{MARK}Z'
    """
)
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.late_rows(_edited(spark, sf_dir), "edited", f"{MARK}Z")


@query("SELECT event_type, max(ts) AS high_water FROM events GROUP BY event_type")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.high_water(_events(spark, sf_dir), "ts", ["event_type"])


@query(
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1995-06-01'
    ORDER BY o_orderdate, o_orderkey LIMIT 1000 OFFSET 1000
    """
)
def ordered_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second slice of 1000 in cursor order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    fresh = I.incremental(orders, "o_orderdate", F.lit("1995-06-01").cast("timestamp_ntz"))
    return I.ordered_slice(fresh, ["o_orderdate", "o_orderkey"], 1001, 1000)


@query(
    """
    SELECT o_orderkey, o_orderdate,
           (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 + 1 AS slice_no
    FROM orders
    """
)
def numbered_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the number of its slice."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return I.numbered_slices(orders, ["o_orderdate", "o_orderkey"], 1000)


@query(
    """
    SELECT l_shipdate, l_orderkey, l_linenumber FROM (
      SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS n, count(*) OVER () AS every FROM lineitem)
    WHERE n > every * 7 // 10 AND n <= every * 7 // 10 + 1000
    """
)
def deep_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of 1000 from far down the order."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    return S.deep_slice(lines, lines.columns, lines.count() * 7 // 10 + 1, 1000)


BY_DAY = Resource("site", "events", "data", "single", disposition="append", cursor=Cursor("ts", kind="timestamp"))


@query(f"SELECT event_id, ts FROM events WHERE ts > {MARK_SQL}")
def pruned_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing of one run a day: runs that end before the mark are not read."""
    events = table(spark, sf_dir, "events")
    pages = land(
        events,
        record=F.struct("event_id", "ts"),
        order=F.col("event_id"),
        feed=F.date_format("ts", "yyyy-MM-dd"),
        page_no=F.floor(F.col("event_id") / 500) + 1,
        source="site",
        resource="events",
        run_id=F.col("feed"),
    )
    landed = store_pages(pages, scratch_dir(spark, "landing"))
    fresh = prune_runs(landed, run_ranges(landed, BY_DAY), BY_DAY, F.lit(MARK).cast("timestamp"))
    rows = P.drop_page(P.unwrap(fresh, "data", "event_id bigint, ts timestamp_ntz"))
    return I.incremental(rows, "ts", _mark())
