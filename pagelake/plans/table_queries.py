"""Queries on tables: dispositions, latest rows, key and load reports, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.operators import dedup as D
from pagelake.operators import pages as P
from pagelake.operators.pages import PAGE, POSITION
from pagelake.operators.sinks import Table, cursor_state
from pagelake.plans.page_queries import EVENT, event_pages
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir
from pagelake.sources.landing import land, write_pages
from pagelake.streaming.streams import batch_writer, run_available, stream_dedup, stream_pages, stream_take_while as take_while


def _table(spark: SparkSession, name: str) -> Table:
    return Table(spark, scratch_dir(spark, name))


def _kinds(events: DataFrame) -> list[str | None]:
    """The event types there are, each a resource of its own; those without one come last."""
    found = [r[0] for r in events.select("event_type").distinct().collect()]
    return sorted(found, key=lambda k: (k is None, k or ""))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per order to the customer who placed it."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderkey").alias("seq"),
    )


_MERGED = """
    WITH d AS (
      SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price, max(o_orderkey) AS seq
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, coalesce(price, c_acctbal) AS c_acctbal, seq FROM customer
    LEFT JOIN d ON o_custkey = c_custkey
    UNION ALL
    SELECT o_custkey, price, seq FROM d WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
"""


def _merged(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    target = _table(spark, "customers")
    base = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.lit(None).cast("bigint").alias("seq")
    )
    target.merge(base, ["c_custkey"])
    for _ in range(times):
        target.merge(_changes(spark, sf_dir), ["c_custkey"], ["seq"])
    return target.read()


@query(_MERGED)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the changes merged in; of several for one key the last counts."""
    return _merged(spark, sf_dir, 1)


@query(_MERGED)
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging the same changes twice is merging them once."""
    return _merged(spark, sf_dir, 2)


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def append_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended in two runs, then the current row per user."""
    target = _table(spark, "events")
    events = table(spark, sf_dir, "events")
    target.append(events.where("event_type = 'signup'"), cursor="ts", resource="events")
    target.append(events.where("event_type <> 'signup'"), cursor="ts", resource="events")
    return D.current_view(target.read(), ["user_id"], ["ts"])


@query(
    """
    SELECT c_nationkey AS id, c_name AS organization FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) = 1
    """
)
def canonical_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("id"), F.col("c_name").alias("organization")
    )
    return D.canonical_by(pairs, "id", "organization")


@query("SELECT * FROM orders")
def replace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot replaced by a later one."""
    target = _table(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    target.replace(orders.where("o_orderstatus = 'F'"))
    target.replace(orders)
    return target.read()


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows, 'duplicate' AS problem
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.key_audit(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT row_number() OVER (ORDER BY event_type NULLS LAST) AS version, coalesce(event_type, 'none') AS resource,
           count(*) AS rows, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS high_water
    FROM events GROUP BY event_type
    """
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and mark of one load per event type into a shared table."""
    target = _table(spark, "shared")
    events = table(spark, sf_dir, "events")
    for kind in _kinds(events):
        target.append(events.where(F.col("event_type").eqNullSafe(kind)), cursor="ts", resource=kind or "none")
    return target.reports().select("version", "resource", "rows", "high_water")


@query(
    """
    SELECT coalesce(event_type, 'none') AS resource, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS last_value
    FROM events GROUP BY event_type
    """
)
def cursor_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks after two runs each; the second run finds nothing new and changes none."""
    target = _table(spark, "marks")
    events = table(spark, sf_dir, "events")
    for kind in _kinds(events) * 2:
        rows = events.where(F.col("event_type").eqNullSafe(kind))
        mark = target.high_water(kind or "none")
        if mark is not None:
            rows = rows.where(F.col("ts") > F.lit(mark).cast("timestamp").cast("timestamp_ntz"))
        target.append(rows, cursor="ts", resource=kind or "none")
    return cursor_state(target)


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance,
           CAST(NULL AS VARCHAR) AS type FROM customer
    UNION ALL
    SELECT 'p' || p_partkey, p_name, NULL, p_type FROM part
    """
)
def shared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two resources with different columns in one merged table."""
    target = _table(spark, "things")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS id", "c_name AS name", "c_acctbal AS balance"
    )
    parts = table(spark, sf_dir, "part").selectExpr(
        "concat('p', p_partkey) AS id", "p_name AS name", "p_type AS type"
    )
    target.merge(D.union_tables(customers, parts), ["id"])
    return target.read()


# --- streams -----------------------------------------------------------------------


def _landed_events(spark: SparkSession, sf_dir: str) -> str:
    """Events landed as pages in a folder."""
    path = scratch_dir(spark, "landing")
    write_pages(event_pages(spark, sf_dir), path)
    return path


def _rows(batch: DataFrame) -> DataFrame:
    return P.drop_page(P.unwrap(batch, "data", EVENT))


@query("SELECT * FROM events")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages streamed into an append table; a restart adds nothing."""
    target, path = _table(spark, "stream"), _landed_events(spark, sf_dir)
    write = batch_writer(target, "append", stream="events", prepare=_rows)
    checkpoint = scratch_dir(spark, "progress")
    run_available(stream_pages(spark, path), write, checkpoint)
    run_available(stream_pages(spark, path), write, checkpoint)
    return target.read()


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages streamed into a table keyed by user; a new progress folder, which
    delivers every page again, changes nothing."""
    target, path = _table(spark, "stream"), _landed_events(spark, sf_dir)
    write = batch_writer(target, "merge", ["user_id"], ["ts"], stream="users", prepare=_rows)
    for _ in range(2):
        run_available(stream_pages(spark, path), write, scratch_dir(spark, "progress"))
    return target.read()


@query("SELECT * FROM events")
def stream_dedup_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page delivered twice; each event comes out once."""
    target, path = _table(spark, "stream"), _landed_events(spark, sf_dir)
    stream = stream_pages(spark, path)
    rows = _rows(stream.unionByName(stream)).withColumn("at", F.col("ts").cast("timestamp"))
    once = stream_dedup(rows, ["event_id"], "at", "40 days").drop("at")
    write = batch_writer(target, "append", stream="once")
    run_available(once, write, scratch_dir(spark, "progress"))
    return target.read()




@query("SELECT * FROM events")
def stream_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is the whole table: first some pages, then a later delivery of all."""
    target, path = _table(spark, "stream"), _landed_events(spark, sf_dir)
    write = batch_writer(target, "replace", stream="snapshots", prepare=_rows)
    some = stream_pages(spark, path).where("page_no % 2 = 0")
    run_available(some, write, scratch_dir(spark, "progress"))
    run_available(stream_pages(spark, path), write, scratch_dir(spark, "progress"))
    return target.read()


@query("SELECT * FROM events")
def stream_new_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose progress folder is lost while more pages land: each event is there once."""
    target, path = _table(spark, "stream"), scratch_dir(spark, "landing")
    pages = event_pages(spark, sf_dir)
    write = batch_writer(target, "append", stream="events", prepare=_rows, on_new_progress="reload")
    write_pages(pages.where("page_no % 3 > 0"), path)
    run_available(stream_pages(spark, path), write, scratch_dir(spark, "progress"))
    write_pages(pages.where("page_no % 3 = 0"), path)
    run_available(stream_pages(spark, path), write, scratch_dir(spark, "progress"))
    return target.read()


def land_run(events: DataFrame, path: str, run_id: str, until: str, pages: str) -> None:
    """One run over a feed for each event type: days from the newest on, a day's events by number, 20 to a page."""
    seen = events.where(F.col("ts") <= F.lit(until).cast("timestamp_ntz"))
    newest_first = Window.partitionBy("event_type").orderBy(F.col("ts").cast("date").desc(), "event_id")
    placed = seen.withColumn("n", F.row_number().over(newest_first) - 1)
    landed = land(
        placed,
        record=F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")),
        order=F.col("n"),
        feed=F.coalesce("event_type", F.lit("")),
        page_no=F.floor(F.col("n") / 20) + 1,
        source="site",
        resource="events",
        run_id=run_id,
    )
    write_pages(landed.where(pages), path)


_TAKE_WHILE = """
    WITH e AS (
      SELECT coalesce(event_type, '') AS feed, event_id, ts FROM events),
    first AS (SELECT feed, event_id, ts FROM e WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'),
    mark AS (SELECT feed, max(ts) AS mark FROM first GROUP BY feed),
    second AS (
      SELECT e.*, mark, row_number() OVER (PARTITION BY feed ORDER BY CAST(ts AS DATE) DESC, event_id) AS n
      FROM e LEFT JOIN mark USING (feed) WHERE ts <= TIMESTAMP '2024-01-25 12:00:00'),
    cut AS (SELECT feed, min(n) AS cut FROM second WHERE ts <= mark GROUP BY feed)
    SELECT 'run-1' AS run, feed, event_id FROM first
    UNION ALL
    SELECT 'run-2', feed, event_id FROM second LEFT JOIN cut USING (feed) WHERE cut IS NULL OR n < cut
"""


@query(_TAKE_WHILE)
def stream_take_while(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over newest-first feeds, their pages landed in two parts each: the second run ends at the mark
    that the first left in the state, found after a restart. Within a day the order is by number, so
    fresh rows behind an old one are cut as well."""
    events, path = table(spark, sf_dir, "events"), scratch_dir(spark, "landing")
    progress, out = scratch_dir(spark, "progress"), scratch_dir(spark, "taken")
    for run_id, until in (("run-1", "2024-01-15 12:00:00"), ("run-2", "2024-01-25 12:00:00")):
        for part in ("page_no <= 3", "page_no > 3"):
            land_run(events, path, run_id, until, part)
            rows = P.unwrap(stream_pages(spark, path), "data", "event_id bigint, at string", position=True).select(
                F.col(f"{PAGE}.run_id").alias("run"),
                F.col(f"{PAGE}.feed").alias("feed"),
                F.col(f"{PAGE}.page_no").alias("page_no"),
                F.col(POSITION).cast("long").alias("place"),
                "event_id",
                "at",
            )
            taken = take_while(rows, ["feed"], "run", ("page_no", "place"), "at")
            write = taken.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
            write.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("run", "feed", "event_id")
