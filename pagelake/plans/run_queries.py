"""Queries on what several runs, retries and changing types leave in the tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators.incremental import take_while_fresh
from pagelake.operators.nested import promote_nested_key
from pagelake.operators.pages import drop_page, unwrap
from pagelake.operators.sinks import Table, cursor_state
from pagelake.plans.pipeline import load_reports, run_source, table_of
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir
from pagelake.sources.landing import land, store_pages
from pagelake.specs import Cursor, Parent, Resource, Source
from pagelake.streaming.streams import batch_writer, run_available, stream_pages

LEDGER = Source(
    "ledger",
    (
        Resource(
            "ledger", "invoices", "data", "single", disposition="merge", cursor=Cursor("updated", missing="include"),
            declared="id bigint, updated string, total double",
        ),
        Resource("ledger", "people", "data", "single", declared="id bigint"),
        Resource("ledger", "notes", "data", "single", disposition="append", declared="id bigint"),
    ),
)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line numbers."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_linenumber")).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "lines", F.coalesce("lines", F.array().cast("array<int>"))
    )


def _numbered(lines: Column) -> Column:
    return F.transform(lines, lambda n: F.struct(n.cast("bigint").alias("n")))


def _invoices(rows: DataFrame, run_id: str, total: Column, updated: Column, lines: Column, turn: Column) -> DataFrame:
    """Landed pages of invoices; ``turn`` says which of two versions of one comes first in its page."""
    record = F.struct(F.col("o_orderkey").alias("id"), updated.alias("updated"), total.alias("total"), _numbered(lines).alias("lines"))
    return rows.select(record.alias("r"), F.struct("o_orderkey", turn.alias("t")).alias("o")).transform(
        lambda df: land(
            df, record=F.col("r"), order=F.col("o"), page_no=F.floor(F.col("o.o_orderkey") / 400) + 1, source="ledger", resource="invoices", run_id=run_id
        )
    )


def _first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every invoice in one run: for even ones the newest is listed first."""
    both = _orders(spark, sf_dir).withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    newest = F.col("version") == 2
    return _invoices(
        both,
        "run-1",
        F.when(newest, F.col("o_totalprice")).otherwise(-1.0),
        F.concat(F.lit("2024-01-0"), F.col("version").cast("string")),
        F.when(newest, F.filter("lines", lambda n: n % 2 == 1)).otherwise(F.col("lines")),
        F.when(F.col("o_orderkey") % 2 == 0, -F.col("version")).otherwise(F.col("version")),
    )


def _loaded(spark: SparkSession, sf_dir: str, resource: str, *runs: DataFrame) -> str:
    """A warehouse after the runs, landed in one folder and loaded one after the other."""
    warehouse, landing = scratch_dir(spark, "warehouse"), scratch_dir(spark, "landing")
    for number, pages in enumerate(runs, 1):
        landed = store_pages(pages, landing)
        run_source(spark, LEDGER, landed, warehouse, [resource], run_id=f"run-{number}")
    return warehouse


@query("SELECT o_orderkey AS id, o_totalprice AS total, '2024-01-02' AS updated FROM orders")
def merge_newest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two versions in one run the newest stays, whichever is listed first."""
    warehouse = _loaded(spark, sf_dir, "invoices", _first_run(spark, sf_dir))
    return table_of(spark, warehouse, "ledger", "invoices").read().select("id", "total", "updated")


@query(
    """
    SELECT DISTINCT l_orderkey AS parent_id, CAST(l_linenumber AS BIGINT) AS n FROM lineitem
    WHERE l_linenumber % 2 = 1 AND l_orderkey % 3 <> 0 AND (l_orderkey % 3 <> 1 OR l_linenumber = 1)
    """
)
def children_after_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run: some invoices have lost all lines, some all but the first."""
    again = _orders(spark, sf_dir).where("o_orderkey % 3 < 2")
    left = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<int>")).otherwise(F.filter("lines", lambda n: n == 1))
    second = _invoices(again, "run-2", F.col("o_totalprice"), F.lit("2024-01-03"), left, F.lit(0))
    warehouse = _loaded(spark, sf_dir, "invoices", _first_run(spark, sf_dir), second)
    return table_of(spark, warehouse, "ledger", "invoices", "lines").read().select("parent_id", "n")


def _people(spark: SparkSession, sf_dir: str, resource: str, run_id: str, tags: Column) -> DataFrame:
    return land(
        table(spark, sf_dir, "customer"),
        record=F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), tags.alias("tags")),
        order=F.col("c_custkey"),
        page_no=F.floor(F.col("c_custkey") / 100) + 1,
        source="ledger",
        resource=resource,
        run_id=run_id,
    )


@query(
    """
    SELECT c_custkey AS id, count(t) AS n_tags FROM customer
    LEFT JOIN (SELECT c_custkey AS t FROM customer WHERE false) ON t = c_custkey GROUP BY c_custkey
    """
)
def children_after_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot in which nobody has a tag: none of the first one's are left."""
    some = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda n: F.struct(n.cast("bigint").alias("n")))
    first = _people(spark, sf_dir, "people", "run-1", some)
    second = _people(spark, sf_dir, "people", "run-2", F.filter(some, lambda t: F.lit(False)))
    warehouse = _loaded(spark, sf_dir, "people", first, second)
    tags = table_of(spark, warehouse, "ledger", "people", "tags").read().groupBy("parent_id").agg(F.count("*").alias("n_tags"))
    people = table_of(spark, warehouse, "ledger", "people").read()
    return people.join(tags, F.col("id") == F.col("parent_id"), "left").select("id", F.coalesce("n_tags", F.lit(0).cast("bigint")).alias("n_tags"))


@query("SELECT c_custkey AS id, n, 1 AS loads FROM customer, (VALUES (CAST(1 AS BIGINT)), (2)) v(n)")
def append_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is loaded again after its commit adds neither rows nor child rows."""
    some = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda n: F.struct(n.cast("bigint").alias("n")))
    warehouse, landing = scratch_dir(spark, "warehouse"), scratch_dir(spark, "landing")
    landed = store_pages(_people(spark, sf_dir, "notes", "run-1", some), landing)
    for _ in range(2):
        run_source(spark, LEDGER, landed, warehouse, ["notes"], run_id="run-1")
    notes = table_of(spark, warehouse, "ledger", "notes").read().groupBy("id").agg(F.count("*").cast("int").alias("loads"))
    tags = table_of(spark, warehouse, "ledger", "notes", "tags").read()
    return tags.join(notes, F.col("id") == F.col("parent_id")).select("id", "n", "loads")


@query(
    """
    SELECT c_custkey AS id, run, CASE run WHEN 2 THEN CAST(c_custkey AS VARCHAR) || '.0' WHEN 3 THEN CAST(c_custkey + 0.5 AS VARCHAR)
      WHEN 4 THEN 'n' || c_custkey END AS extra, CAST(CASE WHEN run = 3 THEN c_custkey + 0.5 WHEN run > 1 THEN c_custkey END AS DOUBLE) AS amount,
      CASE run WHEN 4 THEN c_name END AS late, CASE run WHEN 1 THEN c_name END AS early
    FROM customer, (VALUES (1), (2), (3), (4)) v(run)
    """
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs: a field without values, then whole numbers, fractions and text; fields that come and go."""
    target = Table(spark, scratch_dir(spark, "drift"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    half = F.col("id") + 0.5
    runs = [
        {"extra": F.lit(None).cast("string"), "amount": F.lit(None).cast("string"), "early": F.col("name")},
        {"extra": F.col("id"), "amount": F.col("id")},
        {"extra": half.cast("double"), "amount": half.cast("double")},
        {"extra": F.concat(F.lit("n"), F.col("id").cast("string")), "amount": F.col("id"), "late": F.col("name")},
    ]
    for number, more in enumerate(runs, 1):
        target.append(rows.withColumns({"run": F.lit(number), **more}).drop("name"), run_id=f"run-{number}")
    read = target.read()
    # Whole numbers of the second run became text when the fourth brought text; they print as such or as fractions.
    whole = F.when((F.col("run") == 2) & ~F.col("extra").contains("."), F.concat("extra", F.lit(".0"))).otherwise(F.col("extra"))
    return read.select("id", "run", whole.alias("extra"), F.col("amount").cast("double").alias("amount"), "late", "early")


@query(
    """
    SELECT event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) <= 10
    """
)
def take_while_raise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of ten new records, an old one, then records without a cursor, which nobody looks at."""
    place = F.col("event_id") % 50
    cursor = F.when(place < 10, "2024-02").when(place == 10, "2023-12")
    pages = land(
        table(spark, sf_dir, "events"),
        record=F.struct("event_id", cursor.alias("at")),
        order=F.col("event_id"),
        feed=F.floor(F.col("event_id") / 50),
        page_no=F.floor(place / 25) + 1,
        source="site",
        resource="events",
    )
    rows = unwrap(pages, "data", "event_id bigint, at string", position=True)
    return drop_page(take_while_fresh(rows, "at", "2024-01", missing="raise")).select("event_id")


NATION = "id bigint, name string"
EVERYTHING = Source(
    "ledger",
    (
        Resource("ledger", "nations", "data", "single", declared=NATION),
        Resource("ledger", "citizens", "data", "single", declared="id bigint", parent=Parent("nations", {"nation": "id"}, {"nation": "id"})),
        Resource("ledger", "orders", "data", "single", disposition="append", cursor=Cursor("day"), declared="id bigint, day string"),
        Resource("ledger", "broken", "data", "single", declared=NATION),
        Resource("ledger", "of_broken", "data", "single", declared=NATION, parent=Parent("broken", {"nation": "id"})),
        Resource("ledger", "closed", "data", "single", skip=frozenset({403}), declared=NATION),
    ),
)


def _everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all resources: one is no JSON, one was refused, one belongs to a custom object."""
    nations, customers = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    one = {"order": F.lit(0), "source": "ledger"}
    pages = [
        land(nations, record=F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), page_no=F.lit(1), resource="nations", **one),
        land(
            customers, record=F.struct(F.col("c_custkey").alias("id")), feed=F.col("c_nationkey"), page_no=F.floor(F.col("c_custkey") / 200) + 1,
            resource="citizens", request_key=F.create_map(F.lit("nation"), F.col("feed")), **one,
        ),
        land(
            table(spark, sf_dir, "orders"), record=F.struct(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")),
            page_no=F.floor(F.col("o_orderkey") / 500) + 1, resource="orders", **one,
        ),
        land(
            table(spark, sf_dir, "part"), record=F.struct(F.struct(F.col("p_partkey").alias("record_id")).alias("id"), F.col("p_name").alias("name")),
            page_no=F.floor(F.col("p_partkey") / 200) + 1, resource="gadgets", **one,
        ),
    ]
    bad = land(nations, record=F.struct(F.col("n_nationkey").alias("id")), page_no=F.lit(1), resource="broken", **one)
    pages.append(bad.withColumn("body", F.lit("<html>no JSON</html>")))
    refused = land(nations, record=F.struct(F.col("n_nationkey").alias("id")), feed=F.col("n_regionkey"), page_no=F.lit(1), resource="closed", http_status=403, **one)
    pages.append(refused.withColumn("body", F.lit("{}")))
    return reduce(DataFrame.unionByName, pages)


@query(
    """
    SELECT 'nations' AS resource, count(*) AS rows, CAST(NULL AS VARCHAR) AS high_water, CAST(0 AS BIGINT) AS skipped, 'loaded' AS outcome FROM nation
    UNION ALL SELECT 'citizens', count(*), NULL, 0, 'loaded' FROM customer
    UNION ALL SELECT 'orders', count(*), strftime(max(o_orderdate), '%Y-%m-%d'), 0, 'loaded' FROM orders
    UNION ALL SELECT 'gadgets', count(*), NULL, 0, 'loaded' FROM part
    UNION ALL SELECT 'closed', 0, NULL, count(DISTINCT n_regionkey), 'loaded' FROM nation
    UNION ALL SELECT 'broken', 0, NULL, NULL, 'failed' UNION ALL SELECT 'of_broken', 0, NULL, NULL, 'not loaded'
    """
)
def run_everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole source side by side, a custom object in it: one resource fails, its child is left, the others load."""
    source = EVERYTHING.with_resource(replace(EVERYTHING["nations"], name="gadgets", key=("record_id",), declared="", transforms=(_by_record_id,)))
    landed = store_pages(_everything(spark, sf_dir), scratch_dir(spark, "landing"))
    reports = run_source(spark, source, landed, scratch_dir(spark, "warehouse"), on_error="report", side_by_side=4, run_id="run-1")
    told = load_reports(spark, reports)
    outcome = F.when(F.col("error").isNull(), "loaded").when(F.col("error").startswith("not loaded"), "not loaded").otherwise("failed")
    return told.select("resource", "rows", "high_water", "skipped", outcome.alias("outcome"))


def _by_record_id(rows: DataFrame) -> DataFrame:
    return promote_nested_key(rows, "id", "record_id")


@query("SELECT c_custkey AS id, CAST(1 AS BIGINT) AS copies, (SELECT CAST(count(*) AS BIGINT) FROM customer) AS told FROM customer")
def append_more_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of a run's pages land after it was loaded: loading it again brings all rows, each once."""
    warehouse, landing = scratch_dir(spark, "warehouse"), scratch_dir(spark, "landing")
    pages = _people(spark, sf_dir, "notes", "run-1", F.array(F.struct(F.lit(1).alias("n"))))
    for part in (pages.where("page_no % 2 = 1"), pages.where("page_no % 2 = 0"), pages.limit(0)):
        landed = store_pages(part, landing)
        report = run_source(spark, LEDGER, landed, warehouse, ["notes"], run_id="run-1")["notes"]
    notes = table_of(spark, warehouse, "ledger", "notes").read().groupBy("id").agg(F.count("*").alias("copies"))
    return notes.withColumn("told", F.lit(report.rows).cast("bigint"))


@query("SELECT CAST(c_nationkey % 3 AS VARCHAR) AS resource, CAST(max(c_custkey) AS VARCHAR) AS mark FROM customer GROUP BY c_nationkey % 3")
def mark_never_falls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of newer records, then a late one of older ones: the mark is the greatest, as a number."""
    target = Table(spark, scratch_dir(spark, "marks"))
    rows = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 3).alias("of"), F.col("c_custkey").cast("bigint").alias("at"))
    for of in range(3):
        own = rows.where(F.col("of") == of)
        middle = own.agg(F.percentile_approx("at", 0.5)).first()[0]
        for run, part in enumerate((own.where(F.col("at") >= middle), own.where(F.col("at") < middle))):
            target.append(part, run_id=f"{of}-{run}", resource=str(of), cursor="at")
    return cursor_state(target).select("resource", F.col("last_value").alias("mark"))


@query(
    """
    SELECT user_id, max(ts) AS ts, CAST(w AS VARCHAR) AS way FROM events, (VALUES ('newest first'), ('oldest first')) v(w) GROUP BY user_id, w
    """
)
def stream_merge_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch a file, the newest or the oldest events first: each user's newest row stays either way."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    halves = [events.where(F.col("event_id") > middle), events.where(F.col("event_id") <= middle)]
    out = None
    for way, order in (("newest first", halves), ("oldest first", halves[::-1])):
        target, path, progress = Table(spark, scratch_dir(spark, "stream")), scratch_dir(spark, "landing"), scratch_dir(spark, "progress")
        write = batch_writer(target, "merge", ["user_id"], ["at"], stream="users", prepare=lambda p: drop_page(unwrap(p, "data", "user_id bigint, event_id bigint, at string")))
        for part in order:
            pages = land(part, record=F.struct("*"), order=F.col("event_id"), page_no=F.floor(F.col("event_id") / 500) + 1, source="site", resource="events")
            pages.write.mode("append").parquet(path)
            run_available(stream_pages(spark, path), write, progress)
        rows = target.read().select("user_id", F.col("at").cast("timestamp_ntz").alias("ts"), F.lit(way).alias("way"))
        out = rows if out is None else out.unionByName(rows)
    return out
