"""One query per source: every resource of it run over pages made from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.plans.child_queries import invoice_pages
from pagelake.plans.page_queries import LINE_KEY
from pagelake.plans.pipeline import Run
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir
from pagelake.sources.catalog import SOURCES
from pagelake.sources.catalog.quickbooks import UPDATED, WHOLE
from pagelake.sources.landing import land, store_pages


def envelope(selector: str) -> Callable[[Column], Column]:
    """Body with the records under a dotted path; the bare array for the empty path."""

    def wrap(items: Column) -> Column:
        for name in reversed(selector.split(".") if selector else []):
            items = F.struct(items.alias(name))
        return items

    return wrap


def _land(
    rows: DataFrame, source: str, resource: str, key: str, size: int, record: Column, **more: object
) -> DataFrame:
    spec = SOURCES[source]
    selector = spec[resource].selector if resource in spec.names() else ""
    given = {
        "order": F.col(key),
        "page_no": F.floor(F.col(key) / size) + 1,
        "envelope": envelope(selector),
        **more,
    }
    return land(rows, record=record, source=source, resource=resource, **given)


def _run(
    spark: SparkSession,
    source: str,
    pages: DataFrame,
    marks: dict[str, str] | None = None,
    records: dict[str, str] | None = None,
) -> Run:
    """A run over the pages, landed in a folder first as they would be."""
    landed = store_pages(pages, scratch_dir(spark, "landing"))
    return Run(spark, SOURCES[source], landed, marks, records)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _at(seconds: Column) -> Column:
    """Text time this many seconds into 2024."""
    start = F.lit("2024-01-01").cast("timestamp")
    return F.date_format(F.timestamp_seconds(F.unix_timestamp(start) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


_AT = "strftime(TIMESTAMP '2024-01-01' + to_seconds(CAST({0} AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ')"


def _ntz(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz")


# --- agreements --------------------------------------------------------------------


@query(
    """
    SELECT 'agreements' AS resource, 'a' || c_custkey AS id, c_name AS name,
           CAST(NULL AS BIGINT) AS amount, CAST(NULL AS TIMESTAMP) AS at
    FROM customer
    UNION ALL
    SELECT 'contacts', 's' || s_suppkey, s_name, NULL,
           TIMESTAMP '2024-01-01' + to_seconds(s_suppkey)
    FROM supplier WHERE s_suppkey > 5
    UNION ALL
    SELECT 'invoices', 'i' || o_orderkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT),
           o_orderdate
    FROM orders
    """
)
def source_agree_com(spark: SparkSession, sf_dir: str) -> DataFrame:
    agreements = _land(
        table(spark, sf_dir, "customer"),
        "agree_com",
        "agreements",
        "c_custkey",
        100,
        F.struct(F.concat(F.lit("a"), _text("c_custkey")).alias("id"), F.col("c_name").alias("name")),
    )
    contacts = _land(
        table(spark, sf_dir, "supplier"),
        "agree_com",
        "contacts",
        "s_suppkey",
        100,
        F.struct(
            F.concat(F.lit("s"), _text("s_suppkey")).alias("id"),
            F.col("s_name").alias("name"),
            _at(F.col("s_suppkey")).alias("updated_at"),
        ),
    )
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    invoices = _land(
        table(spark, sf_dir, "orders"),
        "agree_com",
        "invoices",
        "o_orderkey",
        100,
        F.struct(
            F.concat(F.lit("i"), _text("o_orderkey")).alias("id"),
            F.col("o_orderpriority").alias("name"),
            F.struct(cents.alias("amount"), F.lit("EUR").alias("currency")).alias("amount"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("due_at"),
        ),
    )
    pages = _union([agreements, contacts, invoices])
    run = _run(spark, "agree_com", pages, {"contacts": "2024-01-01T00:00:05Z"})
    none = F.lit(None)
    return _union(
        [
            run.rows("agreements").select(
                F.lit("agreements").alias("resource"),
                "id",
                "name",
                none.cast("bigint").alias("amount"),
                none.cast("timestamp_ntz").alias("at"),
            ),
            run.rows("contacts").select(
                F.lit("contacts").alias("resource"),
                "id",
                "name",
                none.cast("bigint").alias("amount"),
                _ntz("updated_at").alias("at"),
            ),
            run.rows("invoices").select(
                F.lit("invoices").alias("resource"),
                "id",
                "name",
                F.col("amount__amount").alias("amount"),
                _ntz("due_at").alias("at"),
            ),
        ]
    )


# --- sales engagement --------------------------------------------------------------

_APOLLO = ["accounts", "people", "opportunities", "sequences", "users", "email_accounts", "labels"]


@query(
    f"""
    SELECT 'contacts' AS resource, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
    WHERE c_custkey > coalesce((SELECT max(c_custkey) FROM customer
      WHERE c_acctbal >= 0 AND {_AT.format("c_custkey")} < '2024-01-01T00:01:40Z'), -1)
    UNION ALL
    SELECT list_extract({_APOLLO}, CAST(o_orderkey % 7 AS INTEGER) + 1),
           CAST(o_orderkey AS VARCHAR), o_orderpriority
    FROM orders
    """
)
def source_apollo_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts newest first (those in debt have no cursor); the other feeds share the orders."""
    customers = table(spark, sf_dir, "customer")
    last = customers.agg(F.max("c_custkey")).first()[0] or 0
    contacts = _land(
        customers,
        "apollo_io",
        "contacts",
        "c_custkey",
        100,
        F.struct(
            _text("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.when(F.col("c_acctbal") >= 0, _at(F.col("c_custkey"))).alias("updated_at"),
        ),
        order=-F.col("c_custkey"),
        page_no=F.lit(last // 100) - F.floor(F.col("c_custkey") / 100) + 1,
    )
    names = F.array(*[F.lit(n) for n in _APOLLO])
    selectors = F.array(*[F.lit(SOURCES["apollo_io"][n].selector) for n in _APOLLO])
    which = F.col("feed").cast("int") % 7
    others = land(
        table(spark, sf_dir, "orders"),
        record=F.struct(_text("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")),
        order=F.col("o_orderkey"),
        feed=F.pmod("o_orderkey", F.lit(7)),
        page_no=F.floor(F.col("o_orderkey") / 700) + 1,
        envelope=lambda items: F.create_map(F.get(selectors, which), items),
        source="apollo_io",
        resource=F.get(names, which),
    )
    run = _run(spark, "apollo_io",
        contacts.unionByName(others),
        {"contacts": "2024-01-01T00:01:40Z"},
        dict.fromkeys(_APOLLO, "id string, name string"),
    )
    return _union(
        [run.rows(n).select(F.lit(n).alias("resource"), "id", "name") for n in ["contacts", *_APOLLO]]
    )


# --- attribute values --------------------------------------------------------------


@query(
    """
    SELECT 'companies' AS resource, 'c' || c_custkey AS id, c_name AS name, c_mktsegment AS detail
    FROM customer
    UNION ALL SELECT 'people', 's' || s_suppkey, s_name, CASE WHEN s_acctbal >= 0 THEN 'boss' END FROM supplier
    UNION ALL SELECT 'deals', 'p' || p_partkey, p_name, p_brand FROM part
    UNION ALL SELECT 'lists', 'n' || n_nationkey, n_name, NULL FROM nation
    """
)
def source_attio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned values of three objects, and lists. The notes feed is out of scope (403)."""

    def entry(value: Column, key: str = "value") -> Column:
        old = F.struct(F.lit("old").alias(key), F.lit("2020").alias("active_until"))
        new = F.struct(value.alias(key), F.lit(None).cast("string").alias("active_until"))
        return F.array(old, new)

    def record(letter: str, key: str, values: Column) -> Column:
        ident = F.concat(F.lit(letter), _text(key))
        return F.struct(F.struct(ident.alias("record_id")).alias("id"), values.alias("values"))

    companies = record(
        "c",
        "c_custkey",
        F.struct(entry(F.col("c_name")).alias("name"), entry(F.col("c_mktsegment"), "full_name").alias("categories")),
    )
    title = F.when(F.col("s_acctbal") >= 0, "boss")
    people = record(
        "s",
        "s_suppkey",
        F.struct(entry(F.col("s_name"), "full_name").alias("name"), entry(title).alias("job_title")),
    )
    stage = F.array(F.struct(F.struct(F.col("p_brand").alias("title")).alias("status")))
    deals = record(
        "p", "p_partkey", F.struct(entry(F.col("p_name")).alias("name"), stage.alias("stage"))
    )
    lists = F.struct(
        F.struct(F.concat(F.lit("n"), _text("n_nationkey")).alias("list_id")).alias("id"),
        F.col("n_name").alias("name"),
    )
    pages = _union(
        [
            _land(table(spark, sf_dir, "customer"), "attio", "companies", "c_custkey", 100, companies),
            _land(table(spark, sf_dir, "supplier"), "attio", "people", "s_suppkey", 100, people),
            _land(table(spark, sf_dir, "part"), "attio", "deals", "p_partkey", 100, deals),
            _land(table(spark, sf_dir, "nation"), "attio", "lists", "n_nationkey", 100, lists),
            _land(
                table(spark, sf_dir, "region"),
                "attio",
                "notes",
                "r_regionkey",
                100,
                F.struct(_text("r_regionkey").alias("title")),
                http_status=403,
            ),
        ]
    )
    run = _run(spark, "attio", pages)
    wanted = [
        ("companies", "record_id", F.col("categories")),
        ("people", "record_id", F.col("job_title")),
        ("deals", "record_id", F.col("stage")),
        ("lists", "list_id", F.lit(None).cast("string")),
    ]
    frames = [
        run.rows(n).select(F.lit(n).alias("resource"), F.col(k).alias("id"), "name", d.alias("detail"))
        for n, k, d in wanted
    ]
    notes = run.rows("notes").select(
        F.lit("notes").alias("resource"),
        F.col("note_id").alias("id"),
        F.col("title").alias("name"),
        F.col("meeting_id").alias("detail"),
    )
    return _union([*frames, notes])


# --- code hosting ------------------------------------------------------------------


@query(
    f"""
    WITH repo AS (
      SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal >= 1),
    pull AS (
      SELECT o_orderkey, c_name FROM orders JOIN repo ON c_custkey = o_custkey
      WHERE {_AT.format("o_orderkey")} > '2024-01-01T00:10:00Z')
    SELECT 'organizations' AS resource, CAST(n_nationkey AS VARCHAR) AS id, n_name AS owner FROM nation
    UNION ALL
    SELECT 'users', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier
    UNION ALL
    SELECT 'repositories', CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE c_custkey > 0
    UNION ALL
    SELECT 'pull_requests', CAST(o_orderkey AS VARCHAR), c_name FROM pull
    UNION ALL
    SELECT 'commits', CAST(event_id AS VARCHAR), c_name FROM events JOIN repo ON c_custkey = user_id
    WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-10 00:00:01'
    UNION ALL
    SELECT 'pull_request_commits',
           concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d')),
           c_name || '#' || l_orderkey
    FROM lineitem JOIN pull ON o_orderkey = l_orderkey
    UNION ALL
    SELECT 'pull_request_stats', CAST(o_orderkey AS VARCHAR), c_name FROM pull
    """
)
def source_github(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as organisations, suppliers as members, customers as repositories, orders as
    pull requests, events and line items as commits."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    last_order = orders.agg(F.max("o_orderkey")).first()[0] or 0
    last_repo = customers.agg(F.max("c_custkey")).first()[0] or 0
    names = customers.select("c_custkey", "c_name")
    organizations = _land(
        table(spark, sf_dir, "nation"),
        "github",
        "organizations",
        "n_nationkey",
        100,
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("login")),
        feed=F.col("n_nationkey"),
        page_no=F.lit(1),
        envelope=lambda items: F.get(items, 0),
    )
    members = _land(
        table(spark, sf_dir, "supplier"),
        "github",
        "users",
        "s_suppkey",
        100,
        F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("login")),
        feed=F.col("s_nationkey"),
    ).withColumn("request_key", F.create_map(F.lit("organization"), F.col("feed")))
    repositories = _land(
        customers,
        "github",
        "repositories",
        "c_custkey",
        100,
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("full_name"),
            _at(F.col("c_custkey")).alias("updated_at"),
            F.lit("2024").alias("pushed_at"),
            F.floor("c_acctbal").alias("size"),
        ),
        feed=F.lit("all"),
        order=-F.col("c_custkey"),
        page_no=F.lit(last_repo // 100) - F.floor(F.col("c_custkey") / 100) + 1,
    )
    named_orders = orders.join(names, F.col("o_custkey") == F.col("c_custkey"))
    pull = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("number"),
        _at(F.col("o_orderkey")).alias("updated_at"),
        F.struct(F.struct(F.col("c_name").alias("full_name")).alias("repo")).alias("base"),
    )
    pulls = _land(
        named_orders,
        "github",
        "pull_requests",
        "o_orderkey",
        1000,
        pull,
        feed=F.col("c_name"),
        order=-F.col("o_orderkey"),
        page_no=F.lit(last_order // 1000) - F.floor(F.col("o_orderkey") / 1000) + 1,
    ).withColumn("request_key", F.create_map(F.lit("repository"), F.col("feed")))

    def commit(sha: Column, at: Column) -> Column:
        date = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.struct(sha.alias("sha"), F.struct(F.struct(date.alias("date")).alias("committer")).alias("commit"))

    # Errors are an empty repository's feed, which answers 409.
    events = table(spark, sf_dir, "events").join(names, F.col("user_id") == F.col("c_custkey"))
    commits = _land(
        events,
        "github",
        "commits",
        "event_id",
        1000,
        commit(_text("event_id"), F.col("ts")),
        feed=F.concat_ws("|", "c_name", F.col("event_type") == "error"),
    ).withColumns(
        {
            "request_key": F.create_map(F.lit("repository"), F.substring_index("feed", "|", 1)),
            "http_status": F.when(F.col("feed").endswith("|true"), 409).otherwise(200),
        }
    )
    lines = table(spark, sf_dir, "lineitem")
    sha = F.concat_ws(
        "-", *[_text(k) for k in LINE_KEY[:-1]], F.date_format("l_shipdate", "yyyyMMdd")
    )
    # A page holds about 100 lines of one order; most orders need one page.
    counted = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    numbered_orders = named_orders.select("o_orderkey", "c_name").join(counted, "o_orderkey")
    keyed_lines = lines.join(numbered_orders, F.col("l_orderkey") == F.col("o_orderkey"))
    key_of = F.create_map(
        F.lit("repository"),
        F.substring_index("feed", "|", 1),
        F.lit("pull_number"),
        F.substring_index("feed", "|", -1),
    )
    line_commits = _land(
        keyed_lines,
        "github",
        "pull_request_commits",
        "l_orderkey",
        1,
        commit(sha, F.col("l_shipdate")),
        # The sha comes first in the record itself.
        order=F.lit(0),
        feed=F.concat_ws("|", "c_name", _text("l_orderkey")),
        page_no=F.pmod(F.xxhash64(*LINE_KEY), F.ceil(F.col("n_lines") / 100)) + 1,
    ).withColumn("request_key", key_of)
    stats = _land(
        named_orders,
        "github",
        "pull_request_stats",
        "o_orderkey",
        1,
        pull,
        feed=F.concat_ws("|", "c_name", _text("o_orderkey")),
        page_no=F.lit(1),
        envelope=lambda items: F.get(items, 0),
    ).withColumn("request_key", key_of)
    pages = _union([organizations, members, repositories, pulls, commits, line_commits, stats])
    run = _run(spark, "github",
        pages,
        {
            "repositories": "2024-01-01T00:00:00Z",
            "pull_requests": "2024-01-01T00:10:00Z",
            "commits": "2024-01-10T00:00:00Z",
        },
    )
    owners = {
        "organizations": F.col("login"),
        "users": F.col("organization"),
        "repositories": F.col("full_name"),
        "pull_requests": F.col("base__repo__full_name"),
        "commits": F.col("repository"),
        "pull_request_commits": F.concat("repository", F.lit("#"), _text("pull_number")),
        "pull_request_stats": F.col("repository"),
    }
    return _union(
        [
            run.rows(n).select(
                F.lit(n).alias("resource"),
                _text("sha" if "commits" in n else "id").alias("id"),
                owner.alias("owner"),
            )
            for n, owner in owners.items()
        ]
    )


# --- CRM objects -------------------------------------------------------------------


@query(
    f"""
    SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'companies' WHEN 'MACHINERY' THEN 'contacts'
                             ELSE 'deals' END AS resource,
           CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
           {_AT.format("c_custkey")} AS at
    FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE', 'AUTOMOBILE')
      AND c_acctbal >= 0 AND {_AT.format("c_custkey")} > '2024-01-01T00:05:00Z'
    UNION ALL
    SELECT 'engagements', CAST(o_orderkey AS VARCHAR), '[' || o_custkey || ']', CAST(o_orderkey AS VARCHAR)
    FROM orders WHERE o_orderkey > 999
    UNION ALL
    SELECT 'deal_pipelines', CAST(n_nationkey AS VARCHAR),
           '[{{"label":"' || n_name || '"}}]', CAST(NULL AS VARCHAR)
    FROM nation
    """
)
def source_hubspot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as three kinds of objects (archived when in debt), orders as engagements,
    nations as pipelines."""
    segment = F.col("c_mktsegment")
    kind = F.when(segment == "BUILDING", "companies").when(segment == "MACHINERY", "contacts").otherwise("deals")
    named = F.struct(
        F.col("c_name").alias("name"), F.col("c_name").alias("email"), F.col("c_name").alias("dealname")
    )
    objects = land(
        table(spark, sf_dir, "customer"),
        record=F.struct(
            _text("c_custkey").alias("id"),
            (F.col("c_acctbal") < 0).alias("archived"),
            _at(F.col("c_custkey")).alias("updatedAt"),
            named.alias("properties"),
        ),
        order=F.col("c_custkey"),
        feed=kind,
        page_no=F.floor(F.col("c_custkey") / 300) + 1,
        envelope=envelope("results"),
        source="hubspot",
        resource=F.col("feed"),
    )
    engagements = _land(
        table(spark, sf_dir, "orders"),
        "hubspot",
        "engagements",
        "o_orderkey",
        250,
        F.struct(
            F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("lastUpdated")).alias("engagement"),
            F.struct(F.array("o_custkey").alias("contactIds")).alias("associations"),
        ),
    )
    pipelines = _land(
        table(spark, sf_dir, "nation"),
        "hubspot",
        "deal_pipelines",
        "n_nationkey",
        100,
        F.struct(
            _text("n_nationkey").alias("id"),
            F.array(F.struct(F.col("n_name").alias("label"))).alias("stages"),
        ),
    )
    floor = "2024-01-01T00:05:00Z"
    run = _run(spark, "hubspot",
        _union([objects, engagements, pipelines]),
        {"companies": floor, "contacts": floor, "deals": floor, "engagements": "999"},
    )
    names = {
        "companies": ("properties__name", _text("updated_at")),
        "contacts": ("properties__email", _text("updated_at")),
        "deals": ("properties__dealname", _text("updated_at")),
        "engagements": ("associations__contact_ids", _text("last_updated")),
        "deal_pipelines": ("stages", F.lit(None).cast("string")),
    }
    return _union(
        [
            run.rows(n).select(
                F.lit(n).alias("resource"), _text("id").alias("id"), F.col(c).alias("name"), at.alias("at")
            )
            for n, (c, at) in names.items()
        ]
    )


# --- recruiting --------------------------------------------------------------------


@query(
    """
    SELECT 'people' AS resource, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
    UNION ALL SELECT 'jobs', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
    UNION ALL SELECT 'companies', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
    UNION ALL SELECT 'deals', CAST(p_partkey AS VARCHAR), p_name FROM part
    UNION ALL SELECT 'activities', CAST(event_id AS VARCHAR), event_type FROM events
    UNION ALL SELECT 'users', CAST(n_nationkey AS VARCHAR), n_name FROM nation
    """
)
def source_loxo(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = {
        "people": ("customer", "c_custkey", "c_name"),
        "jobs": ("orders", "o_orderkey", "o_orderpriority"),
        "companies": ("supplier", "s_suppkey", "s_name"),
        "deals": ("part", "p_partkey", "p_name"),
        "activities": ("events", "event_id", "event_type"),
        "users": ("nation", "n_nationkey", "n_name"),
    }
    pages = _union(
        [
            _land(
                table(spark, sf_dir, t), "loxo", n, key, 100, F.struct(F.col(key).alias("id"), F.col(name).alias("name"))
            )
            for n, (t, key, name) in feeds.items()
        ]
    )
    run = _run(spark, "loxo", pages)
    return _union([run.rows(n).select(F.lit(n).alias("resource"), "id", "name") for n in feeds])


# --- boards ------------------------------------------------------------------------


@query(
    f"""
    WITH b AS (SELECT DISTINCT o_orderkey // 10 AS board FROM orders)
    SELECT 'boards' AS resource, CAST(board AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent FROM b
    UNION ALL SELECT 'columns', CAST(o_orderkey AS VARCHAR), CAST(o_orderkey // 10 AS VARCHAR) FROM orders
    UNION ALL SELECT 'groups', 'g1', CAST(board AS VARCHAR) FROM b
    UNION ALL SELECT 'items', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR) FROM events
    WHERE event_type = 'error' OR {_AT.format("event_id")} > '2024-01-01T00:20:00Z'
    UNION ALL SELECT 'users', CAST(s_suppkey AS VARCHAR), NULL FROM supplier
    UNION ALL SELECT 'teams', CAST(n_nationkey AS VARCHAR), NULL FROM nation
    UNION ALL SELECT 'tags', CAST(r_regionkey AS VARCHAR), NULL FROM region
    UNION ALL SELECT 'updates', CAST(p_partkey AS VARCHAR), NULL FROM part
    UNION ALL SELECT 'workspaces', CAST(c_custkey AS VARCHAR), NULL FROM customer
    """
)
def source_monday_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten orders make a board with one column each; events are items (errors undated)."""
    batches = (
        table(spark, sf_dir, "orders")
        .groupBy(F.floor(F.col("o_orderkey") / 10).alias("board"))
        .agg(F.collect_list(F.struct(_text("o_orderkey").alias("id"))).alias("columns"))
    )
    boards = _land(
        batches,
        "monday_crm",
        "boards",
        "board",
        50,
        F.struct(
            _text("board").alias("id"),
            "columns",
            F.array(F.struct(F.lit("g1").alias("id"), F.lit("t").alias("title"))).alias("groups"),
        ),
    )
    items = _land(
        table(spark, sf_dir, "events"),
        "monday_crm",
        "items",
        "event_id",
        100,
        F.struct(
            _text("event_id").alias("id"),
            _text("user_id").alias("board_id"),
            F.when(F.col("event_type") != "error", _at(F.col("event_id"))).alias("updated_at"),
        ),
        envelope=lambda rows: F.struct(
            F.struct(
                F.array(F.struct(F.struct(rows.alias("items")).alias("items_page"))).alias("boards")
            ).alias("data")
        ),
    )
    flat = {
        "users": ("supplier", "s_suppkey"),
        "teams": ("nation", "n_nationkey"),
        "tags": ("region", "r_regionkey"),
        "updates": ("part", "p_partkey"),
        "workspaces": ("customer", "c_custkey"),
    }
    others = [
        _land(table(spark, sf_dir, t), "monday_crm", n, key, 50, F.struct(_text(key).alias("id")))
        for n, (t, key) in flat.items()
    ]
    run = _run(spark, "monday_crm",
        _union([boards, items, *others]),
        {"items": "2024-01-01T00:20:00Z"},
    )
    parents = {"boards": None, "columns": "board_id", "groups": "board_id", "items": "board_id"}
    return _union(
        [
            run.rows(n).select(
                F.lit(n).alias("resource"),
                "id",
                (F.col(parents[n]) if parents.get(n) else F.lit(None)).cast("string").alias("parent"),
            )
            for n in SOURCES["monday_crm"].names()
        ]
    )


# --- workspace ---------------------------------------------------------------------


@query(
    f"""
    WITH page AS (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey > 3),
    block AS (
      SELECT c_custkey, n_nationkey FROM customer JOIN page ON n_nationkey = c_nationkey
      WHERE n_nationkey <> 7 AND {_AT.format("c_custkey")} > '2024-01-01T00:01:00Z')
    SELECT 'users' AS resource, CAST(s_suppkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent,
           s_name AS detail FROM supplier
    UNION ALL SELECT 'databases', CAST(r_regionkey AS VARCHAR), NULL, 'true' FROM region
    UNION ALL SELECT 'pages', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR),
                     '{{"Deal Name (ARR)":"' || n_name || '"}}' FROM page
    UNION ALL SELECT 'blocks', CAST(c_custkey AS VARCHAR), CAST(n_nationkey AS VARCHAR), 'paragraph' FROM block
    UNION ALL SELECT 'comments', CAST(o_orderkey AS VARCHAR), CAST(c_custkey AS VARCHAR), o_orderpriority
    FROM orders JOIN block ON c_custkey = o_custkey
    """
)
def source_notion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as pages, customers as their blocks, orders as comments on the blocks."""
    users = _land(
        table(spark, sf_dir, "supplier"),
        "notion",
        "users",
        "s_suppkey",
        100,
        F.struct(_text("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    )
    databases = _land(
        table(spark, sf_dir, "region"),
        "notion",
        "databases",
        "r_regionkey",
        100,
        F.struct(
            _text("r_regionkey").alias("id"),
            F.lit("database").alias("object"),
            F.lit("2024-01-01T00:00:00Z").alias("last_edited_time"),
            F.struct(F.lit(True).alias("workspace")).alias("parent"),
        ),
    )
    pages = _land(
        table(spark, sf_dir, "nation"),
        "notion",
        "pages",
        "n_nationkey",
        100,
        F.struct(
            _text("n_nationkey").alias("id"),
            F.lit("page").alias("object"),
            _at(F.col("n_nationkey")).alias("last_edited_time"),
            F.struct(F.col("n_name").alias("Deal Name (ARR)")).alias("properties"),
        ),
        order=-F.col("n_nationkey"),
        page_no=F.lit(1000) - F.floor(F.col("n_nationkey") / 100),
    )
    blocks = _land(
        table(spark, sf_dir, "customer"),
        "notion",
        "blocks",
        "c_custkey",
        500,
        F.struct(
            _text("c_custkey").alias("id"),
            F.lit("paragraph").alias("type"),
            _at(F.col("c_custkey")).alias("last_edited_time"),
        ),
        feed=F.col("c_nationkey"),
    ).withColumns(
        {
            "request_key": F.create_map(F.lit("page_id"), F.col("feed")),
            "http_status": F.when(F.col("feed") == "7", 404).otherwise(200),
        }
    )
    comments = _land(
        table(spark, sf_dir, "orders"),
        "notion",
        "comments",
        "o_orderkey",
        1000,
        F.struct(_text("o_orderkey").alias("id"), F.col("o_orderpriority").alias("discussion_id")),
        feed=F.col("o_custkey"),
    ).withColumn("request_key", F.create_map(F.lit("block_id"), F.col("feed")))
    run = _run(spark, "notion",
        _union([users, databases, pages, blocks, comments]),
        {"pages": "2024-01-01T00:00:03Z", "blocks": "2024-01-01T00:01:00Z"},
    )
    shown = {
        "users": (F.lit(None).cast("string"), F.col("name")),
        "databases": (F.lit(None).cast("string"), F.col("parent__workspace")),
        "pages": (F.col("page_id"), F.col("properties")),
        "blocks": (F.col("page_id"), F.col("type")),
        "comments": (F.col("block_id"), F.col("discussion_id")),
    }
    return _union(
        [
            run.rows(n).select(F.lit(n).alias("resource"), "id", p.alias("parent"), d.alias("detail"))
            for n, (p, d) in shown.items()
        ]
    )


# --- sales pipeline ----------------------------------------------------------------

_PIPE = ["leads", "organizations", "deals", "activities", "stages"]


@query(
    f"""
    SELECT 'persons' AS resource, CAST(c_custkey AS VARCHAR) AS id, lower(c_name) AS text,
           CAST(c_nationkey AS BIGINT) AS owner
    FROM customer WHERE {_AT.format("c_custkey")} > '2024-01-01T00:05:00Z'
    UNION ALL
    SELECT 'users', CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier
    WHERE s_acctbal >= 0 AND strftime(TIMESTAMP '2024-01-01' + to_seconds(s_suppkey), '%Y-%m-%d %H:%M:%S')
          > '2024-01-01 00:00:10'
    UNION ALL
    SELECT list_extract({_PIPE}, CAST(o_orderkey % 5 AS INTEGER) + 1), CAST(o_orderkey AS VARCHAR), o_orderpriority,
           CASE WHEN o_orderkey % 5 = 2 THEN o_custkey END
    FROM orders
    """
)
def source_pipedrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as persons, suppliers as users in item envelopes (none for those in debt),
    orders as the other five feeds."""
    person = F.struct(
        F.col("c_custkey").alias("id"),
        F.array(F.struct(F.lower("c_name").alias("value"), F.lit(False).alias("primary"))).alias("email"),
        F.array(F.struct(F.col("c_name").alias("value"))).alias("phone"),
        F.struct(F.col("c_nationkey").alias("id"), F.col("c_name").alias("name")).alias("owner_id"),
        _at(F.col("c_custkey")).alias("update_time"),
    )
    persons = _land(table(spark, sf_dir, "customer"), "pipedrive", "persons", "c_custkey", 100, person)
    inner = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.regexp_replace(F.replace(_at(F.col("s_suppkey")), F.lit("T"), F.lit(" ")), "Z", "").alias("modified"),
    )
    users = _land(
        table(spark, sf_dir, "supplier"),
        "pipedrive",
        "users",
        "s_suppkey",
        100,
        F.struct(F.lit("user").alias("item"), F.when(F.col("s_acctbal") >= 0, inner).alias("data")),
    )
    names = F.array(*[F.lit(n) for n in _PIPE])
    others = land(
        table(spark, sf_dir, "orders"),
        record=F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("title"),
            F.struct(F.col("o_custkey").alias("id")).alias("user_id"),
            F.lit("2024-01-01 00:00:00").alias("update_time"),
        ),
        order=F.col("o_orderkey"),
        feed=F.pmod("o_orderkey", F.lit(5)),
        page_no=F.floor(F.col("o_orderkey") / 500) + 1,
        source="pipedrive",
        resource=F.get(names, F.col("feed").cast("int")),
    )
    run = _run(spark, "pipedrive",
        _union([persons, users, others]),
        {"persons": "2024-01-01T00:05:00Z", "users": "2024-01-01 00:00:10"},
    )

    def shown(name: str, text: str, owner: Column) -> DataFrame:
        return run.rows(name).select(
            F.lit(name).alias("resource"),
            _text("id").alias("id"),
            F.col(text).alias("text"),
            owner.cast("bigint").alias("owner"),
        )

    none = F.lit(None)
    rest = [shown(n, "title", F.col("user_id") if n == "deals" else none) for n in _PIPE]
    return _union([shown("persons", "email_primary", F.col("owner_id")), shown("users", "name", none), *rest])


# --- accounting --------------------------------------------------------------------

_ENTITIES = [*UPDATED, *WHOLE]
_BOOKS = [*UPDATED.values(), *WHOLE.values()]


@query(
    f"""
    SELECT list_extract({_BOOKS}, CAST(o_orderkey % 24 AS INTEGER) + 1) AS resource,
           CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS currency,
           CASE WHEN o_orderkey % 24 < 18 THEN o_orderdate + INTERVAL 8 HOUR END AS updated
    FROM orders WHERE o_orderkey % 24 >= 18 OR o_orderdate + INTERVAL 8 HOUR > TIMESTAMP '1995-06-01'
    """
)
def source_quickbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt over all 24 entities; 18 of them are read past a mark."""
    entities = F.array(*[F.lit(e) for e in _ENTITIES])
    books = F.array(*[F.lit(b) for b in _BOOKS])
    which = F.col("feed").cast("int")
    updated = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-08:00'")
    pages = land(
        table(spark, sf_dir, "orders"),
        record=F.struct(
            _text("o_orderkey").alias("Id"),
            F.struct(updated.alias("LastUpdatedTime")).alias("MetaData"),
            F.struct(F.col("o_orderpriority").alias("value")).alias("CurrencyRef"),
        ),
        order=F.col("o_orderkey"),
        feed=F.pmod("o_orderkey", F.lit(24)),
        page_no=F.floor(F.col("o_orderkey") / 24000) + 1,
        envelope=lambda items: F.struct(
            F.create_map(F.get(entities, which), items).alias("QueryResponse")
        ),
        source="quickbooks",
        resource=F.get(books, which),
    )
    record = (
        "Id string, MetaData struct<LastUpdatedTime:string>, CurrencyRef struct<value:string>"
    )
    run = _run(spark, "quickbooks",
        pages,
        dict.fromkeys(_BOOKS[:18], "1995-06-01T00:00:00Z"),
        dict.fromkeys(_BOOKS, record),
    )
    none = F.lit(None).cast("timestamp_ntz")
    return _union(
        [
            run.rows(b).select(
                F.lit(b).alias("resource"),
                "id",
                F.col("currency_ref__value").alias("currency"),
                (_ntz("meta_data__last_updated_time") if i < 18 else none).alias("updated"),
            )
            for i, b in enumerate(_BOOKS)
        ]
    )


# --- billing -----------------------------------------------------------------------


@query(
    """
    WITH fresh AS (SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01')
    SELECT CASE o_orderstatus WHEN 'F' THEN 'charges' WHEN 'O' THEN 'customers' ELSE 'refunds' END AS resource,
           'x' || o_orderkey AS id, o_orderdate AS created, CAST(NULL AS VARCHAR) AS detail
    FROM fresh
    UNION ALL SELECT 'invoices', 'in_' || o_orderkey, o_orderdate, 'sub_' || o_custkey FROM fresh
    UNION ALL
    SELECT 'invoice_line_items',
           concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                     date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))), NULL,
           'in_' || l_orderkey
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM fresh)
    """
)
def source_stripe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status as charges, customers and refunds; all of them as invoices with
    their lines."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "charges").when(status == "O", "customers").otherwise("refunds")
    objects = land(
        orders,
        record=F.struct(
            F.concat(F.lit("x"), _text("o_orderkey")).alias("id"),
            F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("created"),
        ),
        order=F.col("o_orderkey"),
        feed=kind,
        page_no=F.floor(F.col("o_orderkey") / 300) + 1,
        source="stripe",
        resource=F.col("feed"),
    )
    mark = "1996-01-01T00:00:00Z"
    names = ["charges", "customers", "refunds", "invoices"]
    run = _run(spark, "stripe",
        _union([objects, invoice_pages(spark, sf_dir)]),
        dict.fromkeys(names, mark),
    )
    none = F.lit(None)
    frames = [
        run.rows(n).select(
            F.lit(n).alias("resource"),
            "id",
            _ntz("created").alias("created"),
            (F.col("subscription") if n == "invoices" else none).cast("string").alias("detail"),
        )
        for n in names
    ]
    lines = run.rows("invoice_line_items").select(
        F.lit("invoice_line_items").alias("resource"),
        "id",
        none.cast("timestamp_ntz").alias("created"),
        F.col("invoice_id").alias("detail"),
    )
    return _union([*frames, lines])
