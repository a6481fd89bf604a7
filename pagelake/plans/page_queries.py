"""Queries on landed pages: envelopes, statuses, page chains, predicates, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import values as V
from pagelake.operators import contract as K
from pagelake.operators import link_chains as L
from pagelake.operators import pages as P
from pagelake.plans.registry import query, table
from pagelake.sources.landing import even_pages, infer_record, land, make_pages, overlay

ORDER = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
EVENT = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]


def order_pages(spark: SparkSession, sf_dir: str, **more: object) -> DataFrame:
    """Orders as pages of 100 in key order."""
    orders = table(spark, sf_dir, "orders")
    return land(
        orders,
        record=F.struct("*"),
        order=F.col("o_orderkey"),
        page_no=F.floor(F.col("o_orderkey") / 100) + 1,
        **{"source": "shop", "resource": "orders", **more},
    )


def event_pages(spark: SparkSession, sf_dir: str, **more: object) -> DataFrame:
    """Events as feeds of ten pages of 100."""
    events = table(spark, sf_dir, "events")
    given = {
        "record": F.struct("*"),
        "order": F.col("event_id"),
        "feed": F.floor(F.col("event_id") / 1000),
        "page_no": F.pmod(F.floor(F.col("event_id") / 100), F.lit(10)) + 1,
        "source": "site",
        "resource": "events",
        **more,
    }
    return land(events, **given)


@query("SELECT * FROM orders")
def unwrap_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.drop_page(P.unwrap(order_pages(spark, sf_dir), "data", ORDER))


@query("SELECT * FROM orders")
def unwrap_nested_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = order_pages(
        spark,
        sf_dir,
        envelope=lambda items: F.struct(F.struct(items.alias("Invoice")).alias("QueryResponse")),
    )
    return P.drop_page(P.unwrap(pages, "QueryResponse.Invoice", ORDER))


@query("SELECT * FROM lineitem")
def unwrap_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    boards = (
        lines.select(even_pages(lines, LINE_KEY, 25).alias("board"), F.struct("*").alias("item"))
        .groupBy("board")
        .agg(F.collect_list("item").alias("items"))
    )
    pages = land(
        boards,
        record=F.struct(
            F.col("board").alias("id"),
            F.struct(F.lit(None).cast("string").alias("cursor"), "items").alias("items_page"),
        ),
        order=F.col("board"),
        page_no=F.floor(F.col("board") / 4) + 1,
        envelope=lambda items: F.struct(F.struct(items.alias("boards")).alias("data")),
        source="boards",
        resource="items",
    )
    return P.drop_page(P.unwrap_wildcard(pages, "data.boards[*].items_page.items", LINE))


@query("SELECT * FROM customer")
def unwrap_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    record = (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )
    listed = land(
        customers.where("c_acctbal >= 0"),
        record=F.struct("*"),
        order=F.col("c_custkey"),
        page_no=F.floor(F.col("c_custkey") / 50) + 1,
        envelope=lambda items: items,
        source="code",
        resource="members",
    )
    single = land(
        customers.where("c_acctbal < 0 OR c_acctbal IS NULL"),
        record=F.struct("*"),
        order=F.col("c_custkey"),
        feed=F.col("c_custkey"),
        page_no=F.lit(1),
        envelope=lambda items: F.get(items, 0),
        source="code",
        resource="member",
    )
    return P.drop_page(P.unwrap_bare(listed.unionByName(single), record))


@query("SELECT * FROM events WHERE event_type <> 'error'")
def unwrap_item_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.when(F.col("event_type") != "error", F.struct("*"))
    pages = event_pages(
        spark,
        sf_dir,
        record=F.struct(
            F.col("event_type").alias("item"), F.col("event_id").alias("id"), payload.alias("data")
        ),
    )
    fields = EVENT.replace(" ", ":").replace(",:", ",")
    rows = P.unwrap(pages, "data", f"item string, id bigint, data struct<{fields}>")
    return P.drop_page(P.unwrap_item_envelope(rows))


@query(
    """
    SELECT event_id, upper(event_type) AS kind,
           CASE WHEN event_type = 'purchase' THEN value END AS amount,
           CASE WHEN event_type = 'error' THEN 'E' || CAST(event_id AS VARCHAR)
                ELSE CAST(event_id AS VARCHAR) END AS ref
    FROM events
    """
)
def inferred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record type found in the pages; ``ref`` is a number or a text, so it becomes text."""
    kind = F.upper("event_type")
    number = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    pages = event_pages(
        spark,
        sf_dir,
        record=F.struct(
            "event_id",
            kind.alias("kind"),
            F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"),
            F.struct(F.coalesce(number, F.concat(F.lit("E"), "event_id")).alias("ref")).alias("link"),
        ),
    )
    found = infer_record(pages, "data")
    rows = P.unwrap(pages, "data", overlay(found, found))
    return rows.select("event_id", "kind", "amount", "link.ref")


_CHAIN = """
    WITH p AS (
      SELECT event_id // 1000 AS feed, (event_id // 100) % 10 + 1 AS page_no,
             arg_max(event_type, event_id) AS last_type, arg_min(event_type, event_id) AS first_type,
             min(event_id) AS first_id, max(event_id) AS last_id
      FROM events GROUP BY 1, 2),
    q AS (
      SELECT *, last_type <> 'signup' AS more,
             CASE WHEN first_type = 'error' THEN first_id - 2 ELSE first_id - 1 END AS sent,
             lag(last_id) OVER w AS before_id, lag(last_type <> 'signup') OVER w AS before_more,
             row_number() OVER w AS n, count(*) OVER (PARTITION BY feed) AS total
      FROM p WINDOW w AS (PARTITION BY feed ORDER BY page_no))
    SELECT CAST(feed AS VARCHAR) AS feed, page_no + 1 AS page_no, 'missing_page' AS problem
    FROM q WHERE more AND n = total
    UNION ALL
    SELECT CAST(feed AS VARCHAR), page_no,
           CASE WHEN NOT before_more THEN 'after_end' ELSE 'wrong_key' END
    FROM q WHERE n > 1 AND (NOT before_more OR sent <> before_id)
"""


@query(_CHAIN)
def page_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page whose last event is a signup says it is the last one; a page that starts
    with an error was asked for with the wrong key."""
    events = table(spark, sf_dir, "events")
    pages = land(
        events,
        record=F.struct(F.col("event_id").alias("id"), "event_type"),
        order=F.col("event_id"),
        feed=F.floor(F.col("event_id") / 1000),
        page_no=F.pmod(F.floor(F.col("event_id") / 100), F.lit(10)) + 1,
        envelope=lambda items: F.struct(
            items.alias("data"),
            (F.element_at(items, -1)["event_type"] != "signup").alias("has_more"),
        ),
        source="site",
        resource="events",
    )
    first = F.from_json("body", "data array<struct<id:bigint,event_type:string>>")["data"][0]
    sent = first["id"] - F.when(first["event_type"] == "error", 2).otherwise(1)
    asked = pages.withColumn(
        "request_key", F.create_map(F.lit("starting_after"), sent.cast("string"))
    )
    return P.page_chain_audit(asked, "last_id").select("feed", "page_no", "problem")


def _status_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = event_pages(spark, sf_dir)
    first = F.from_json("body", "data array<struct<event_type:string>>")["data"][0]["event_type"]
    status = F.when(first == "error", 404).otherwise(200)
    return pages.withColumn("http_status", status)


_PAGE_STATUS = """
    WITH p AS (
      SELECT event_id // 1000 AS feed, (event_id // 100) % 10 + 1 AS page_no,
             arg_min(event_type, event_id) = 'error' AS bad
      FROM events GROUP BY 1, 2),
    cut AS (SELECT feed, min(page_no) AS cut FROM p WHERE bad GROUP BY feed)
"""


@query(
    _PAGE_STATUS
    + """
    SELECT e.* FROM events e LEFT JOIN cut ON cut.feed = e.event_id // 1000
    WHERE cut IS NULL OR (e.event_id // 100) % 10 + 1 < cut
    """
)
def status_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that starts with an error answered 404 and ended its feed."""
    kept = P.apply_status_policy(_status_pages(spark, sf_dir), {403, 404})
    return P.drop_page(P.unwrap(kept, "data", EVENT))


@query(
    _PAGE_STATUS
    + "SELECT CAST(feed AS VARCHAR) AS feed, cut AS page_no, 404 AS http_status FROM cut"
)
def skipped_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = P.skipped_feeds(_status_pages(spark, sf_dir), {403, 404})
    return report.select("feed", "page_no", "http_status")


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS feed, 1 AS page_no FROM documents WHERE lang <> 'en'
    """
)
def malformed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as bodies: as JSON when in English, else as bare text."""
    docs = table(spark, sf_dir, "documents")
    pages = docs.select(
        F.lit("docs").alias("source"),
        F.lit("documents").alias("resource"),
        F.col("doc_id").cast("string").alias("feed"),
        F.lit(1).alias("page_no"),
        F.lit(200).alias("http_status"),
        F.when(F.col("lang") == "en", F.to_json(F.struct("text"))).otherwise(
            F.concat(F.lit("{"), "text")
        ).alias("body"),
    )
    return P.malformed_pages(pages).select("feed", "page_no")


@query(
    """
    SELECT c_name AS full_name, CAST(floor(c_acctbal) AS BIGINT) AS size
    FROM customer WHERE c_mktsegment <> 'BUILDING' AND floor(c_acctbal) > 0
    """
)
def crawl_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as repositories: the balance is the size, builders were never pushed to."""
    customers = table(spark, sf_dir, "customer")
    size = F.floor("c_acctbal")
    repos = land(
        customers,
        record=F.struct(
            F.col("c_name").alias("full_name"),
            F.when(F.col("c_mktsegment") != "BUILDING", "2024-01-01").alias("pushed_at"),
            F.when(F.col("c_acctbal") != 0, size).alias("size"),
        ),
        order=F.col("c_custkey"),
        page_no=F.floor(F.col("c_custkey") / 100) + 1,
        envelope=lambda items: items,
        source="code",
        resource="repositories",
    )
    rows = P.unwrap_bare(repos, "full_name string, pushed_at string, size bigint")
    return P.crawl_targets(rows).select("full_name", "size")


@query(
    """
    SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de') AND NOT source IN ('src1', 'src2')
    """
)
def file_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as attachments: kind by language, inline by source (missing for others)."""
    docs = table(spark, sf_dir, "documents")
    kind = F.when(F.col("lang").isin("en", "de"), P.FILE_ATTACHMENT).otherwise("#item")
    record = F.struct(
        kind.alias("@odata.type"),
        "doc_id",
        "lang",
        F.when(F.col("source").isin("src1", "src2"), True).alias("isInline"),
    )
    pages = land(
        docs,
        record=record,
        order=F.col("doc_id"),
        page_no=F.floor(F.col("doc_id") / 50) + 1,
        envelope=lambda items: F.struct(items.alias("value")),
        source="mail",
        resource="attachments",
    )
    rows = P.unwrap(
        pages, "value", "`@odata.type` string, doc_id bigint, lang string, isInline boolean"
    )
    return P.file_attachments(rows).select("doc_id", "lang")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def server_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are archived; open ones lack the flag."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "archived", F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "P", False)
    )
    return P.server_filter(orders, archived=False).select("o_orderkey", "o_orderstatus")


@query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(user_id AS VARCHAR) AS user_id, TRY_CAST(event_type AS BIGINT) AS event_type,
           CAST(CAST(value AS DECIMAL(38, 9)) AS DOUBLE) AS value,
           CAST(NULL AS VARCHAR) AS note, CAST(NULL AS TIMESTAMP) AS closed_at, props
    FROM events
    """
)
def column_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns in their types, whether the rows have them or not."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    contract = K.columns(
        bigint=["event_id", "k", "event_type"],
        text=["user_id", "note", "props"],
        decimal=["value"],
        timestamp=["closed_at"],
    )
    rows = K.ensure_columns(events, contract).drop("ts")
    return rows.withColumns(
        {"value": F.col("value").cast("double"), "closed_at": F.col("closed_at").cast("timestamp_ntz")}
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000
    UNION ALL
    SELECT NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 1e12)
    """
)
def sentinel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty selection becomes one NULL row, a filled one stays."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    filled = K.with_sentinel(orders.where("o_totalprice > 1000"), ["o_orderkey"])
    empty = K.with_sentinel(orders.where("o_totalprice > 1e12"), ["o_orderkey"])
    return filled.unionByName(empty)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def drop_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    keyless = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    rows = orders.select(keyless.alias("o_orderkey"), "o_totalprice")
    return K.drop_sentinel(rows, ["o_orderkey"])


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance,
           CAST(NULL AS VARCHAR) AS segment FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, NULL FROM supplier
    """
)
def aligned_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers in one shape."""
    template = K.columns(text=["id", "name", "segment"], decimal=["balance"])
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id", "s_nationkey AS extra"
    )
    both = K.align_to_template(customers, template).unionByName(
        K.align_to_template(suppliers, template)
    )
    return both.withColumn("balance", F.col("balance").cast("double"))


@query(
    """
    SELECT 'outlook:' || c_mktsegment || ':' || c_custkey AS document_id,
           CASE WHEN c_acctbal < 0 THEN 'attachment' ELSE c_name END AS filename,
           base64(encode(c_name)) AS content
    FROM customer
    """
)
def document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document key, default name and encoded content."""
    customers = table(spark, sf_dir, "customer")
    named = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))
    return customers.select(
        V.joined_key("outlook", F.col("c_mktsegment"), F.col("c_custkey").cast("string")).alias(
            "document_id"
        ),
        V.name_or(named, "attachment").alias("filename"),
        V.encode_content(F.encode("c_name", "utf-8")).alias("content"),
    )


_LINKED = """
    WITH RECURSIVE base AS (
      SELECT DISTINCT event_id // 100 AS feed, event_id % 100 // 10 + 1 AS p FROM events
    ), told AS (
      SELECT feed, p, max(p) OVER (PARTITION BY feed) AS n, feed % 6 AS kind FROM base
    ), nodes AS (
      SELECT feed, CASE WHEN kind = 5 AND p = 3 AND n > 3 THEN 4 WHEN kind = 5 AND p = 4 THEN 3 ELSE p END AS page_no, p AS url,
        CASE WHEN p = n THEN CASE WHEN kind = 1 THEN 3 END WHEN kind = 3 AND p = 2 THEN 6 ELSE p + 1 END AS link
      FROM told WHERE NOT (kind = 2 AND p = 4)
      UNION ALL SELECT feed, 17, 7, CASE WHEN n > 7 THEN 8 END FROM told WHERE kind = 4 AND p = 7
    ), target AS (
      SELECT feed, url, min(page_no) AS page_no, arg_min(link, page_no) AS link FROM nodes GROUP BY feed, url
    ), walk AS (
      SELECT feed, page_no, link, 0 AS step FROM nodes
      UNION ALL SELECT w.feed, w.page_no, t.link, step + 1 FROM walk w JOIN target t ON t.feed = w.feed AND t.url = w.link WHERE step < 40
    ), ahead AS (
      SELECT feed, page_no, max(step) AS ahead FROM walk GROUP BY feed, page_no
    ), joined AS (
      SELECT o.feed, o.page_no, o.url, o.link, a.ahead, t.page_no AS kept, o.link IS NOT NULL AND l.url IS NULL AS dead,
        (SELECT count(*) FROM nodes x WHERE x.feed = o.feed AND x.link = o.url AND o.page_no = t.page_no) AS entries,
        o.page_no = min(o.page_no) OVER (PARTITION BY o.feed) AS head
      FROM nodes o JOIN ahead a USING (feed, page_no) JOIN target t ON t.feed = o.feed AND t.url = o.url
        LEFT JOIN target l ON l.feed = o.feed AND l.url = o.link
    ), found AS (
      SELECT feed, page_no, 'duplicate_url' AS problem FROM joined WHERE kept <> page_no
      UNION ALL SELECT feed, page_no, 'missing_page' FROM joined WHERE dead
      UNION ALL SELECT feed, page_no, 'fork' FROM joined WHERE entries > 1
      UNION ALL SELECT feed, page_no, 'orphan' FROM joined WHERE entries = 0 AND NOT head AND kept = page_no
      UNION ALL SELECT feed, page_no, 'cycle' FROM joined WHERE ahead >= 40
    ), placed AS (
      SELECT feed, page_no, page_no - min(page_no) OVER (PARTITION BY feed) AS here, max(ahead) OVER (PARTITION BY feed) - ahead AS there
      FROM joined WHERE feed NOT IN (SELECT feed FROM found)
    )
"""


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feeds of ten linked pages of ten, most kinds of feed with a fault of their own."""
    events = table(spark, sf_dir, "events")
    pages = land(
        events,
        record=F.struct("event_id"),
        order=F.col("event_id"),
        feed=F.floor(F.col("event_id") / 100),
        page_no=F.floor(F.col("event_id") % 100 / 10) + 1,
        source="site",
        resource="events",
    )
    last = pages.groupBy("feed").agg(F.max("page_no").alias("n"))
    p, n, kind = F.col("page_no"), F.col("n"), F.col("feed").cast("bigint") % 6
    to = F.when(p == n, F.when(kind == 1, 3)).when((kind == 3) & (p == 2), 6).otherwise(p + 1)
    at = lambda place: F.concat(F.lit("https://site/"), "feed", F.lit("?page="), place.cast("string"))
    pages = (
        pages.join(last, "feed")
        .where(~((kind == 2) & (p == 4)))
        .withColumns({"request_key": F.create_map(F.lit("url"), at(p)), "link_next": at(to)})
    )
    again = pages.where((kind == 4) & (p == 7)).withColumn("page_no", F.lit(17).cast("bigint"))
    swapped = F.when((kind == 5) & (p == 3) & (n > 3), 4).when((kind == 5) & (p == 4), 3).otherwise(p).cast("bigint")
    return make_pages(pages.withColumn("page_no", swapped).unionByName(again))


@query(
    _LINKED
    + """
    SELECT CAST(feed AS VARCHAR) AS feed, page_no, problem FROM found
    UNION ALL SELECT CAST(feed AS VARCHAR), page_no, 'misplaced' FROM placed WHERE here <> there
    """
)
def link_chain_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds whose pages name the next by its URL: loops, forks, lost pages and wrong places."""
    return L.link_chain_audit(linked_pages(spark, sf_dir)).select("feed", "page_no", "problem")
