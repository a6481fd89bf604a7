"""Queries on parents and children: line items, dependent chains, fan-out, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagelake.operators import dependent as C
from pagelake.operators import pages as P
from pagelake.operators.joins import lookup_join
from pagelake.plans.page_queries import LINE_KEY, ORDER, order_pages
from pagelake.plans.registry import query, table
from pagelake.session import scratch_dir, settle
from pagelake.sources.landing import land, pick, store_pages

LINE_ITEM = (
    "id string, amount double, discount double, quantity double, invoice string"
)
INVOICE = (
    "id string, created double, subscription string, "
    "parent struct<subscription_details:struct<subscription:string>>, "
    f"lines struct<has_more:boolean,data:array<struct<{LINE_ITEM.replace(' ', ':').replace(',:', ',')}>>>"
)


def _invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the number of lines of their order, ``n``, and whether they are the ``embedded`` one.

    The lines are joined with what is known of their orders once, as plain columns, and written; the records are made
    from the written rows.
    """
    key = [F.col(k).cast("string") for k in LINE_KEY[:-1]]
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("string")
    ident = F.concat_ws("-", *key, day)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_extendedprice", "l_discount", "l_quantity")
    mark = F.xxhash64(ident)
    per_order = lines.groupBy("l_orderkey").agg(F.min(mark).alias("first"), F.count(F.lit(1)).alias("n"))
    dealt = lookup_join(lines, per_order, ["l_orderkey"], spread=LINE_KEY)
    return settle(dealt.withColumn("embedded", mark == F.col("first")).drop("first")).select(
        "l_orderkey",
        F.struct(
            ident.alias("id"),
            F.col("l_extendedprice").alias("amount"),
            F.col("l_discount").alias("discount"),
            F.col("l_quantity").alias("quantity"),
            F.lit(None).cast("string").alias("invoice"),
        ).alias("line"),
        "n",
        "embedded",
    )


def invoice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages of 100 invoices that embed one line each, and the other lines as
    overflow pages of about 100 lines per invoice.

    An order with very many lines only gets more overflow pages.
    """
    orders = table(spark, sf_dir, "orders")
    dealt = _invoice_lines(spark, sf_dir)
    embedded = dealt.where("embedded").select("l_orderkey", "line", "n")
    invoice_id = F.concat(F.lit("in_"), F.col("o_orderkey").cast("string"))
    first = F.filter(F.array("line"), lambda x: x.isNotNull())
    created = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    done = F.col("o_orderstatus") == "F"
    plan = F.concat(F.lit("sub_"), F.col("o_custkey").cast("string"))
    record = F.struct(
        invoice_id.alias("id"),
        created.alias("created"),
        F.when(done, plan).alias("subscription"),
        F.when(~done, F.struct(F.struct(plan.alias("subscription")).alias("subscription_details"))).alias(
            "parent"
        ),
        F.struct(F.coalesce(F.col("n") > 1, F.lit(False)).alias("has_more"), first.alias("data")).alias(
            "lines"
        ),
    )
    invoices = land(
        orders.join(embedded, F.col("o_orderkey") == F.col("l_orderkey"), "left"),
        record=record,
        order=F.col("o_orderkey"),
        page_no=F.floor(F.col("o_orderkey") / 100) + 1,
        source="stripe",
        resource="invoices",
    )
    overflow = land(
        dealt.where("not embedded"),
        record=F.col("line"),
        # The id comes first in the record itself.
        order=F.lit(0),
        feed=F.concat(F.lit("in_"), F.col("l_orderkey").cast("string")),
        page_no=F.pmod(F.xxhash64("line.id"), F.ceil(F.col("n") / 100)) + 1,
        source="stripe",
        resource="invoice_line_items",
    )
    asked = overflow.withColumn("request_key", F.create_map(F.lit("invoice_id"), F.col("feed")))
    return invoices.unionByName(asked)


def _money(value):
    return value.cast("decimal(18,2)")


@query(
    """
    SELECT 'in_' || l_orderkey AS invoice_id, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2))))
                AS DOUBLE) AS revenue
    FROM lineitem GROUP BY l_orderkey
    """
)
def invoice_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per invoice from embedded and overflow lines."""
    pages = store_pages(invoice_pages(spark, sf_dir), scratch_dir(spark, "landing"))
    invoices = P.drop_page(P.unwrap(pick(pages, resource="invoices"), "data", INVOICE))
    overflow = pick(pages, resource="invoice_line_items")
    lines = C.invoice_line_items(invoices, overflow, LINE_ITEM)
    revenue = _money(F.col("amount")) * (F.lit(1).cast("decimal(18,2)") - _money(F.col("discount")))
    return lines.groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(revenue).cast("double").alias("revenue")
    )


def _place_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Regions as pages, nations as their blocks, customers as the blocks' comments.

    Europe's blocks and nation 7's comments answer 404.
    """
    results = lambda items: F.struct(items.alias("results"))
    regions = land(
        table(spark, sf_dir, "region"),
        record=F.struct(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name")),
        order=F.col("r_regionkey"),
        page_no=F.floor(F.col("r_regionkey") / 10) + 1,
        envelope=results,
        source="places",
        resource="pages",
    )
    edited = F.concat(F.lit("2024-01-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    nations = land(
        table(spark, sf_dir, "nation"),
        record=F.struct(
            F.col("n_nationkey").cast("string").alias("id"),
            F.col("n_name").alias("name"),
            edited.alias("last_edited_time"),
        ),
        order=F.col("n_nationkey"),
        feed=F.coalesce(F.col("n_regionkey").cast("string"), F.lit("none")),
        page_no=F.floor(F.col("n_nationkey") / 10) + 1,
        envelope=results,
        source="places",
        resource="blocks",
    )
    customers = land(
        table(spark, sf_dir, "customer"),
        record=F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("text")),
        order=F.col("c_custkey"),
        feed=F.col("c_nationkey"),
        page_no=F.floor(F.col("c_custkey") / 1000) + 1,
        envelope=results,
        source="places",
        resource="comments",
    )
    blocks = nations.withColumns(
        {
            "request_key": F.create_map(F.lit("page_id"), F.col("feed")),
            "http_status": F.when(F.col("feed") == "3", 404).otherwise(200),
        }
    )
    comments = customers.withColumns(
        {
            "request_key": F.create_map(F.lit("block_id"), F.col("feed")),
            "http_status": F.when(F.col("feed") == "7", 404).otherwise(200),
        }
    )
    return regions, blocks, comments


@query(
    """
    SELECT c_custkey AS id, c_name AS text, CAST(n_nationkey AS VARCHAR) AS block_id,
           CAST(r_regionkey AS VARCHAR) AS page_id
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE r_regionkey <> 3 AND n_nationkey <> 7
      AND '2024-01-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') > '2024-01-05'
    """
)
def dependent_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, the fresh blocks of those that answer, and the comments of those blocks."""
    regions, block_pages, comment_pages = _place_pages(spark, sf_dir)
    pages = P.drop_page(P.unwrap(regions, "results", "id string, name string"))
    blocks = C.children(
        pages,
        P.apply_status_policy(block_pages, {404}),
        {"page_id": "id"},
        "results",
        "id string, name string, last_edited_time string",
        page_id="id",
    ).where(F.coalesce("last_edited_time", F.lit("")) > "2024-01-05")
    comments = C.children(
        blocks,
        P.apply_status_policy(comment_pages, {404}),
        {"block_id": "id"},
        "results",
        "id bigint, text string",
        block_id="id",
        page_id="page_id",
    )
    return comments.select("id", "text", "block_id", "page_id")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_orderkey % 5 IN (0, 1)
    """
)
def skipped_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose pages of lines ended on a 404: for some on the first page, for some after good ones."""
    ended = F.col("l_orderkey") % 5
    last = F.max("page_no").over(Window.partitionBy("l_orderkey"))
    pages = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", F.pmod(F.xxhash64(*LINE_KEY), F.lit(4)).alias("page_no"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.create_map(F.lit("order_id"), F.col("l_orderkey").cast("string")).alias("request_key"),
            F.when((ended == 0) | ((ended == 1) & (F.col("page_no") == last)), 404).otherwise(200).alias("http_status"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return C.skipped_parents(orders, pages, {"order_id": "o_orderkey"}, {404})


@query(
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01')
    """
)
def children_of_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the orders past the mark."""
    orders = P.drop_page(P.unwrap(order_pages(spark, sf_dir), "data", ORDER))
    fresh = orders.where(F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return C.children_of_increment(lines, fresh, {"l_orderkey": "o_orderkey"})


@query(
    """
    SELECT o_orderkey, o_orderstatus AS pipeline_id, o_orderpriority AS stage_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN lower(o_orderpriority) END AS stage_name,
           CASE WHEN o_orderpriority <> '5-LOW' THEN 'line ' || o_orderstatus END AS pipeline_name,
           CASE WHEN o_orderpriority <> '5-LOW'
                THEN 100 - 10 * CAST(left(o_orderpriority, 1) AS BIGINT) END AS deal_probability
    FROM orders
    """
)
def deal_stage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deals; the stage of low priority is not configured."""
    orders = table(spark, sf_dir, "orders")
    stages = (
        orders.where("o_orderpriority <> '5-LOW'")
        .select(F.col("o_orderstatus").alias("pipeline_id"), F.col("o_orderpriority").alias("id"))
        .distinct()
        .select(
            "*",
            F.lower("id").alias("name"),
            F.concat(F.lit("line "), "pipeline_id").alias("pipeline_name"),
            (100 - 10 * F.substring("id", 1, 1).cast("bigint")).alias("deal_probability"),
        )
    )
    deals = orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("pipeline_id"),
        F.col("o_orderpriority").alias("stage_id"),
    )
    return C.deal_stage_join(deals, stages)
