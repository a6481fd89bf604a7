"""Queries on row transforms: hoisting, times, references, JSON columns, nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import values as V
from pagelake.operators import nested as N
from pagelake.operators import pages as P
from pagelake.operators.dependent import unnest
from pagelake.plans import staging as S
from pagelake.plans.page_queries import event_pages
from pagelake.plans.registry import query, table
from pagelake.sources.landing import land


def _customer_pages(spark: SparkSession, sf_dir: str, record, **more: object) -> DataFrame:
    return land(
        table(spark, sf_dir, "customer"),
        record=record,
        order=F.col("c_custkey"),
        page_no=F.floor(F.col("c_custkey") / 100) + 1,
        **{"source": "crm", "resource": "customers", **more},
    )


@query(
    """
    SELECT event_id,
           CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) END AS purchase,
           CASE WHEN event_type = 'view' THEN 'd' || user_id END AS view,
           CASE WHEN event_type = 'error' THEN 't' || user_id END AS error,
           CAST(NULL AS VARCHAR) AS signup,
           CASE WHEN event_type = 'click' AND value >= 10 THEN 'c' || user_id END AS click,
           'kept' AS preset
    FROM events
    """
)
def promote_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attribute per event: an ended entry and a current one (no current one for
    cheap clicks). The key of its scalar depends on the type; a signup's first key is
    present but null."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    null = F.lit(None).cast("string")

    def named(letter: str):
        return F.concat(F.lit(letter), user)

    cheap = (kind == "click") & (F.col("value") < 10)
    current = (
        F.when(kind == "purchase", F.to_json(F.struct(F.col("user_id").alias("currency_value"))))
        .when(kind == "view", F.to_json(F.struct(named("d").alias("domain"))))
        .when(kind == "error", F.to_json(F.struct(F.struct(named("t").alias("title")).alias("status"))))
        .when(
            kind == "signup",
            F.to_json(
                F.struct(null.alias("value"), named("s").alias("domain")), {"ignoreNullFields": "false"}
            ),
        )
        .when(
            cheap,
            F.to_json(F.struct(named("c").alias("email_address"), F.lit("2024").alias("active_until"))),
        )
        .otherwise(
            F.to_json(
                F.struct(null.alias("active_until"), named("c").alias("email_address")),
                {"ignoreNullFields": "false"},
            )
        )
    )
    ended = F.lit('{"active_until":"2020-01-01","value":"old"}')
    values = F.concat(
        F.lit('{"'), kind, F.lit('":['), ended, F.lit(","), current, F.lit('],"preset":[{"value":"x"}]}')
    )
    pages = event_pages(
        spark,
        sf_dir,
        record=F.struct("event_id", values.alias("values"), F.lit("kept").alias("preset")),
    )
    rows = P.unwrap(pages, "data", "event_id bigint, values string, preset string")
    names = ["purchase", "view", "error", "signup", "click", "preset"]
    return N.promote_active(rows, names).select("event_id", *names)


@query(
    """
    SELECT c_name, CASE WHEN c_acctbal >= 0 THEN 'r' || c_custkey END AS record_id
    FROM customer
    """
)
def promote_nested_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id is an object for customers in credit and a plain text for the others."""
    key = F.concat(F.lit("r"), F.col("c_custkey").cast("string"))
    as_object = F.to_json(F.struct(key.alias("record_id"), F.lit("w").alias("workspace_id")))
    ids = F.when(F.col("c_acctbal") >= 0, as_object).otherwise(key)
    pages = _customer_pages(spark, sf_dir, F.struct("c_name", ids.alias("id")))
    rows = P.unwrap(pages, "data", "c_name string, id string")
    return N.promote_nested_key(rows, "id", "record_id").select("c_name", "record_id")


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS subscription FROM orders")
def hoist_if_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders carry the value at the top, the others two levels down."""
    orders = table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    key = F.col("o_custkey").cast("string")
    deep = F.when(
        ~done, F.struct(F.struct(key.alias("subscription")).alias("subscription_details"))
    )
    pages = land(
        orders,
        record=F.struct("o_orderkey", F.when(done, key).alias("subscription"), deep.alias("parent")),
        order=F.col("o_orderkey"),
        page_no=F.floor(F.col("o_orderkey") / 100) + 1,
        source="billing",
        resource="invoices",
    )
    rows = P.unwrap(
        pages,
        "data",
        "o_orderkey bigint, subscription string, "
        "parent struct<subscription_details:struct<subscription:string>>",
    )
    hoisted = N.hoist_if_null(rows, "subscription", "parent.subscription_details.subscription")
    return hoisted.select("o_orderkey", "subscription")


@query("SELECT event_id, date_trunc('second', ts) AS created FROM events")
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_timestamp(F.date_trunc("second", F.col("ts").cast("timestamp")))
    pages = event_pages(spark, sf_dir, record=F.struct("event_id", seconds.alias("created")))
    rows = P.unwrap(pages, "data", "event_id bigint, created double")
    coerced = N.epoch_column(rows, "created")
    return coerced.select("event_id", F.col("created").cast("timestamp_ntz").alias("created"))


@query("SELECT event_id, ts AS last_updated, event_type AS kind FROM events")
def iso_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO texts, errors with an offset of minus eight hours, the others in UTC."""
    ts = F.col("ts").cast("timestamp")
    text = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    west = F.concat(F.date_format(ts - F.expr("INTERVAL 8 HOURS"), text), F.lit("-08:00"))
    iso = F.when(F.col("event_type") == "error", west).otherwise(
        F.concat(F.date_format(ts, text), F.lit("Z"))
    )
    meta = F.struct(iso.alias("LastUpdatedTime"), F.col("event_type").alias("Kind"))
    pages = event_pages(spark, sf_dir, record=F.struct("event_id", meta.alias("MetaData")))
    rows = P.unwrap(
        pages, "data", "event_id bigint, MetaData struct<LastUpdatedTime:string,Kind:string>"
    )
    parsed = N.iso_column(rows, "MetaData.LastUpdatedTime")
    return parsed.select(
        "event_id",
        F.col("MetaData.LastUpdatedTime").cast("timestamp_ntz").alias("last_updated"),
        F.col("MetaData.Kind").alias("kind"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS since FROM events")
def cursor_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return table(spark, sf_dir, "events").select("event_id", V.cursor_text(iso).alias("since"))


@query(
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN lower(c_name) || '@first.example' END AS email_primary,
           c_nationkey AS owner_id
    FROM customer
    """
)
def first_value_and_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two addresses (the second is the primary one) or none; the owner is an object for
    odd nations and a number for even ones."""
    first = F.concat(F.lower("c_name"), F.lit("@first.example"))
    second = F.concat(F.lower("c_name"), F.lit("@second.example"))
    entry = F.array(
        F.struct(first.alias("value"), F.lit(False).alias("primary")),
        F.struct(second.alias("value"), F.lit(True).alias("primary")),
    )
    empty = F.filter(entry, lambda x: F.lit(False))
    listed = _customer_pages(
        spark,
        sf_dir,
        F.struct(
            "c_custkey",
            F.when(F.col("c_acctbal") >= 0, entry).otherwise(empty).alias("email"),
            F.col("c_nationkey").alias("flat_owner"),
            F.struct(F.col("c_nationkey").alias("id"), F.lit("n").alias("name")).alias("owner"),
        ),
    )
    rows = P.unwrap(
        listed,
        "data",
        "c_custkey bigint, email array<struct<value:string,primary:boolean>>, "
        "flat_owner string, owner string",
    )
    odd = F.col("flat_owner").cast("int") % 2 == 1
    rows = rows.withColumn("owner_id", F.when(odd, F.col("owner")).otherwise(F.col("flat_owner")))
    rows = N.refs_to_ids(N.first_values(rows, {"email": "email_primary"}), ["owner_id"])
    return rows.select("c_custkey", "email_primary", F.col("owner_id").cast("int").alias("owner_id"))


def _engagements(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    pages = land(
        orders,
        record=F.struct(
            F.struct(
                F.col("o_orderkey").alias("id"),
                F.col("o_orderpriority").alias("type"),
                F.col("o_custkey").alias("ownerId"),
            ).alias("engagement"),
            F.struct(
                F.array("o_custkey", "o_orderkey").alias("contactIds"),
                F.when(F.col("o_orderstatus") == "F", F.array("o_custkey")).alias("companyIds"),
            ).alias("associations"),
        ),
        order=F.col("o_orderkey"),
        page_no=F.floor(F.col("o_orderkey") / 250) + 1,
        envelope=lambda items: F.struct(items.alias("results")),
        source="crm",
        resource="engagements",
    )
    rows = P.unwrap(
        pages,
        "results",
        "engagement struct<id:bigint,type:string,ownerId:bigint>, associations "
        "struct<contactIds:array<bigint>,companyIds:array<bigint>,dealIds:array<bigint>>",
    )
    return P.drop_page(N.flatten_engagement(rows))


@query(
    """
    SELECT o_orderkey AS id, o_orderpriority AS type, o_custkey AS "ownerId",
           '[' || o_custkey || ',' || o_orderkey || ']' AS associations__contact_ids,
           CASE WHEN o_orderstatus = 'F' THEN '[' || o_custkey || ']' ELSE '[]' END
             AS associations__company_ids,
           '[]' AS associations__deal_ids
    FROM orders
    """
)
def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement fields at the top, association lists as JSON text."""
    return _engagements(spark, sf_dir)


@query(
    """
    SELECT o_orderkey AS id, o_custkey AS contact_id FROM orders
    UNION ALL SELECT o_orderkey, o_orderkey FROM orders
    """
)
def association_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _engagements(spark, sf_dir).select("id", "associations__contact_ids")
    return S.association_rows(rows, "associations__contact_ids", "contact_id")


@query(
    """
    SELECT c_custkey AS cust_key, c_name AS display_name, n_name AS home__nation_name,
           r_name AS home__in_region__region_name
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """
)
def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested places of customers as flat snake case columns."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    home = F.struct(
        F.col("n_name").alias("NationName"),
        F.struct(F.col("r_name").alias("RegionName")).alias("InRegion"),
    )
    pages = land(
        customers,
        record=F.struct(
            F.col("c_custkey").alias("CustKey"), F.col("c_name").alias("DisplayName"), home.alias("Home")
        ),
        order=F.col("c_custkey"),
        page_no=F.floor(F.col("c_custkey") / 100) + 1,
        source="books",
        resource="customers",
    )
    rows = P.unwrap(
        pages,
        "data",
        "CustKey bigint, DisplayName string, "
        "Home struct<NationName:string,InRegion:struct<RegionName:string>>",
    )
    return N.flatten_structs(P.drop_page(rows))


_BATCH = (
    "id bigint, orders array<struct<id:bigint,total:double,tags:array<string>,"
    "ref:struct<custKey:bigint>>>"
)


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten orders in a row as one record."""
    orders = table(spark, sf_dir, "orders")
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("total"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.struct(F.col("o_custkey").alias("custKey")).alias("ref"),
    )
    batches = (
        orders.groupBy(F.floor(F.col("o_orderkey") / 10).alias("id"))
        .agg(F.sort_array(F.collect_list(record)).alias("orders"))
    )
    pages = land(
        batches,
        record=F.struct("id", "orders"),
        order=F.col("id"),
        page_no=F.floor(F.col("id") / 10) + 1,
        source="shop",
        resource="batches",
    )
    return P.drop_page(P.unwrap(pages, "data", _BATCH))


@query(
    """
    SELECT o_orderkey // 10 AS parent_id,
           row_number() OVER (PARTITION BY o_orderkey // 10 ORDER BY o_orderkey) - 1 AS list_idx,
           o_orderkey AS id, o_totalprice AS total,
           '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags,
           o_custkey AS ref__cust_key
    FROM orders
    """
)
def child_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a batch as a child table; deeper arrays stay inline."""
    rows = N.child_table(_batches(spark, sf_dir), "orders", ["id"])
    return rows.withColumn("list_idx", F.col("list_idx").cast("bigint"))


@query("SELECT o_orderkey AS id, o_totalprice AS total, o_orderkey // 10 AS board_id FROM orders")
def unnest_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unnest(_batches(spark, sf_dir), "orders", "id", "board_id")
    return rows.select("id", "total", "board_id")


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS properties__name,
           CAST(c_acctbal AS VARCHAR) AS properties__amount, CAST(NULL AS VARCHAR) AS properties__city
    FROM customer
    """
)
def project_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed properties as text columns; the unlisted one is left out."""
    pages = _customer_pages(
        spark,
        sf_dir,
        F.struct(
            F.col("c_custkey").cast("string").alias("id"),
            F.struct(
                F.col("c_name").alias("name"),
                F.col("c_acctbal").cast("string").alias("amount"),
                F.col("c_mktsegment").alias("unlisted"),
            ).alias("properties"),
        ),
    )
    rows = P.unwrap(
        pages, "data", "id string, properties struct<name:string,amount:string,unlisted:string>"
    )
    return P.drop_page(N.project_properties(rows, ["name", "amount", "city"]))


@query(
    """
    SELECT c_custkey AS id, c_custkey AS page_id, 'crm' AS tenant, 'BUILDING' AS c_mktsegment
    FROM customer
    """
)
def stamp_and_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return N.stamp(N.alias_column(rows, "id", "page_id"), tenant="crm", c_mktsegment="BUILDING")


@query("SELECT event_id, user_id FROM events")
def select_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.struct("user_id", "value").alias("actor"))
    return N.select_fields(rows, ["event_id", "actor.user_id"])


@query("SELECT conv_id, turn, text || ' / ' || role AS content FROM conversations")
def block_text_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as blocks whose content is kept under the name of the block's type."""
    turns = table(spark, sf_dir, "conversations")
    content = F.to_json(
        F.struct(
            F.array(
                F.struct(F.col("text").alias("plain_text")),
                F.struct(F.concat(F.lit(" / "), "role").alias("plain_text")),
            ).alias("rich_text")
        )
    )
    block = F.concat(F.lit('{"type":"'), "role", F.lit('","'), "role", F.lit('":'), content, F.lit("}"))
    kind = F.get_json_object(block, "$.type")
    return turns.select("conv_id", "turn", S.block_text(kind, block).alias("content"))


@query(
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           TRY_CAST(event_type AS TIMESTAMP) AS at
    FROM events
    """
)
def staged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path read of an opaque column and casts that give NULL instead of failing."""
    rows = S.json_fields(table(spark, sf_dir, "events"), "props", {"k": "k"})
    rows = S.typed(rows.withColumn("at", F.col("event_type")), {"k": "bigint", "at": "timestamp"})
    return rows.select("event_id", "k", F.col("at").cast("timestamp_ntz").alias("at"))
