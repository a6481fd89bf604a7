"""The audit of page chains, one query for each way in which an API says that another page follows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import pages as P
from pagelake.plans.registry import query, table
from pagelake.sources.landing import make_pages

def _token(page: Column) -> Column:
    return F.concat_ws("-", F.col("feed"), page)


def _start(page: Column) -> Column:
    return page * 20


def _number(page: Column) -> Column:
    return page + 1


def _records(count: Column | int) -> Column:
    return F.array_repeat(F.struct(_token(F.col("page_no")).alias("id")), F.lit(count) if isinstance(count, int) else count)


def _full(size: int) -> Column:
    """A full page where more follows, else one record less."""
    return _records(F.when(F.col("more"), size).otherwise(size - 1))


def _at(path: str, value: Column) -> Column:
    """A struct with the value at the dotted path."""
    first, _, rest = path.partition(".")
    return F.struct((_at(rest, value) if rest else value).alias(first))


@dataclass(frozen=True)
class Shape:
    """Pages of one family: the body, the key by which the page after ``page`` is asked for, its name in the request."""

    body: Column
    key: Callable[[Column], Column]
    param: str
    path: str = "data"
    link: Column | None = None


def _if_more(value: Column) -> Column:
    return F.when(F.col("more"), value)


def shape_of(family: str) -> Shape:
    """How the pages of an API look whose rule is ``family``."""
    shapes = {
        "last_id": Shape(F.struct(F.col("more").alias("has_more"), _records(20).alias("data")), _token, "starting_after"),
        "body_cursor": Shape(_at("pagination.next_cursor", _if_more(_token(F.col("page_no")))), _token, "cursor"),
        "after": Shape(_at("paging.next.after", _if_more(_start(F.col("page_no")).cast("string"))), _start, "after", "results"),
        "offset": Shape(F.struct(F.col("more").alias("hasMore"), _start(F.col("page_no")).alias("offset")), _start, "offset", "results"),
        "next_start": Shape(
            _at("additional_data.pagination", F.struct(F.col("more").alias("more_items_in_collection"), _if_more(_start(F.col("page_no"))).alias("next_start"))),
            _start,
            "start",
        ),
        "scroll": Shape(F.struct(_token(F.col("page_no")).alias("scroll_id"), _full(1).alias("people")), _token, "scroll_id", "people"),
        "page_total": Shape(_at("pagination.total_pages", F.col("page_no") + F.col("more").cast("int")), _number, "page"),
        "page_until_empty": Shape(F.struct(_full(1).alias("jobs")), _number, "page", "jobs"),
        "page_of_50": Shape(_at("data.boards", _full(50)), _number, "page", "data.boards"),
        "page_of_100": Shape(_at("data.users", _full(100)), _number, "page", "data.users"),
        "items_cursor": Shape(_at("data.boards", F.array(_at("items_page.cursor", _if_more(_token(F.col("page_no")))))), _token, "cursor", ""),
        "start_position": Shape(_at("QueryResponse.Invoice", _full(1000)), lambda page: page * 1000 + 1, "startposition", "QueryResponse.Invoice"),
        "next_cursor": Shape(F.struct(F.col("more").alias("has_more"), _if_more(_token(F.col("page_no"))).alias("next_cursor")), _token, "start_cursor", "results"),
        "next_link": Shape(F.struct(_if_more(_token(F.col("page_no"))).alias("@odata.nextLink")), _token, "url", "value"),
        "link_header": Shape(_records(20), _token, "url", "", link=_if_more(_token(F.col("page_no")))),
        "single": Shape(F.struct(_records(20).alias("data")), _token, "none"),
    }
    return shapes[family]


def chain_pages(spark: SparkSession, sf_dir: str, shape: Shape) -> DataFrame:
    """Pages of 20 events, ten to a feed, with faults where certain events lie.

    A page that ends with a signup says that it is the last; one that ends with an error was lost on
    the way; one from a purchase to a view was landed twice; one that starts with an error was asked
    for with the wrong key.
    """
    events = table(spark, sf_dir, "events")
    ends = (
        events.groupBy(
            F.expr("event_id div 200").cast("string").alias("feed"), (F.expr("event_id div 20") % 10 + 1).alias("page_no")
        )
        .agg(F.min_by("event_type", "event_id").alias("first"), F.max_by("event_type", "event_id").alias("last"))
        .where("last <> 'error'")
        .withColumn("more", F.col("last") != "signup")
    )
    asked = F.when(F.col("first") == "error", "other").otherwise(shape.key(F.col("page_no") - 1).cast("string"))
    copies = F.when((F.col("first") == "purchase") & (F.col("last") == "view"), 2).otherwise(1)
    bodies = ends.select("feed", "page_no", "more", asked.alias("asked"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return make_pages(
        bodies,
        source="site",
        resource="events",
        body=F.to_json(shape.body),
        request_key=F.create_map(F.lit(shape.param), F.col("asked")),
        link_next=shape.link if shape.link is not None else None,
    )


_CHAIN = """
    WITH ends AS (
      SELECT event_id // 200 AS feed, (event_id // 20) % 10 + 1 AS page_no,
             arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type
      FROM events GROUP BY 1, 2),
    landed AS (
      SELECT feed, page_no, {more} AS more, first_type = 'error' AS wrong,
             first_type = 'purchase' AND last_type = 'view' AS twice
      FROM ends WHERE last_type <> 'error'),
    places AS (SELECT feed, page_no FROM landed UNION SELECT feed, page_no + 1 FROM landed),
    told AS (
      SELECT p.feed, p.page_no, h.feed IS NOT NULL AS here, h.twice, h.wrong, b.more
      FROM places p LEFT JOIN landed h ON h.feed = p.feed AND h.page_no = p.page_no
      LEFT JOIN landed b ON b.feed = p.feed AND b.page_no = p.page_no - 1),
    found AS (
      SELECT CAST(feed AS VARCHAR) AS feed, page_no,
             CASE WHEN NOT here AND more THEN 'missing_page'
                  WHEN here AND twice THEN 'duplicate_page'
                  WHEN here AND more IS NULL AND page_no > 1 THEN 'gap'
                  WHEN here AND NOT more THEN 'after_end'
                  WHEN here AND more AND wrong THEN 'wrong_key' END AS problem
      FROM told)
    SELECT feed, page_no, problem FROM found WHERE problem IS NOT NULL
"""


def _register(family: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shape = shape_of(family)
        return P.page_chain_audit(chain_pages(spark, sf_dir, shape), family, shape.path).select("feed", "page_no", "problem")

    run.__name__ = f"chain_{family}"
    run.__doc__ = f"Breaks in chains of pages that follow each other by the rule {family}."
    query(_CHAIN.format(more="FALSE" if family == "single" else "last_type <> 'signup'"))(run)


for _family in P.CHAIN_RULES:
    _register(_family)
