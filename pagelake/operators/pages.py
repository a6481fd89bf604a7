"""Landed pages: status policy, chain audit, envelopes and record predicates."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.jsonpath import (
    as_type,
    has_key,
    json_field,
    json_size,
    json_truthy,
    record_texts,
    records,
)
from pagelake.operators.joins import HOT_PAGES, lookup_join

PAGE = "_page"
POSITION = "_pos"
PAGE_FIELDS = ("source", "resource", "run_id", "feed", "page_no", "request_key", "landed_at")


# --- envelopes ---------------------------------------------------------------------


def unwrap(
    pages: DataFrame,
    selector: str,
    record: T.DataType | str,
    *,
    position: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per record of the pages.

    ``selector`` names the array inside the body (``data``, ``QueryResponse.Invoice``,
    ``data.boards[*].items_page.items``); the empty one stands for a bare array or
    object. A missing or null array gives no rows. What is known of the page stays in
    the struct ``_page``; with ``position`` the record's index in it is ``_pos``. Columns
    in ``carry`` are stamped on every record, replacing a field of the same name.
    """
    record = as_type(record)
    page = F.struct(*[F.col(c) for c in PAGE_FIELDS if c in pages.columns]).alias(PAGE)
    found = records(F.col("body"), selector, record)
    generated = (
        F.posexplode(found).alias(POSITION, "_record")
        if position
        else F.explode(found).alias("_record")
    )
    kept = [PAGE, POSITION] if position else [PAGE]
    fields = [F.col(f"_record.`{f.name}`") for f in record.fields if f.name not in carry]
    return pages.select(page, *carry, generated).select(*kept, *carry, *fields)


def unwrap_wildcard(pages: DataFrame, selector: str, record: T.DataType | str) -> DataFrame:
    """:func:`unwrap` for a selector with ``[*]``; lists under each outer element are joined."""
    return unwrap(pages, selector, record)


def unwrap_bare(pages: DataFrame, record: T.DataType | str, *, position: bool = False) -> DataFrame:
    """:func:`unwrap` for a body that is itself an array, or a single object."""
    return unwrap(pages, "", record, position=position)


def unwrap_item_envelope(rows: DataFrame, field: str = "data") -> DataFrame:
    """Replace each row by the object it carries in ``field``; rows without one are dropped.

    A generator rather than a filter drops them: Spark may run an IS NOT NULL filter
    after a later check that raises, and then see the dropped rows fail it.
    """
    keep = [c for c in (PAGE, POSITION) if c in rows.columns]
    found = F.filter(F.array(field), lambda x: x.isNotNull())
    return rows.select(*keep, F.explode(found).alias("_inner")).select(*keep, "_inner.*")


def drop_page(rows: DataFrame) -> DataFrame:
    """Rows without the page columns."""
    return rows.drop(PAGE, POSITION)


# --- status policy -----------------------------------------------------------------


def apply_status_policy(pages: DataFrame, skip: Collection[int] = ()) -> DataFrame:
    """Pages to read under a status policy.

    A status in ``skip`` ends its feed quietly: pages landed before it stay. Any other
    status outside 2xx fails the job. The statuses are read on their own first (a
    narrow, pushed-down scan), so bodies are not shuffled.
    """
    status = F.col("http_status")
    good = status.between(200, 299)
    allowed = F.when(good, True)
    if skip:
        allowed = allowed.when(status.isin(*skip), False)
    message = F.concat(
        F.lit("HTTP "), F.coalesce(status.cast("string"), F.lit("none")), F.lit(" in feed "), "feed"
    )
    allowed = allowed.otherwise(F.raise_error(message).cast("boolean"))
    kept = pages.where(allowed)
    if not skip:
        return kept
    ends = (
        pages.where(status.isin(*skip))
        .groupBy(*_feed_columns(pages))
        .agg(F.min("page_no").alias("_end"))
    )
    joined = lookup_join(
        kept, ends, _feed_columns(pages), "left", spread=["page_no"], hot_rows=HOT_PAGES
    )
    return joined.where(F.col("_end").isNull() | (F.col("page_no") < F.col("_end"))).select(
        *pages.columns
    )


def skipped_feeds(pages: DataFrame, skip: Collection[int]) -> DataFrame:
    """Report of the feeds ended by a skipped status: the status and the page it came on."""
    return (
        pages.where(F.col("http_status").isin(*skip))
        .groupBy(*_feed_columns(pages))
        .agg(F.min(F.struct("page_no", "http_status")).alias("_first"))
        .select(*_feed_columns(pages), "_first.page_no", "_first.http_status")
    )


def malformed_pages(pages: DataFrame) -> DataFrame:
    """Pages that answered 2xx with a body that is no JSON. An empty body is none."""
    broken = (F.trim("body") != "") & F.try_parse_json("body").isNull()
    return pages.where(F.col("http_status").between(200, 299) & broken).drop("body")


def _feed_columns(pages: DataFrame) -> list[str]:
    return [c for c in ("source", "resource", "run_id", "feed") if c in pages.columns]


# --- page chains -------------------------------------------------------------------


@dataclass(frozen=True)
class ChainRule:
    """When a page has a successor, and the key the next request carries.

    ``more`` and ``next_key`` take the body column and the path of the record array.
    ``request_param`` is the entry of ``request_key`` to compare with, if landed.
    """

    more: object
    next_key: object = None
    request_param: str | None = None
    first_page: int = 1


def _n(body: Column, path: str) -> Column:
    return json_size(json_field(body, path))


def _last_id(body: Column, path: str) -> Column:
    rows = F.from_json(json_field(body, path), "array<struct<id:string>>")
    return F.get(rows, F.size(rows) - 1)["id"]


def _next_page(body: Column, path: str) -> Column:
    return (F.col("page_no") + 1).cast("string")


def _page_size_rule(limit: int) -> ChainRule:
    return ChainRule(more=lambda b, p: _n(b, p) >= limit, next_key=_next_page, request_param="page")


# How each API says that another page follows.
CHAIN_RULES: dict[str, ChainRule] = {
    "last_id": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "has_more")) & (_n(b, p) > 0),
        next_key=_last_id,
        request_param="starting_after",
    ),
    "body_cursor": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "pagination.next_cursor")),
        next_key=lambda b, p: json_field(b, "pagination.next_cursor"),
        request_param="cursor",
    ),
    "after": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "paging.next.after")),
        next_key=lambda b, p: json_field(b, "paging.next.after"),
        request_param="after",
    ),
    "offset": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "hasMore")) & has_key(b, "", "offset"),
        next_key=lambda b, p: json_field(b, "offset"),
        request_param="offset",
    ),
    "next_start": ChainRule(
        more=lambda b, p: json_truthy(
            json_field(b, "additional_data.pagination.more_items_in_collection")
        )
        & has_key(b, "additional_data.pagination", "next_start"),
        next_key=lambda b, p: json_field(b, "additional_data.pagination.next_start"),
        request_param="start",
    ),
    "scroll": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "scroll_id")) & (_n(b, p) > 0),
        next_key=lambda b, p: json_field(b, "scroll_id"),
        request_param="scroll_id",
    ),
    "page_total": ChainRule(
        more=lambda b, p: F.coalesce(
            F.col("page_no")
            < json_field(b, "pagination.total_pages").try_cast("bigint"),
            F.lit(False),
        ),
        next_key=_next_page,
        request_param="page",
    ),
    "page_until_empty": ChainRule(more=lambda b, p: _n(b, p) > 0, next_key=_next_page, request_param="page"),
    "single": ChainRule(more=lambda b, p: F.lit(False)),
    "page_of_50": _page_size_rule(50),
    "page_of_100": _page_size_rule(100),
    "items_cursor": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "data.boards[0].items_page.cursor")),
        next_key=lambda b, p: json_field(b, "data.boards[0].items_page.cursor"),
        request_param="cursor",
    ),
    # Positions count from 1, a thousand to a page.
    "start_position": ChainRule(
        more=lambda b, p: _n(b, p) >= 1000,
        next_key=lambda b, p: (F.col("page_no") * 1000 + 1).cast("string"),
        request_param="startposition",
    ),
    "next_cursor": ChainRule(
        more=lambda b, p: json_truthy(json_field(b, "has_more"))
        & json_truthy(json_field(b, "next_cursor")),
        next_key=lambda b, p: json_field(b, "next_cursor"),
        request_param="start_cursor",
    ),
    "next_link": ChainRule(
        more=lambda b, p: F.get_json_object(b, "$['@odata.nextLink']").isNotNull(),
        next_key=lambda b, p: F.get_json_object(b, "$['@odata.nextLink']"),
        request_param="url",
    ),
    "link_header": ChainRule(
        more=lambda b, p: F.col("link_next").isNotNull(),
        next_key=lambda b, p: F.col("link_next"),
        request_param="url",
    ),
}


def holds_old_record(
    path: str, cursor: str, start: str, *, inclusive: bool = False, missing_is_old: bool = True
) -> Column:
    """True for a page with a record at (``inclusive``: below) the mark, where reading a
    newest-first feed stops on purpose."""
    value = lambda x: F.get_json_object(x, f"$.{cursor}")
    old = lambda v: v < F.lit(start) if inclusive else v <= F.lit(start)
    found = F.exists(
        record_texts(F.col("body"), path), lambda x: F.coalesce(old(value(x)), F.lit(missing_is_old))
    )
    return F.coalesce(found, F.lit(False))


def page_chain_audit(
    pages: DataFrame, family: str, path: str = "data", *, stopped: Column | None = None
) -> DataFrame:
    """Breaks in the page sequence of each feed.

    ``stopped`` marks pages after which the feed was left on purpose, whatever they say
    (:func:`holds_old_record`).

    A page says about its own place that it is there, and about the next place that it
    should or should not be there. Grouping by (feed, place) brings the two together,
    so one shuffle of narrow rows does it and a feed with very many pages is spread
    over all tasks. Problems: ``missing_page`` (the page before says more, nothing
    follows), ``after_end`` (the page before says end), ``gap`` (no page before),
    ``duplicate_page`` and ``wrong_key`` (the request did not carry the key).
    """
    rule = CHAIN_RULES[family]
    feed = _feed_columns(pages)
    body = F.col("body")
    none = F.lit(None).cast("string")
    expected = rule.next_key(body, path) if rule.next_key else none
    more = rule.more(body, path)
    more = more & ~stopped if stopped is not None else more
    has_param = rule.request_param and "request_key" in pages.columns
    sent = F.try_element_at("request_key", F.lit(rule.request_param)) if has_param else none
    notes = F.array(
        F.struct(
            F.col("page_no").alias("page_no"),
            F.lit(1).alias("here"),
            F.lit(None).cast("boolean").alias("told_more"),
            sent.alias("sent"),
            none.alias("expected"),
        ),
        F.struct(
            (F.col("page_no") + 1).alias("page_no"),
            F.lit(0).alias("here"),
            more.alias("told_more"),
            none.alias("sent"),
            expected.alias("expected"),
        ),
    )
    places = (
        pages.select(*feed, F.explode(notes).alias("_note"))
        .select(*feed, "_note.*")
        .groupBy(*feed, "page_no")
        .agg(
            F.sum("here").alias("_here"),
            F.bool_or("told_more").alias("_told"),
            F.max("sent").alias("_sent"),
            F.max("expected").alias("_expected"),
        )
    )
    here, told = F.col("_here"), F.col("_told")
    problem = (
        F.when((here == 0) & told, "missing_page")
        .when(here > 1, "duplicate_page")
        .when((here > 0) & told.isNull() & (F.col("page_no") > rule.first_page), "gap")
        .when((here > 0) & ~told, "after_end")
        .when((here > 0) & (F.col("_sent") != F.col("_expected")), "wrong_key")
    )
    return (
        places.withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
        .select(*feed, "page_no", "problem")
    )


# --- record predicates -------------------------------------------------------------


def crawl_targets(repos: DataFrame) -> DataFrame:
    """Repositories worth crawling: pushed to, and not empty."""
    pushed = F.coalesce(F.col("pushed_at") != "", F.lit(False))
    return repos.where(pushed & (F.coalesce(F.col("size"), F.lit(0)) > 0))


def with_attachments(messages: DataFrame) -> DataFrame:
    """Messages that say they have attachments."""
    return messages.where(F.coalesce(F.col("hasAttachments"), F.lit(False)))


FILE_ATTACHMENT = "#microsoft.graph.fileAttachment"


def file_attachments(attachments: DataFrame, *, type_column: str = "`@odata.type`") -> DataFrame:
    """File attachments that are not inline; a missing inline flag keeps the row."""
    inline = F.coalesce(F.col("isInline"), F.lit(False))
    return attachments.where((F.col(type_column) == FILE_ATTACHMENT) & ~inline)


def file_items(items: DataFrame) -> DataFrame:
    """Drive items with a file facet."""
    return items.where(F.col("file").isNotNull())


def server_filter(rows: DataFrame, **equal: object) -> DataFrame:
    """The constant filters an API would have applied, for a landing made without them.

    A row without the field passes.
    """
    for column, value in equal.items():
        if column in rows.columns:
            rows = rows.where(F.col(column).isNull() | (F.col(column) == F.lit(value)))
    return rows
