"""Pages that name their successor by its URL: a linked list, ordered by pointer doubling.

Page numbers say in what order pages were landed, links in what order they belong. A page points to
the page of its feed that was requested by its next link. In each round every page learns the page
twice as far ahead and how far that is, so after log2 of the longest feed's length all pages know their distance from
the end. There is no window over a feed and no walk along it: a feed of any length is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.operators.pages import _feed_columns
from pagelake.session import settle


def next_link() -> Column:
    """The next page's URL: the response header, else the link in the body; null or empty at the end."""
    in_body = F.get_json_object("body", "$['@odata.nextLink']")
    return F.nullif(F.coalesce(F.col("link_next"), in_body), F.lit(""))


def requested_url(entry: str = "url") -> Column:
    """The URL a page was requested by."""
    return F.try_element_at("request_key", F.lit(entry))


def _linked(pages: DataFrame, url: Column, link: Column) -> tuple[DataFrame, list[str]]:
    """Numbered pages with ``to``, the number of the page their link leads to; written once."""
    feed = _feed_columns(pages)
    told = pages.select(*feed, "page_no", url.alias("url"), link.alias("link"))
    nodes = settle(told.withColumn("id", F.monotonically_increasing_id()))
    # Of pages of one URL the first landed is the one that links lead to.
    target = nodes.where("url is not null").groupBy(*feed, F.col("url").alias("link")).agg(
        F.min_by("id", F.struct("page_no", "id")).alias("to"), F.count("*").alias("answers")
    )
    return settle(nodes.join(target, [*feed, "link"], "left")), feed


def _distances(nodes: DataFrame, feed: list[str]) -> DataFrame:
    """id, ahead (pages that follow), looped (the links never end)."""
    longest = nodes.groupBy(*feed).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    state = nodes.select("id", "to", F.when(F.col("to").isNotNull(), 1).otherwise(0).cast("bigint").alias("ahead"))
    for _ in range(max(longest, 1).bit_length()):
        further = state.select(F.col("id").alias("to"), F.col("to").alias("beyond"), F.col("ahead").alias("more"))
        state = settle(
            state.join(further, "to", "left").select("id", F.col("beyond").alias("to"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead"))
        )
        if state.where("to is not null").isEmpty():
            break
    return state.select("id", "ahead", F.col("to").isNotNull().alias("looped"))


def link_order(pages: DataFrame, *, url: Column | None = None, link: Column | None = None) -> DataFrame:
    """Feed, page_no, url and ``link_place``: the page's place (from 1) by links from the feed's first page.

    Pages that the first one does not lead to by their distance from the end, and those in a loop, have no place.
    """
    nodes, feed = _linked(pages, requested_url() if url is None else url, next_link() if link is None else link)
    told = nodes.join(_distances(nodes, feed), "id")
    heads = told.groupBy(*feed).agg(F.min_by(F.struct("ahead", "looped"), F.struct("page_no", "id")).alias("head"))
    place = F.when(~F.col("looped") & ~F.col("head.looped") & (F.col("ahead") <= F.col("head.ahead")), F.col("head.ahead") - F.col("ahead") + 1)
    return told.join(heads, feed).select(*feed, "page_no", "url", place.alias("link_place"))


def link_chain_audit(pages: DataFrame, *, url: Column | None = None, link: Column | None = None) -> DataFrame:
    """Breaks in feeds whose pages name the next one by URL: (feed, page_no, problem), each once.

    ``duplicate_url``: the URL was landed before in this feed. ``missing_page``: nothing was landed for the
    next link. ``fork``: several pages lead to this one. ``orphan``: no page leads here and it is not the
    feed's first. ``cycle``: the links from here never end. ``misplaced``: by its links the page belongs
    elsewhere than its number says (in feeds with none of the other problems).
    """
    nodes, feed = _linked(pages, requested_url() if url is None else url, next_link() if link is None else link)
    entries = nodes.where("to is not null").groupBy(F.col("to").alias("id")).agg(F.count("*").alias("entries"))
    first = nodes.groupBy(*feed).agg(F.min(F.struct("page_no", "id")).alias("head"))
    same = nodes.where("url is not null").groupBy(*feed, "url").agg(F.min_by("id", F.struct("page_no", "id")).alias("kept"))
    told = settle(
        nodes.join(entries, "id", "left")
        .join(_distances(nodes, feed), "id")
        .join(first, feed)
        .join(same, [*feed, "url"], "left")
    )
    again = F.coalesce(F.col("kept") != F.col("id"), F.lit(False))
    checks = [
        ("duplicate_url", again),
        ("missing_page", F.col("link").isNotNull() & F.col("to").isNull()),
        ("fork", F.col("entries") > 1),
        ("orphan", F.col("entries").isNull() & (F.col("head.id") != F.col("id")) & ~again),
        ("cycle", F.col("looped")),
    ]
    problems = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in checks)))
    told = told.withColumn("problems", problems)
    found = told.select(*feed, "page_no", F.explode("problems").alias("problem"))
    # In a sound feed places count down to the end.
    sound = told.groupBy(*feed).agg(F.max(F.size("problems")).alias("worst"), F.max("ahead").alias("most"), F.min("page_no").alias("least")).where("worst = 0")
    misplaced = (
        told.join(sound, feed)
        .where(F.col("page_no") - F.col("least") != F.col("most") - F.col("ahead"))
        .select(*feed, "page_no", F.lit("misplaced").alias("problem"))
    )
    return found.unionByName(misplaced)
