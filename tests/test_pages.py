import json

import pytest
from pyspark.sql import functions as F

from conftest import ids, page
from pagelake.operators import pages as P
from pagelake.sources.landing import infer_record, land, overlay
from pagelake.functions.jsonpath import as_type


def test_envelope_shapes(landed):
    df = landed(
        page("s", "r", {"data": [{"id": 1}, {"id": 2}]}),
        page("s", "r", {"data": None}, no=2),
        page("s", "r", {}, no=3),
        page("s", "r", {"data": [{"id": 3}, None]}, no=4),
    )
    assert ids(P.unwrap(df, "data", "id bigint"), "id") == [(1,), (2,), (3,)]
    rows = P.unwrap(df, "data", "id bigint", position=True)
    assert ids(rows, "_page.page_no", "_pos", "id") == [(1, 0, 1), (1, 1, 2), (4, 0, 3)]


def test_a_scalar_among_the_records_costs_no_page(landed):
    df = landed(page("s", "r", {"data": [{"id": 1, "n": {"x": 1}}, 5, "t", {"id": 2, "n": "odd"}]}))
    rows = P.unwrap(df, "data", "id bigint, n struct<x:bigint>")
    assert [tuple(r) for r in rows.select("id", "n.x").orderBy("id").collect()] == [(1, 1), (2, None)]


def test_dotted_and_wildcard_selectors(landed):
    df = landed(
        page("s", "r", {"QueryResponse": {"Invoice": [{"Id": "1"}, {"Id": "2"}]}}),
        page("s", "r", {"QueryResponse": {}}, no=2),
    )
    assert ids(P.unwrap(df, "QueryResponse.Invoice", "Id string"), "Id") == [("1",), ("2",)]
    boards = landed(
        page(
            "s",
            "r",
            {
                "data": {
                    "boards": [
                        {"items_page": {"items": [{"id": "a"}, {"id": "b"}]}},
                        {"items_page": None},
                        {},
                        {"items_page": {"items": [{"id": "c"}, 7]}},
                    ]
                }
            },
        )
    )
    got = P.unwrap_wildcard(boards, "data.boards[*].items_page.items", "id string")
    assert ids(got, "id") == [("a",), ("b",), ("c",)]


def test_bare_bodies(landed):
    df = landed(page("s", "r", [{"id": 1}, {"id": 2}]), page("s", "r", {"id": 3}, no=2))
    assert ids(P.unwrap_bare(df, "id bigint"), "id") == [(1,), (2,), (3,)]


def test_item_envelope(landed):
    body = {"data": [{"item": "user", "data": {"id": 10}}, {"item": "user", "data": "x"}, 3]}
    rows = P.unwrap(landed(page("s", "r", body)), "data", "item string, data struct<id:bigint>")
    assert ids(P.unwrap_item_envelope(rows), "id") == [(10,)]


def test_status_policy(landed, spark):
    df = landed(
        page("s", "r", {"data": [{"id": 1}]}, feed="a", no=1),
        page("s", "r", None, feed="a", no=2, status=404),
        page("s", "r", {"data": [{"id": 9}]}, feed="a", no=3),
        page("s", "r", {"data": [{"id": 2}]}, feed="b", no=1),
    )
    kept = P.apply_status_policy(df, {403, 404})
    assert ids(kept, "feed", "page_no") == [("a", 1), ("b", 1)]
    assert ids(P.skipped_feeds(df, {403, 404}), "feed", "page_no", "http_status") == [("a", 2, 404)]
    with pytest.raises(Exception, match="HTTP 404 in feed a"):
        P.apply_status_policy(df, {403}).count()
    with pytest.raises(Exception, match="HTTP 404"):
        P.apply_status_policy(df).count()


@pytest.mark.parametrize("selector", ["data", "", "data.boards[*].items"])
@pytest.mark.parametrize("body", ["{oops", '{"data":[{"id":1},{"id":'])
def test_malformed(landed, selector, body):
    df = landed(page("s", "r", body), page("s", "r", {}, no=2), page("s", "r", "", no=3), page("s", "r", None, no=4))
    assert ids(P.malformed_pages(df), "page_no") == [(1,)]
    with pytest.raises(Exception, match="page body is no JSON"):
        P.unwrap(df, selector, "id bigint").collect()
    assert P.unwrap(df.where("page_no > 1"), selector, "id bigint").count() <= 1


def chain(landed, family, bodies, path="data", **more):
    df = landed(*[page("s", "r", b, no=n) if b is not None else page("s", "r", {}, no=n) for n, b in bodies])
    return ids(P.page_chain_audit(df, family, path), "page_no", "problem")


ROW = {"id": "x"}


@pytest.mark.parametrize(
    ("family", "path", "more", "last"),
    [
        ("last_id", "data", {"has_more": True, "data": [ROW]}, {"has_more": True, "data": []}),
        ("body_cursor", "data", {"pagination": {"next_cursor": "c"}}, {"pagination": {}}),
        ("after", "results", {"paging": {"next": {"after": "2"}}}, {"results": []}),
        ("offset", "results", {"hasMore": True, "offset": 3}, {"hasMore": True}),
        (
            "next_start",
            "data",
            {"additional_data": {"pagination": {"more_items_in_collection": True, "next_start": 2}}},
            {"additional_data": {"pagination": {"more_items_in_collection": True}}},
        ),
        ("scroll", "people", {"scroll_id": "s", "people": [ROW]}, {"scroll_id": "s", "people": []}),
        ("page_total", "data", {"pagination": {"total_pages": 2}}, {"pagination": {"total_pages": 2}}),
        ("page_until_empty", "jobs", {"jobs": [ROW]}, {"jobs": []}),
        ("page_of_100", "data.users", {"data": {"users": [ROW] * 100}}, {"data": {"users": [ROW] * 99}}),
        ("page_of_50", "data.boards", {"data": {"boards": [ROW] * 50}}, {"data": {"boards": []}}),
        (
            "items_cursor",
            "",
            {"data": {"boards": [{"items_page": {"cursor": "c"}}]}},
            {"data": {"boards": []}},
        ),
        (
            "start_position",
            "QueryResponse.Invoice",
            {"QueryResponse": {"Invoice": [ROW] * 1000}},
            {"QueryResponse": {"Invoice": [ROW] * 999}},
        ),
        ("next_cursor", "results", {"has_more": True, "next_cursor": "c"}, {"has_more": False}),
        ("next_link", "value", {"@odata.nextLink": "u"}, {"value": []}),
    ],
)
def test_chain_rules(landed, family, path, more, last):
    assert chain(landed, family, [(1, more), (2, last)], path) == []
    assert chain(landed, family, [(1, more)], path) == [(2, "missing_page")]
    if family != "page_total":
        assert (2, "after_end") in chain(landed, family, [(1, last), (2, last)], path)


def test_chain_problems(landed):
    more, last = {"has_more": True, "data": [{"id": "r1"}]}, {"has_more": False, "data": [ROW]}
    assert chain(landed, "last_id", [(1, more), (3, last)]) == [(2, "missing_page"), (3, "gap")]
    assert chain(landed, "last_id", [(1, more), (2, last), (2, last)]) == [(2, "duplicate_page")]
    df = landed(page("s", "r", more), page("s", "r", last, no=2, starting_after="other"))
    assert ids(P.page_chain_audit(df, "last_id"), "page_no", "problem") == [(2, "wrong_key")]
    df = landed(page("s", "r", more), page("s", "r", last, no=2, starting_after="r1"))
    assert P.page_chain_audit(df, "last_id").count() == 0
    linked = landed(page("s", "r", [], link="u"), page("s", "r", [], no=2))
    assert P.page_chain_audit(linked, "link_header").count() == 0


@pytest.mark.parametrize(
    ("family", "path", "body", "param", "right", "link"),
    [
        ("page_total", "data", {"pagination": {"total_pages": 9}}, "page", "2", None),
        ("page_until_empty", "jobs", {"jobs": [ROW]}, "page", "2", None),
        ("page_of_50", "data.boards", {"data": {"boards": [ROW] * 50}}, "page", "2", None),
        ("start_position", "QueryResponse.Invoice", {"QueryResponse": {"Invoice": [ROW] * 1000}}, "startposition", "1001", None),
        ("next_link", "value", {"@odata.nextLink": "u2"}, "url", "u2", None),
        ("link_header", "", [], "url", "u2", "u2"),
    ],
)
def test_numbers_and_links_as_keys(landed, family, path, body, param, right, link):
    for sent, problems in [(right, []), ("7", [(2, "wrong_key")])]:
        df = landed(page("s", "r", body, link=link), page("s", "r", body, no=2, link=link, **{param: sent}))
        found = ids(P.page_chain_audit(df, family, path), "page_no", "problem")
        assert [f for f in found if f[0] == 2] == problems


def test_a_feed_left_at_the_mark_is_whole(landed):
    full = {"contacts": [{"id": str(i), "updated_at": "5"} for i in range(99)] + [{"id": "z", "updated_at": "3"}]}
    df = landed(page("s", "r", full))
    assert ids(P.page_chain_audit(df, "page_of_100", "contacts"), "problem") == [("missing_page",)]
    for start, inclusive, count in [("4", True, 0), ("3", True, 1), ("3", False, 0), ("2", False, 1)]:
        left = P.holds_old_record("contacts", "updated_at", start, inclusive=inclusive)
        assert P.page_chain_audit(df, "page_of_100", "contacts", stopped=left).count() == count


def test_record_predicates(spark):
    repos = spark.createDataFrame(
        [("a", "2024", 5), ("b", None, 5), ("c", "2024", 0), ("d", "2024", None), ("e", "", 1)],
        "full_name string, pushed_at string, size bigint",
    )
    assert ids(P.crawl_targets(repos), "full_name") == [("a",)]
    messages = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, hasAttachments boolean")
    assert ids(P.with_attachments(messages), "id") == [(1,)]
    kinds = spark.createDataFrame(
        [(1, P.FILE_ATTACHMENT, None), (2, P.FILE_ATTACHMENT, True), (3, "#other", False), (4, None, None)],
        "id int, `@odata.type` string, isInline boolean",
    )
    assert ids(P.file_attachments(kinds), "id") == [(1,)]
    rows = spark.createDataFrame([(1, False), (2, True), (3, None)], "id int, archived boolean")
    assert ids(P.server_filter(rows, archived=False, other=1), "id") == [(1,), (3,)]


def test_land_then_unwrap_is_identity(spark):
    rows = spark.range(250).selectExpr("id", "id % 7 AS k", "cast(null as string) AS gone")
    pages = land(
        rows,
        record=F.struct("id", "k", "gone"),
        order=F.col("id"),
        page_no=F.floor(F.col("id") / 100) + 1,
        source="s",
        resource="r",
    )
    assert pages.count() == 3
    back = P.drop_page(P.unwrap(pages, "data", "id bigint, k bigint, gone string"))
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    assert json.loads(pages.where("page_no = 1").first()["body"])["data"][0]["gone"] is None


def test_inferred_types(landed):
    df = landed(
        page("s", "r", {"data": [{"id": 1, "a": {"b": 1.5}, "m": 1, "e": {}, "n": None}]}),
        page("s", "r", {"data": [{"id": 2, "a": {"c": "x"}, "m": "t", "l": [{"z": True}]}]}, no=2),
    )
    found = infer_record(df, "data")
    declared = as_type("a struct<b:string>, extra string")
    assert overlay(found, declared) == as_type(
        "a struct<b:string,c:string>, e string, id bigint, l array<struct<z:boolean>>, m string, "
        "n string, extra string"
    )
    rows = P.unwrap(df, "data", overlay(found, declared))
    assert ids(rows, "id", "m") == [(1, "1"), (2, "t")]
    assert len(infer_record(df.limit(0), "data").fields) == 0
