import base64
import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import ids, page
from pagelake.plans.pipeline import Run, run_source, table_of
from pagelake.session import scratch_dir
from pagelake.sources.catalog import SOURCES, resources
from pagelake.sources.catalog.attio import records_spec


@pytest.fixture
def warehouse(spark):
    return scratch_dir(spark, "warehouse")


def test_catalogue_tally():
    assert len(resources()) == 86
    assert {s.name: len(s.resources) for s in SOURCES.values()} == {
        "agree_com": 3, "apollo_io": 8, "attio": 5, "github": 7, "hubspot": 5, "loxo": 6,
        "m365_graph": 2, "monday_crm": 9, "notion": 5, "pipedrive": 7, "quickbooks": 24, "stripe": 5,
    }
    assert Counter(r.disposition for r in resources()) == {"append": 26, "merge": 21, "replace": 39}
    by = {f"{r.source}.{r.name}": r for r in resources()}
    assert by["github.pull_request_commits"].key == ("repository", "pull_number", "sha")
    assert by["quickbooks.tax_agencies"].cursor is None
    assert {n for n in SOURCES["quickbooks"].names() if n.endswith("ies")} == {
        "journal_entries", "time_activities", "tax_agencies",
    }
    assert "classes" in SOURCES["quickbooks"].names() and "preferences" in SOURCES["quickbooks"].names()


def test_attio(spark, landed, warehouse):
    def company(n, name):
        return {
            "id": {"record_id": f"rec-{n}", "workspace_id": "w", "object_id": "o"},
            "created_at": "2024-01-01T00:00:00Z",
            "web_url": "u",
            "values": {
                "name": [{"active_until": "2020", "value": "Old"}, {"active_until": None, "value": name}],
                "domains": [{"active_until": None, "domain": f"{n}.io"}],
                "region_x": [{"value": "north"}],
            },
        }

    pages = landed(
        page("attio", "companies", {"data": [company(1, "One"), company(2, "Two")], "pagination": {"next_cursor": "c"}}),
        page("attio", "companies", {"data": [company(3, "Three")], "pagination": {}}, no=2),
        page("attio", "people", None, status=403),
        page("attio", "notes", {"data": []}),
        page("attio", "rockets", {"data": [company(9, "Nine")]}),
    )
    source = SOURCES["attio"].with_resource(records_spec("rockets"))
    reports = run_source(
        spark, source, pages, warehouse, ["companies", "people", "notes", "rockets"], sentinels=True
    )
    assert {k: r.rows for k, r in reports.items()} == {"companies": 3, "people": 0, "notes": 1, "rockets": 1}
    companies = table_of(spark, warehouse, "attio", "companies").read()
    assert ids(companies, "record_id", "name", "domains", "region_x") == [
        ("rec-1", "One", "1.io", "north"),
        ("rec-2", "Two", "2.io", "north"),
        ("rec-3", "Three", "3.io", "north"),
    ]
    assert {"estimated_arr_usd", "id__workspace_id"} <= set(companies.columns)
    people = table_of(spark, warehouse, "attio", "people").read()
    assert "email_addresses" in people.columns and people.count() == 0
    assert ids(table_of(spark, warehouse, "attio", "notes").read(), "note_id") == [(None,)]
    assert ids(Run(spark, source, pages).skipped("people"), "http_status") == [(403,)]


def test_stripe(spark, landed, warehouse):
    def invoice(n, subscription, nested, lines, more):
        return {
            "id": n, "created": 1700000000, "subscription": subscription,
            "parent": {"subscription_details": {"subscription": nested}} if nested else None,
            "lines": {"has_more": more, "data": [{"id": i, "amount": 5, "invoice": None} for i in lines]},
        }

    first = {
        "data": [invoice("in_1", "sub_1", None, ["a", "b"], False), invoice("in_2", None, "sub_2", ["c"], True)],
        "has_more": False,
    }
    pages = landed(
        page("stripe", "invoices", first),
        page("stripe", "invoice_line_items", {"data": [{"id": "d", "amount": 7}]}, feed="in_2", invoice_id="in_2"),
        page("stripe", "invoice_line_items", {"data": [{"id": "z", "amount": 7}]}, feed="in_1", invoice_id="in_1"),
        page("stripe", "charges", {"data": [{"id": "ch_1", "created": 1700000000, "amount": 1}]}),
    )
    run_source(spark, SOURCES["stripe"], pages, warehouse, ["invoices", "invoice_line_items", "charges"], run_id="run-1")
    invoices = table_of(spark, warehouse, "stripe", "invoices").read()
    assert ids(invoices, "id", "subscription") == [("in_1", "sub_1"), ("in_2", "sub_2")]
    assert invoices.first()["created"] == datetime(2023, 11, 14, 22, 13, 20)
    lines = table_of(spark, warehouse, "stripe", "invoice_line_items").read()
    assert ids(lines, "invoice_id", "id") == [("in_1", "a"), ("in_1", "b"), ("in_2", "c"), ("in_2", "d")]
    assert {"price__id", "proration"} <= set(lines.columns)
    child = table_of(spark, warehouse, "stripe", "invoices", "lines__data").read()
    assert ids(child, "parent_id", "list_idx", "id") == [("in_1", 0, "a"), ("in_1", 1, "b"), ("in_2", 0, "c")]
    # Second run: the record at the mark is not loaded again, nor are its lines.
    second = {"data": [invoice("in_1", "sub_1", None, ["a", "b"], False), {**invoice("in_3", "s", None, ["e"], False), "created": 1700000001}]}
    later = landed(page("stripe", "invoices", second, run="run-2"))
    reports = run_source(spark, SOURCES["stripe"], later, warehouse, ["invoices", "invoice_line_items"], run_id="run-2")
    # Line items follow the increment of their own run.
    assert reports["invoices"].rows == 1 and reports["invoice_line_items"].rows == 1
    assert reports["invoices"].high_water == "2023-11-14T22:13:21.000000Z"


def test_hubspot(spark, landed, warehouse):
    def company(n, name, domain, at, **more):
        return {"id": n, "updatedAt": at, "properties": {"name": name, "domain": domain, "unlisted": 1}, **more}

    pages = landed(
        page("hubspot", "companies", {"results": [company("1", "Acme", "a.com", "2024-01-01T00:00:00Z"), company("9", "Gone", "g.com", "2024-01-01T00:00:00Z", archived=True)], "paging": {"next": {"after": "2"}}}),
        page("hubspot", "companies", {"results": [company("2", "Beta", None, "2024-01-02T00:00:00Z")]}, no=2),
        page("hubspot", "engagements", {"results": [
            {"engagement": {"id": 101, "lastUpdated": 5, "bodyPreview": "b", "type": "NOTE"}, "associations": {"contactIds": [1001, 1002]}},
            {"engagement": {"id": 102, "lastUpdated": 12}, "associations": {}},
        ]}),
        page("hubspot", "deal_pipelines", {"results": [{"id": "p", "stages": [{"id": "s", "label": "l"}]}, {"id": "q"}]}),
    )
    source = SOURCES["hubspot"]
    reports = run_source(spark, source, pages, warehouse, ["companies", "engagements", "deal_pipelines"])
    assert reports["engagements"].high_water == "12"
    got = table_of(spark, warehouse, "hubspot", "companies").read().na.fill("-")
    assert ids(got, "id", "properties__name", "properties__domain") == [("1", "Acme", "a.com"), ("2", "Beta", "-")]
    assert "properties__website" in got.columns and "properties__unlisted" not in got.columns
    eng = table_of(spark, warehouse, "hubspot", "engagements").read().orderBy("id").collect()
    assert json.loads(eng[0]["associations__contact_ids"]) == [1001, 1002]
    assert eng[0]["body_preview"] == "b" and eng[1]["associations__deal_ids"] == "[]"
    stages = table_of(spark, warehouse, "hubspot", "deal_pipelines").read().orderBy("id").collect()
    assert json.loads(stages[0]["stages"]) == [{"id": "s", "label": "l"}] and stages[1]["stages"] == "[]"
    again = run_source(spark, source, pages, warehouse, ["engagements", "companies"])
    assert (again["engagements"].rows, again["companies"].rows) == (0, 0)


def test_pipedrive(spark, landed, warehouse):
    def body(*rows):
        return {"success": True, "data": list(rows), "additional_data": {"pagination": {"more_items_in_collection": False}}}

    at = {"update_time": "2024-01-01 00:00:00"}
    pages = landed(
        page("pipedrive", "persons", body(
            {"id": 1, "email": [{"value": "a@x.io", "primary": False}, {"value": "b@x.io", "primary": True}], "phone": [], "owner_id": {"id": 10, "name": "O"}, **at},
            {"id": 2, "email": [], "phone": [{"value": "+1"}], "owner_id": 11, **at},
        )),
        page("pipedrive", "deals", body({"id": 101, "user_id": {"id": 10}, "creator_user_id": 12, "stage_id": 7, "pipeline_id": 3, **at}, {"id": 102, "user_id": None, **at})),
        page("pipedrive", "users", body({"item": "user", "data": {"id": 10, "name": "Owner A", "modified": "2024-01-01 00:00:00"}}, {"item": "user", "data": None}, {"item": "deal", "data": {"id": 5, "modified": "x"}})),
        page("pipedrive", "stages", body({"id": 7, "pipeline_id": 3, "name": "Won"})),
    )
    run_source(spark, SOURCES["pipedrive"], pages, warehouse, ["persons", "deals", "users", "stages"])

    def read(name):
        return table_of(spark, warehouse, "pipedrive", name).read()

    rows = read("persons").orderBy("id").select("id", "email_primary", "phone_primary", "owner_id").collect()
    assert [tuple(r) for r in rows] == [(1, "a@x.io", None, 10), (2, None, "+1", 11)]
    rows = read("deals").orderBy("id").select("id", "user_id", "creator_user_id").collect()
    assert [tuple(r) for r in rows] == [(101, 10, 12), (102, None, None)]
    assert ids(read("users"), "id", "name") == [(10, "Owner A")]
    assert dict(read("stages").dtypes)["rotten_days"] == "bigint"
    assert ids(table_of(spark, warehouse, "pipedrive", "persons", "email").read(), "parent_id", "list_idx") == [(1, 0), (1, 1)]


def test_notion_two_runs(spark, landed, warehouse):
    def item(n, at, **more):
        return {"id": n, "object": "page", "last_edited_time": at, "properties": {"Deal Value (ARR)": {"number": 1}}, "created_by": {"id": "u"}, **more}

    def block(n, at, kind="paragraph"):
        return {"id": n, "type": kind, "last_edited_time": at, kind: {"rich_text": [{"plain_text": n}]}}

    t1, t2, t3 = "2024-01-01T00:00:00.000Z", "2024-01-02T00:00:00.000Z", "2024-01-03T00:00:00.000Z"
    one = landed(
        page("notion", "pages", {"results": [item("p2", t2), item("p1", t1)]}),
        page("notion", "blocks", {"results": [block("b1", t1)]}, feed="p1", page_id="p1"),
        page("notion", "blocks", None, status=404, feed="p2", page_id="p2"),
        page("notion", "comments", {"results": [{"id": "c1", "discussion_id": "d"}]}, feed="b1", block_id="b1"),
    )
    source = SOURCES["notion"]
    names = ["pages", "blocks", "comments"]
    reports = run_source(spark, source, one, warehouse, names, run_id="run-1")
    assert [reports[n].rows for n in names] == [2, 1, 1]
    pages_table = table_of(spark, warehouse, "notion", "pages")
    row = pages_table.read().where("id = 'p1'").first()
    assert json.loads(row["properties"]) == {"Deal Value (ARR)": {"number": 1}} and row["page_id"] == "p1"
    assert json.loads(row["created_by"]) == {"id": "u"} and row["last_edited_time"] == datetime(2024, 1, 1)
    assert ids(table_of(spark, warehouse, "notion", "comments").read(), "id", "block_id") == [("c1", "b1")]
    assert pages_table.high_water("pages") == t2
    two = landed(
        page("notion", "pages", {"results": [item("p3", t3), item("p2", t2), item("p9", t3)]}, run="run-2"),
        page("notion", "blocks", {"results": [block("b9", t3), block("b8", t1)]}, run="run-2", feed="p3", page_id="p3"),
        page("notion", "blocks", {"results": [block("b7", t3)]}, run="run-2", feed="p2", page_id="p2"),
    )
    reports = run_source(spark, source, two, warehouse, ["pages", "blocks"], run_id="run-2")
    assert ids(pages_table.read(), "id") == [("p1",), ("p2",), ("p3",)]
    assert ids(table_of(spark, warehouse, "notion", "blocks").read(), "id", "page_id") == [("b1", "p1"), ("b9", "p3")]
    assert ids(Run(spark, source, one).skipped("blocks"), "feed", "http_status") == [("p2", 404)]
    bad = landed(page("notion", "comments", None, status=400, feed="b1", block_id="b1"), *[tuple(r) for r in one.collect() if r["resource"] != "comments"])
    with pytest.raises(Exception, match="HTTP 400"):
        Run(spark, source, bad).rows("comments").collect()


def test_github(spark, landed, warehouse):
    def repo(n, pushed, size, at):
        return {"id": hash(n) % 1000, "full_name": n, "pushed_at": pushed, "size": size, "updated_at": at}

    def pull(n, number, at):
        return {"id": number, "number": number, "updated_at": at, "base": {"repo": {"full_name": n}}, "title": "t"}

    def commit(sha):
        return {"sha": sha, "commit": {"committer": {"date": "2024-01-01T00:00:00Z"}}}

    at = "2024-01-01T00:00:00Z"
    pages = landed(
        page("github", "organizations", {"id": 1, "login": "o", "name": None}, feed="o"),
        page("github", "organizations", None, status=404, feed="lost"),
        page("github", "users", [{"id": 5, "login": "u"}], feed="o", organization="o"),
        page("github", "users", [{"id": 5, "login": "u"}], feed="p", organization="p"),
        page("github", "repositories", [repo("o/a", "x", 3, at), repo("o/empty", None, 0, at)], feed="o"),
        page("github", "pull_requests", [pull("o/a", 1, at)], feed="o/a", repository="o/a"),
        page("github", "pull_requests", [pull("o/empty", 9, at)], feed="o/empty", repository="o/empty"),
        page("github", "commits", [commit("s1")], feed="o/a", repository="o/a"),
        page("github", "commits", None, status=409, feed="o/empty", repository="o/empty"),
        page("github", "pull_request_commits", [commit("s2"), commit("s3")], feed="o/a#1", repository="o/a", pull_number="1"),
        page("github", "pull_request_commits", [commit("s9")], feed="o/a#7", repository="o/a", pull_number="7"),
        page("github", "pull_request_stats", {"id": 1, "number": 1, "additions": 4}, feed="o/a#1", repository="o/a", pull_number="1"),
    )
    run = Run(spark, SOURCES["github"], pages)
    assert ids(run.rows("organizations"), "id", "login") == [(1, "o")]
    assert dict(run.rows("organizations").dtypes)["created_at"] == "timestamp"
    assert ids(run.rows("users"), "id", "organization") == [(5, "o"), (5, "p")]
    assert run.rows("repositories").count() == 2
    assert ids(run.rows("pull_requests"), "id", "base__repo__full_name") == [(1, "o/a")]
    assert ids(run.rows("commits"), "sha", "repository", "_cursor") == [("s1", "o/a", at)]
    assert ids(run.rows("pull_request_commits"), "repository", "pull_number", "sha") == [("o/a", 1, "s2"), ("o/a", 1, "s3")]
    assert ids(run.rows("pull_request_stats"), "repository", "additions") == [("o/a", 4)]
    later = Run(spark, SOURCES["github"], pages, {"pull_requests": at, "commits": at})
    assert later.rows("pull_requests").count() == 0 and later.rows("pull_request_commits").count() == 0
    assert later.rows("commits").count() == 0


def index(n):
    return base64.b64encode(b"x" * n).decode()


def test_documents_two_runs(spark, landed, warehouse):
    def message(n, at, subject, size, address, has=True):
        return {
            "id": n, "receivedDateTime": at, "subject": subject, "conversationIndex": index(size), "hasAttachments": has,
            "conversationId": "t", "from": {"emailAddress": {"address": address}}, "webLink": "w",
        }

    def attachment(n, name, kind="file", inline=None):
        return {"@odata.type": f"#microsoft.graph.{kind}Attachment", "id": n, "name": name, "isInline": inline, "contentBytes": "QQ==", "size": 1}

    def item(n, name, at="2024-02-01T00:00:00Z", file=True):
        return {"id": n, "name": name, "lastModifiedDateTime": at, "createdBy": {"user": {"email": "Me@Corp.io"}}, **({"file": {"mimeType": "m"}} if file else {"folder": {}})}

    pages = landed(
        page("m365_graph", "messages", {"value": [
            message("B", "2024-01-03T00:00:00Z", "RE: NDA", 27, "Bob@Acme.com"),
            message("C", "2024-01-02T00:00:00Z", "x", 22, "c@c.io", has=False),
            message("A", "2024-01-01T00:00:00Z", "NDA", 22, "me@our.org"),
        ]}),
        page("m365_graph", "attachments", {"value": [attachment("a1", "NDA.docx"), attachment("a2", "teaser.pdf"), attachment("a3", "logo.png", inline=True), attachment("a4", "x", kind="item")]}, feed="A", message_id="A"),
        page("m365_graph", "attachments", {"value": [attachment("b1", "")]}, feed="B", message_id="B"),
        page("m365_graph", "attachments", {"value": [attachment("c1", "no")]}, feed="C", message_id="C"),
        page("m365_graph", "drive_children", {"value": [item("i1", "NDA.docx"), item("i2", "redline.docx"), item("i3", "CIM v2.pdf"), item("i4", "folder", file=False)]}),
    )
    content = spark.createDataFrame([(i, bytearray(b"A")) for i in ("i1", "i2", "i3", "i9")], "item_id string, content binary")
    source = SOURCES["m365_graph"]
    more = {"mailbox": "in@our.org", "site_id": "s", "content": content}
    run_source(spark, source, pages, warehouse, **more)
    table = table_of(spark, warehouse, "m365_graph", "documents")
    assert ids(table.read(), "document_id", "doc_role", "round_no", "counterparty") == [
        ("outlook:A:a1", "fresh_nda", 1, "our.org"),
        ("outlook:A:a2", "teaser", 1, "our.org"),
        ("outlook:B:b1", "counterparty_return", 2, "acme.com"),
        ("sharepoint:s:i1", "fresh_nda", 1, "Me@Corp.io"),
        ("sharepoint:s:i2", "counterparty_return", 2, "Me@Corp.io"),
        ("sharepoint:s:i3", "teaser", 2, "Me@Corp.io"),
    ]
    assert {r["content_base64"] for r in table.read().collect()} == {"QQ==", "QQ=="}
    assert table.read().where("document_id = 'outlook:B:b1'").first()["filename"] == "attachment"
    assert len(table.read().columns) == 21
    assert table.high_water("mail_documents") == "2024-01-03T00:00:00Z"
    assert table.high_water("sharepoint_documents") == "2024-02-01T00:00:00Z"
    later = landed(
        page("m365_graph", "messages", {"value": [message("D", "2024-01-04T00:00:00Z", "NDA", 32, "d@d.io"), message("B", "2024-01-03T00:00:00Z", "RE: NDA", 27, "Bob@Acme.com")]}),
        page("m365_graph", "attachments", {"value": [attachment("d1", "NDA.docx")]}, feed="D", message_id="D"),
        page("m365_graph", "drive_children", {"value": [item("i1", "NDA.docx"), item("i9", "NDA v3_countersigned.pdf", at="2024-02-02T00:00:00Z")]}),
    )
    reports = run_source(spark, source, later, warehouse, **more)
    assert {r.rows for r in reports.values()} == {1}
    fresh = table.read().where("document_id like '%:d1' or document_id like '%:i9'")
    assert ids(fresh, "doc_role", "round_no") == [("counterparty_return", 3)] * 2
    assert table.read().count() == 8
    lost = {**more, "content": content.where("item_id <> 'i9'")}
    with pytest.raises(Exception, match="no content for item i9"):
        Run(spark, source, later, **lost).rows("sharepoint_documents").collect()


def test_quickbooks(spark, landed, warehouse):
    def customer(n, at, **more):
        return {"Id": n, "MetaData": {"CreateTime": at, "LastUpdatedTime": at}, "PrimaryEmailAddr": {"Address": f"{n}@x.io"}, **more}

    t1, t2 = "2024-01-01T00:00:00-08:00", "2024-01-02T00:00:00-08:00"
    pages = landed(
        page("quickbooks", "customers", {"QueryResponse": {"Customer": [customer("1", t1, Lines=[{"N": 1}, {"N": 2}]), customer("2", t2)]}}),
        page("quickbooks", "tax_agencies", {"QueryResponse": {"TaxAgency": [{"Id": "7", "DisplayName": "T"}]}}),
        page("quickbooks", "employees", {"QueryResponse": {}}),
    )
    source = SOURCES["quickbooks"]
    run_source(spark, source, pages, warehouse, ["customers", "tax_agencies", "employees"])
    table = table_of(spark, warehouse, "quickbooks", "customers")
    assert ids(table.read(), "id", "primary_email_addr__address", "meta_data__last_updated_time") == [
        ("1", "1@x.io", datetime(2024, 1, 1, 8)),
        ("2", "2@x.io", datetime(2024, 1, 2, 8)),
    ]
    assert ids(table_of(spark, warehouse, "quickbooks", "tax_agencies").read(), "id") == [("7",)]
    assert table_of(spark, warehouse, "quickbooks", "employees").read().count() == 0
    child = table_of(spark, warehouse, "quickbooks", "customers", "lines")
    assert ids(child.read(), "parent_id", "list_idx", "n") == [("1", 0, 1), ("1", 1, 2)]
    later = landed(page("quickbooks", "customers", {"QueryResponse": {"Customer": [customer("1", "2024-01-03T00:00:00Z", GivenName="G", Lines=[{"N": 5}]), customer("2", t2)]}}))
    assert run_source(spark, source, later, warehouse, ["customers"])["customers"].rows == 1
    assert ids(table.read().na.fill("-"), "id", "given_name") == [("1", "G"), ("2", "-")]
    assert ids(child.read(), "parent_id", "list_idx", "n") == [("1", 0, 5)]


def test_monday(spark, landed):
    boards = {"data": {"boards": [{"id": "1", "name": "b", "columns": [{"id": "c", "title": "C"}], "groups": None}, {"id": "2", "columns": [], "groups": [{"id": "g"}]}]}}
    items = {"data": {"boards": [{"items_page": {"cursor": None, "items": [{"id": "i1", "updated_at": None}, {"id": "i2", "updated_at": "2024"}]}}]}}
    run = Run(spark, SOURCES["monday_crm"], landed(page("monday_crm", "boards", boards), page("monday_crm", "items", items)), {"items": "2025"})
    assert ids(run.rows("columns"), "id", "board_id") == [("c", "1")]
    assert ids(run.rows("groups"), "id", "board_id") == [("g", "2")]
    assert ids(run.rows("boards"), "id") == [("1",), ("2",)]
    assert ids(run.rows("items"), "id") == [("i1",)]
    assert run.rows("users").count() == 0


def test_apollo(spark, landed):
    rows = [{"id": "1", "updated_at": "5"}, {"id": "2", "updated_at": "4"}, {"id": "3"}, {"id": "4", "updated_at": "3"}, {"id": "5", "updated_at": "9"}]
    pages = landed(page("apollo_io", "contacts", {"contacts": rows}), page("apollo_io", "sequences", {"emailer_campaigns": [{"id": "s"}]}))
    assert Run(spark, SOURCES["apollo_io"], pages).rows("contacts").count() == 5
    run = Run(spark, SOURCES["apollo_io"], pages, {"contacts": "4"})
    assert ids(run.rows("contacts"), "id") == [("1",), ("2",), ("3",)]
    assert ids(run.rows("sequences"), "id") == [("s",)]


def test_agree_and_loxo(spark, landed):
    invoice = {"id": "i", "amount": {"amount": 100, "currency": "USD"}, "sales_tax_percentage": 8.25, "due_at": "2024-01-01T00:00:00Z"}
    pages = landed(
        page("agree_com", "invoices", {"data": [invoice], "pagination": {"total_pages": 1}}),
        page("loxo", "people", {"people": [{"id": 1}], "scroll_id": "s"}),
        page("loxo", "people", {"people": [], "scroll_id": "s"}, no=2),
        page("loxo", "activities", {"person_events": [{"id": "e"}]}),
    )
    row = Run(spark, SOURCES["agree_com"], pages).rows("invoices").first()
    assert row["amount__amount"] == 100 and str(row["sales_tax_percentage"]) == "8.250000000"
    assert row["due_at"] == datetime(2024, 1, 1) and row["paid_at"] is None
    assert ids(Run(spark, SOURCES["loxo"], pages).rows("people"), "id") == [("1",)]
    assert ids(Run(spark, SOURCES["loxo"], pages).rows("activities"), "id") == [("e",)]


def test_an_old_run_does_not_cut_a_new_one(landed):
    from pagelake.sources.catalog.m365_graph import fresh_messages

    message = lambda i, at: {"id": i, "receivedDateTime": at}
    pages = landed(
        page("m365_graph", "messages", {"value": [message("old", "2024-01-01T00:00:00Z")]}, run="run-1"),
        page("m365_graph", "messages", {"value": [message("b", "2024-03-02T00:00:00Z"), message("a", "2024-03-01T00:00:00Z")]}, run="run-2"),
    )
    assert ids(fresh_messages(pages, "2024-02-01T00:00:00Z"), "id") == [("a",), ("b",)]
