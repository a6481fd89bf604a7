"""Mail attachments and library files, classified into one documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pagelake.operators.dependent import DOCUMENT_TYPES, mail_documents, sharepoint_documents
from pagelake.operators.incremental import skip_stale, take_while_fresh
from pagelake.operators.pages import PAGE, drop_page, file_items, unwrap
from pagelake.specs import Cursor, Resource, Source

# The message fields asked for.
MESSAGE = (
    "id string, subject string, receivedDateTime string, conversationId string, "
    "conversationIndex string, hasAttachments boolean, "
    "`from` struct<emailAddress:struct<address:string,name:string>>, webLink string"
)
ITEM = (
    "id string, name string, size bigint, webUrl string, lastModifiedDateTime string, "
    "file struct<mimeType:string>, createdBy struct<user:struct<email:string,displayName:string>>"
)


def fresh_messages(pages: DataFrame, start: str | None) -> DataFrame:
    """Messages of the newest-first feed before the first old one."""
    rows = unwrap(pages, "value", MESSAGE, position=True)
    feed = [f"{PAGE}.run_id", f"{PAGE}.feed"]
    return drop_page(take_while_fresh(rows, "receivedDateTime", start, feed=feed))


def fresh_items(pages: DataFrame, start: str) -> DataFrame:
    """File items of the unsorted listing that changed after the mark."""
    return skip_stale(drop_page(file_items(unwrap(pages, "value", ITEM))), "lastModifiedDateTime", start)


def _mail(run, resource: Resource) -> DataFrame:
    messages = fresh_messages(run.pages("messages"), run.start(resource))
    return mail_documents(messages, run.pages("attachments"), run.options["mailbox"])


def _files(run, resource: Resource) -> DataFrame:
    items = fresh_items(run.pages("drive_children"), run.start(resource))
    return sharepoint_documents(items, run.options["content"], run.options["site_id"])


def _resource(name: str, cursor: str, how: str, build) -> Resource:
    return Resource(
        "m365_graph",
        name,
        "value",
        "next_link",
        key=("document_id",),
        disposition="merge",
        cursor=Cursor(cursor, how=how, missing="stale"),
        contract=DOCUMENT_TYPES,
        table="documents",
        build=build,
    )


SOURCE = Source(
    "m365_graph",
    (
        _resource("mail_documents", "received_at", "take_while", _mail),
        _resource("sharepoint_documents", "modified_at", "skip_stale", _files),
    ),
)
