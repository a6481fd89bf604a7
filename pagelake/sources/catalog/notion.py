"""Workspace users, databases, pages, blocks and comments."""

from __future__ import annotations

from functools import partial

from pagelake.operators.contract import columns
from pagelake.operators.nested import alias_column
from pagelake.operators.pages import server_filter
from pagelake.specs import Cursor, Parent, Resource, Source

# Column contracts.
USERS = columns(text=["id", "type", "name", "avatar_url", "person__email", "bot__owner__type"])
DATABASES = columns(
    text=["id", "object", "url", "parent__type", "parent__page_id"],
    timestamp=["created_time", "last_edited_time"],
    bool=["archived"],
    json=["parent__workspace"],
)
PAGES = columns(
    text=["id", "object", "url", "parent__type", "parent__database_id", "parent__page_id"],
    timestamp=["created_time", "last_edited_time"],
    bool=["archived"],
    json=["properties", "created_by", "last_edited_by"],
)
BLOCKS = columns(
    text=[
        "id",
        "object",
        "type",
        "page_id",
        "parent__type",
        "parent__page_id",
        "parent__block_id",
    ],
    timestamp=["created_time", "last_edited_time"],
    bool=["archived", "has_children"],
)
COMMENTS = columns(
    text=[
        "id",
        "object",
        "discussion_id",
        "block_id",
        "parent__type",
        "parent__page_id",
        "parent__block_id",
        "created_by__id",
    ],
    timestamp=["created_time", "last_edited_time"],
)

NOT_SHARED = frozenset({404})
_EDITED = "last_edited_time"
_NEWEST_FIRST = Cursor(_EDITED, how="take_while", missing="stale")


def _resource(name: str, contract: dict[str, str], **more: object) -> Resource:
    return Resource(
        "notion", name, "results", "next_cursor", contract=contract, **{"declared": "id string", **more}
    )


SOURCE = Source(
    "notion",
    (
        _resource("users", USERS),
        _resource(
            "databases",
            DATABASES,
            disposition="append",
            cursor=_NEWEST_FIRST,
            # Property names differ per workspace, so the object stays JSON text.
            declared="id string, object string, parent struct<workspace:string>, properties string",
            transforms=(partial(server_filter, object="database"),),
        ),
        _resource(
            "pages",
            PAGES,
            disposition="append",
            cursor=_NEWEST_FIRST,
            declared=(
                "id string, object string, parent struct<workspace:string>, properties string, "
                "created_by string, last_edited_by string"
            ),
            transforms=(
                partial(server_filter, object="page"),
                partial(alias_column, column="id", name="page_id"),
            ),
        ),
        _resource(
            "blocks",
            BLOCKS,
            disposition="append",
            cursor=Cursor(_EDITED, how="skip_stale", missing="stale"),
            skip=NOT_SHARED,
            parent=Parent("pages", {"page_id": "id"}, {"page_id": "id"}),
        ),
        _resource(
            "comments",
            COMMENTS,
            disposition="append",
            skip=NOT_SHARED,
            parent=Parent("blocks", {"block_id": "id"}, {"block_id": "id"}),
        ),
    ),
)
