"""Eight sales-engagement feeds; numbered pages of 100, ended by a short or empty page."""

from __future__ import annotations

from pagelake.specs import Cursor, Resource, Source


def _resource(name: str, selector: str, chain: str, **more: object) -> Resource:
    return Resource(
        "apollo_io", name, selector, chain, declared="id string", sentinel=True, **more
    )


# Newest first, ended by the first row strictly older than the mark; rows without a
# cursor are kept.
_CONTACT_CURSOR = Cursor(
    "updated_at", range_start="closed", missing="include", how="take_while", floor=None
)

SOURCE = Source(
    "apollo_io",
    (
        _resource(
            "contacts", "contacts", "page_of_100", disposition="append", cursor=_CONTACT_CURSOR
        ),
        _resource("accounts", "accounts", "page_of_100"),
        _resource("people", "people", "page_of_100"),
        _resource("opportunities", "opportunities", "page_of_100"),
        _resource("sequences", "emailer_campaigns", "page_of_100"),
        _resource("users", "users", "page_of_100"),
        _resource("email_accounts", "email_accounts", "page_until_empty"),
        _resource("labels", "labels", "page_until_empty"),
    ),
)
