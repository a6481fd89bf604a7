"""Sales pipeline feeds; offset pages."""

from __future__ import annotations

from functools import partial

from pagelake.operators.contract import columns
from pagelake.operators.nested import first_values, refs_to_ids
from pagelake.operators.pages import server_filter, unwrap_item_envelope
from pagelake.specs import Cursor, Resource, Source

# Column contracts.
CONTRACTS = {
    "users": columns(text=["name", "email", "default_currency", "timezone_name"]),
    "persons": columns(
        text=["name", "first_name", "org_name", "email_primary", "phone_primary"],
        bigint=["owner_id", "org_id"],
    ),
    "leads": columns(
        text=["title", "source_name"],
        bigint=["owner_id", "creator_id", "person_id", "organization_id"],
    ),
    "organizations": columns(text=["name", "owner_name"]),
    "deals": columns(
        text=["title", "currency", "status", "person_name", "owner_name"],
        bigint=["stage_id", "pipeline_id", "person_id", "user_id", "creator_user_id"],
    ),
    "activities": columns(
        text=["type", "subject", "owner_name", "due_date", "due_time", "duration"],
        bigint=["user_id", "assigned_to_user_id", "company_id"],
    ),
    "stages": columns(
        text=["name", "pipeline_name"],
        bigint=["id", "pipeline_id", "order_nr", "deal_probability", "rotten_days"],
    ),
}

_ENTRIES = "array<struct<label:string,primary:boolean,value:string>>"


def _resource(name: str, **more: object) -> Resource:
    given = {
        "disposition": "append",
        "cursor": Cursor("update_time"),
        "declared": "id bigint",
        **more,
    }
    return Resource("pipedrive", name, "data", "next_start", contract=CONTRACTS[name], **given)


SOURCE = Source(
    "pipedrive",
    (
        _resource(
            "users",
            cursor=Cursor("modified"),
            declared=(
                "item string, data struct<id:bigint,modified:string,name:string,email:string,"
                "default_currency:string,timezone_name:string>"
            ),
            transforms=(partial(server_filter, item="user"), unwrap_item_envelope),
        ),
        _resource(
            "persons",
            declared=f"id bigint, owner_id string, email {_ENTRIES}, phone {_ENTRIES}",
            transforms=(
                partial(first_values, names={"email": "email_primary", "phone": "phone_primary"}),
                partial(refs_to_ids, names=["owner_id"]),
            ),
        ),
        _resource("leads", declared="id string"),
        _resource("organizations"),
        _resource(
            "deals",
            declared="id bigint, user_id string, creator_user_id string",
            transforms=(partial(refs_to_ids, names=["user_id", "creator_user_id"]),),
        ),
        _resource("activities"),
        _resource("stages", disposition="replace", cursor=None),
    ),
)
