"""Objects with time-versioned attribute values, lists and notes."""

from __future__ import annotations

from functools import partial

from pagelake.operators.contract import columns
from pagelake.operators.nested import promote_found, promote_nested_key
from pagelake.specs import Resource, Source

# Text columns of each resource.
OBJECT_COLUMNS = {
    "companies": (
        "record_id",
        "id__workspace_id",
        "id__object_id",
        "web_url",
        "name",
        "domains",
        "description",
        "categories",
        "primary_location",
        "estimated_arr_usd",
        "employee_range",
        "foundation_date",
        "created_at",
    ),
    "people": (
        "record_id",
        "id__workspace_id",
        "id__object_id",
        "web_url",
        "name",
        "email_addresses",
        "phone_numbers",
        "job_title",
        "company",
        "created_at",
    ),
    "deals": (
        "record_id",
        "id__workspace_id",
        "id__object_id",
        "web_url",
        "name",
        "stage",
        "value",
        "owner",
        "associated_company",
        "estimated_close_date",
        "created_at",
    ),
}
LIST_COLUMNS = (
    "list_id",
    "id__workspace_id",
    "api_slug",
    "name",
    "workspace_access",
    "created_at",
)
NOTE_COLUMNS = (
    "note_id",
    "id__workspace_id",
    "parent_object",
    "parent_record_id",
    "title",
    "content_plaintext",
    "content_markdown",
    "meeting_id",
    "created_by_actor__id",
    "created_by_actor__type",
    "created_at",
)
NO_SCOPE = frozenset({403})

_RECORD_FIELDS = ("record_id", "web_url", "created_at")


def records_spec(slug: str) -> Resource:
    """Records of a standard or custom object."""
    declared = OBJECT_COLUMNS.get(slug, ("record_id",))
    attributes = [c for c in declared if c not in _RECORD_FIELDS and "__" not in c]
    return Resource(
        "attio",
        slug,
        "data",
        "body_cursor",
        key=("record_id",),
        skip=NO_SCOPE,
        contract=columns(text=declared),
        declared=(
            "id struct<record_id:string,workspace_id:string,object_id:string>, "
            "values string, created_at string, web_url string"
        ),
        transforms=(
            partial(promote_nested_key, column="id", key="record_id"),
            partial(promote_found, known=attributes),
        ),
    )


def _single(name: str, key: str, names: tuple[str, ...], **more: object) -> Resource:
    return Resource(
        "attio",
        name,
        "data",
        "single",
        key=(key,),
        skip=NO_SCOPE,
        contract=columns(text=names),
        declared=f"id struct<{key}:string,workspace_id:string>",
        transforms=(partial(promote_nested_key, column="id", key=key),),
        **more,
    )


SOURCE = Source(
    "attio",
    (
        *[records_spec(slug) for slug in OBJECT_COLUMNS],
        _single("lists", "list_id", LIST_COLUMNS),
        _single("notes", "note_id", NOTE_COLUMNS, sentinel=True),
    ),
)
