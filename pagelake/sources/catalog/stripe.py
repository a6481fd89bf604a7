"""Billing objects; pages continue after the last id."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from pagelake.operators.contract import columns
from pagelake.operators.dependent import invoice_line_items
from pagelake.operators.nested import epoch_column, hoist_if_null
from pagelake.specs import Cursor, Resource, Source

# Column contracts.
CONTRACTS = {
    "charges": columns(
        text=[
            "customer",
            "description",
            "invoice",
            "payment_intent",
            "payment_method",
            "failure_code",
            "failure_message",
        ]
    ),
    "customers": columns(text=["email", "name", "description", "phone", "currency"]),
    "invoices": columns(
        text=[
            "subscription",
            "customer_email",
            "customer_name",
            "number",
            "billing_reason",
            "collection_method",
            "metadata__bu",
        ],
        bigint=["due_date", "status_transitions__paid_at"],
    ),
    "refunds": columns(text=["reason"]),
    "invoice_line_items": columns(
        text=["invoice_id", "subscription", "description", "currency", "price__id", "proration"]
    ),
}

_INVOICE = (
    "id string, created double, subscription string, "
    "parent struct<subscription_details:struct<subscription:string>>, "
    "lines struct<has_more:boolean,data:array<struct<id:string>>>"
)


def _resource(name: str, declared: str = "id string, created double", **more: object) -> Resource:
    transforms = (partial(epoch_column, column="created"), *more.pop("transforms", ()))
    return Resource(
        "stripe",
        name,
        "data",
        "last_id",
        disposition="append",
        cursor=Cursor("created", kind="timestamp", floor="1970-01-01T00:00:00Z"),
        contract=CONTRACTS[name],
        declared=declared,
        transforms=transforms,
        max_nesting=1,
        **more,
    )


def _lines(run, resource: Resource) -> DataFrame:
    invoices = run.increment("invoices")
    line = invoices.schema["lines"].dataType["data"].dataType.elementType
    return invoice_line_items(invoices, run.pages(resource.name), line)


SOURCE = Source(
    "stripe",
    (
        _resource("charges"),
        _resource("customers"),
        _resource(
            "invoices",
            _INVOICE,
            transforms=(
                partial(
                    hoist_if_null,
                    column="subscription",
                    path="parent.subscription_details.subscription",
                ),
            ),
        ),
        _resource("refunds"),
        Resource(
            "stripe",
            "invoice_line_items",
            "data",
            "last_id",
            disposition="append",
            contract=CONTRACTS["invoice_line_items"],
            max_nesting=1,
            build=_lines,
        ),
    ),
)
