"""Agreements, contacts and invoices; numbered pages with a page total."""

from __future__ import annotations

from pagelake.operators.contract import columns
from pagelake.specs import Cursor, Resource, Source

# Column contracts.
AGREEMENTS = columns(
    text=[
        "id",
        "name",
        "status",
        "organization_id",
        "invoice_template_id",
        "delivery_mode",
        "reminder_schedule",
        "docs_url",
        "share_url",
        "preview_url",
    ],
    bigint=["version"],
    bool=["payments_enabled", "signing_order_enabled", "forward_signature_enabled"],
    timestamp=[
        "starts_at",
        "executed_at",
        "ends_at",
        "deleted_at",
        "reminder_scheduled_at",
        "last_reminder_sent_at",
    ],
)
CONTACTS = columns(
    text=["id", "name", "email", "title", "company", "organization_id"],
    timestamp=["inserted_at", "updated_at"],
)
INVOICES = columns(
    text=[
        "id",
        "name",
        "agreement_id",
        "status",
        "amount__currency",
        "billing_contact__email",
        "billing_contact__name",
        "billing_contact__company",
        "customer_id",
        "organization_id",
        "destination_organization_id",
        "external_id",
        "external_customer_id",
        "qbo_invoice_id",
        "xero_invoice_id",
        "delivery_method",
        "payment_type",
        "memo",
        "invoice_url",
        "payment_link",
        "subscription_url",
    ],
    bigint=["amount__amount", "recurring_sequence"],
    bool=["automatic_delivery"],
    decimal=["sales_tax_percentage"],
    timestamp=[
        "inserted_at",
        "due_at",
        "paid_at",
        "sent_at",
        "reviewed_at",
        "authorized_at",
        "processing_at",
        "scheduled_at",
        "reminder_scheduled_at",
        "last_reminder_sent_at",
    ],
)


def _resource(name: str, contract: dict[str, str], **more: object) -> Resource:
    return Resource(
        "agree_com", name, "data", "page_total", contract=contract, declared="id string", **more
    )


SOURCE = Source(
    "agree_com",
    (
        _resource("agreements", AGREEMENTS),
        _resource("contacts", CONTACTS, disposition="append", cursor=Cursor("updated_at")),
        _resource("invoices", INVOICES),
    ),
)
