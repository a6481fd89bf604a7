"""Accounting entities by query; pages of 1000 by start position."""

from __future__ import annotations

from functools import partial

from pagelake.operators.contract import columns
from pagelake.operators.nested import iso_column
from pagelake.specs import Cursor, Resource, Source

# Entities with an update cursor and their tables, and those read whole.
UPDATED = {
    "Customer": "customers",
    "Invoice": "invoices",
    "Payment": "payments",
    "Item": "items",
    "Account": "accounts",
    "Vendor": "vendors",
    "Bill": "bills",
    "BillPayment": "bill_payments",
    "JournalEntry": "journal_entries",
    "CreditMemo": "credit_memos",
    "RefundReceipt": "refund_receipts",
    "Estimate": "estimates",
    "PurchaseOrder": "purchase_orders",
    "Purchase": "purchases",
    "Deposit": "deposits",
    "Transfer": "transfers",
    "TimeActivity": "time_activities",
    "Employee": "employees",
}
WHOLE = {
    "TaxAgency": "tax_agencies",
    "TaxRate": "tax_rates",
    "Class": "classes",
    "Department": "departments",
    "CompanyInfo": "company_info",
    "Preferences": "preferences",
}

# Column contracts.
_PARTY = (
    "display_name",
    "given_name",
    "family_name",
    "company_name",
    "primary_email_addr__address",
    "primary_phone__free_form_number",
    "bill_addr__line1",
    "bill_addr__city",
    "bill_addr__country_sub_division_code",
    "bill_addr__postal_code",
    "currency_ref__value",
)
CONTRACTS = {
    "customers": columns(text=_PARTY),
    "invoices": columns(
        text=[
            "doc_number",
            "customer_ref__value",
            "customer_ref__name",
            "currency_ref__value",
            "email_status",
            "print_status",
            "private_note",
            "customer_memo__value",
        ]
    ),
    "payments": columns(
        text=[
            "customer_ref__value",
            "customer_ref__name",
            "payment_ref_num",
            "currency_ref__value",
            "private_note",
        ]
    ),
    "items": columns(
        text=[
            "name",
            "description",
            "type",
            "income_account_ref__value",
            "income_account_ref__name",
            "expense_account_ref__value",
            "expense_account_ref__name",
            "asset_account_ref__value",
            "sku",
        ],
        decimal=["unit_price", "qty_on_hand"],
        bool=["track_qty_on_hand", "taxable", "active"],
        timestamp=["meta_data__create_time", "meta_data__last_updated_time"],
    ),
    "accounts": columns(
        text=[
            "name",
            "fully_qualified_name",
            "account_type",
            "account_sub_type",
            "classification",
            "currency_ref__value",
        ]
    ),
    "vendors": columns(text=_PARTY),
    "bills": columns(
        text=[
            "doc_number",
            "vendor_ref__value",
            "vendor_ref__name",
            "currency_ref__value",
            "private_note",
        ]
    ),
    "journal_entries": columns(text=["doc_number", "currency_ref__value", "private_note"]),
}

_META = "MetaData struct<CreateTime:string,LastUpdatedTime:string>"


def _resource(entity: str, name: str, **more: object) -> Resource:
    return Resource(
        "quickbooks",
        name,
        f"QueryResponse.{entity}",
        "start_position",
        key=("Id",),
        contract=CONTRACTS.get(name, {}),
        declared=f"Id string, {_META}",
        **more,
    )


SOURCE = Source(
    "quickbooks",
    (
        *[
            _resource(
                entity,
                name,
                disposition="merge",
                cursor=Cursor(
                    "MetaData.LastUpdatedTime", kind="timestamp", floor="1970-01-01T00:00:00Z"
                ),
                transforms=(partial(iso_column, path="MetaData.LastUpdatedTime"),),
            )
            for entity, name in UPDATED.items()
        ],
        *[_resource(entity, name) for entity, name in WHOLE.items()],
    ),
)
