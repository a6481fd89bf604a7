"""CRM objects with listed properties, engagements and deal pipelines."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators.contract import columns
from pagelake.operators.nested import ASSOCIATIONS, flatten_engagement, project_properties
from pagelake.operators.pages import server_filter
from pagelake.specs import Cursor, Resource, Source

# Properties read of each object.
PROPERTIES = {
    "companies": (
        "name",
        "domain",
        "website",
        "phone",
        "industry",
        "city",
        "state",
        "country",
        "lifecyclestage",
        "annualrevenue",
        "numberofemployees",
        "num_associated_contacts",
        "num_associated_deals",
        "hubspot_owner_id",
        "createdate",
        "hs_lastmodifieddate",
    ),
    "contacts": (
        "email",
        "firstname",
        "lastname",
        "phone",
        "company",
        "jobtitle",
        "city",
        "state",
        "country",
        "lifecyclestage",
        "associatedcompanyid",
        "hubspot_owner_id",
        "createdate",
        "hs_lastmodifieddate",
    ),
    "deals": (
        "dealname",
        "dealstage",
        "dealtype",
        "pipeline",
        "amount",
        "amount_in_home_currency",
        "deal_currency_code",
        "hubspot_owner_id",
        "closed_lost_reason",
        "closed_won_reason",
        "days_to_close",
        "closedate",
        "createdate",
        "hs_lastmodifieddate",
    ),
}


def _crm(name: str) -> Resource:
    listed = PROPERTIES[name]
    struct = ",".join(f"{p}:string" for p in listed)
    return Resource(
        "hubspot",
        name,
        "results",
        "after",
        disposition="append",
        cursor=Cursor("updatedAt"),
        contract=columns(text=[f"properties__{p}" for p in listed]),
        declared=f"id string, archived boolean, properties struct<{struct}>",
        transforms=(
            partial(server_filter, archived=False),
            partial(project_properties, names=listed),
        ),
    )


def _stages_text(df: DataFrame) -> DataFrame:
    return df.withColumn("stages", F.coalesce("stages", F.lit("[]")))


SOURCE = Source(
    "hubspot",
    (
        *[_crm(name) for name in PROPERTIES],
        Resource(
            "hubspot",
            "engagements",
            "results",
            "offset",
            disposition="append",
            cursor=Cursor("lastUpdated", kind="bigint", floor=0),
            contract=columns(text=["body_preview", *ASSOCIATIONS.values()]),
            declared=(
                "engagement struct<id:bigint,lastUpdated:bigint,bodyPreview:string>, associations "
                "struct<contactIds:array<bigint>,companyIds:array<bigint>,dealIds:array<bigint>>"
            ),
            transforms=(flatten_engagement,),
        ),
        Resource(
            "hubspot",
            "deal_pipelines",
            "results",
            "single",
            contract=columns(text=["stages"]),
            declared="id string, stages string",
            transforms=(_stages_text,),
        ),
    ),
)
