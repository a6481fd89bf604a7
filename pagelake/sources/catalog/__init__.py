"""The catalogue: twelve sources, one module each."""

from __future__ import annotations

from pagelake.sources.catalog import (
    agree_com,
    apollo_io,
    attio,
    github,
    hubspot,
    loxo,
    m365_graph,
    monday_crm,
    notion,
    pipedrive,
    quickbooks,
    stripe,
)
from pagelake.specs import Resource, Source

SOURCES: dict[str, Source] = {
    module.SOURCE.name: module.SOURCE
    for module in (
        agree_com,
        apollo_io,
        attio,
        github,
        hubspot,
        loxo,
        m365_graph,
        monday_crm,
        notion,
        pipedrive,
        quickbooks,
        stripe,
    )
}


def resources() -> list[Resource]:
    """Every resource of every source."""
    return [r for s in SOURCES.values() for r in s.resources]
