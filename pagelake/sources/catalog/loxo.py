"""Recruiting feeds: scrolled lists, numbered job pages, one page of users."""

from __future__ import annotations

from pagelake.specs import Resource, Source


def _resource(name: str, selector: str, chain: str = "scroll") -> Resource:
    return Resource("loxo", name, selector, chain, declared="id string")


SOURCE = Source(
    "loxo",
    (
        _resource("people", "people"),
        _resource("jobs", "jobs", "page_until_empty"),
        _resource("companies", "companies"),
        _resource("deals", "deals"),
        _resource("activities", "person_events"),
        _resource("users", "users", "single"),
    ),
)
