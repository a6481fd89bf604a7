"""Declarations of sources and resources: plain data, no execution."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from pagelake.operators.incremental import EPOCH_TEXT

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Cursor:
    """The column that says how new a record is, and how old records are left out.

    ``how``: ``filter`` drops each old row, ``take_while`` ends a newest-first feed at
    its first old row, ``skip_stale`` drops old rows of an unsorted feed.
    """

    path: str
    kind: str = "text"
    range_start: str = "open"
    missing: str = "raise"
    how: str = "filter"
    floor: object = EPOCH_TEXT


@dataclass(frozen=True)
class Parent:
    """The resource whose increment decides which child pages count.

    ``link`` maps entries of the child's request key to parent columns; ``stamped``
    names parent columns to put on each child record. ``full`` takes the parent without
    its cursor, after ``where``; the columns are top-level ones then.
    """

    resource: str
    link: Mapping[str, str]
    stamped: Mapping[str, str] = field(default_factory=dict)
    full: bool = False
    where: Transform | None = None


@dataclass(frozen=True)
class Resource:
    """One table-valued feed of an API."""

    source: str
    name: str
    selector: str
    chain: str
    key: tuple[str, ...] = ("id",)
    disposition: str = "replace"
    cursor: Cursor | None = None
    skip: frozenset[int] = frozenset()
    transforms: tuple[Transform, ...] = ()
    contract: Mapping[str, str] = field(default_factory=dict)
    # Types that must not be left to inference, as a DDL text.
    declared: str = ""
    # Entries of the request key stamped on each record.
    stamp_request: tuple[str, ...] = ()
    parent: Parent | None = None
    # Name of the landed resource the pages come from, if it is another one.
    pages_of: str | None = None
    table: str | None = None
    sentinel: bool = False
    max_nesting: int | None = None
    # Special resources build their rows themselves: build(run, resource) -> DataFrame.
    build: Callable | None = None

    @property
    def table_name(self) -> str:
        return self.table or self.name


@dataclass(frozen=True)
class Source:
    """A named set of resources."""

    name: str
    resources: tuple[Resource, ...]

    def __getitem__(self, name: str) -> Resource:
        for resource in self.resources:
            if resource.name == name:
                return resource
        raise KeyError(f"{self.name} has no resource {name}")

    def names(self) -> list[str]:
        return [r.name for r in self.resources]

    def with_resource(self, resource: Resource) -> Source:
        """The source plus one more (custom) resource."""
        return Source(self.name, (*self.resources, resource))
