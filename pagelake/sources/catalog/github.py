"""Organisations, members, repositories, pull requests and commits; link-header pages."""

from __future__ import annotations

from pagelake.operators.contract import columns
from pagelake.operators.pages import crawl_targets
from pagelake.specs import Cursor, Parent, Resource, Source

# Organisation columns.
ORGANIZATIONS = columns(
    bigint=["id"], text=["login", "node_id", "name", "description"], timestamp=["created_at"]
)

_PULL = "id bigint, number bigint, updated_at string, base struct<repo:struct<full_name:string>>"
_COMMIT = "sha string, commit struct<committer:struct<date:string>>"
_REPOSITORY = "id bigint, full_name string, updated_at string, pushed_at string, size bigint"

_NEWEST_FIRST = Cursor("updated_at", how="take_while")

# One feed per repository that is worth crawling; the listing is read in full.
_CRAWLED = Parent("repositories", {"repository": "full_name"}, full=True, where=crawl_targets)
_PULL_KEY = {"repository": "base.repo.full_name", "pull_number": "number"}


def _resource(name: str, skip: set[int], **more: object) -> Resource:
    return Resource("github", name, "", "link_header", skip=frozenset(skip), **more)


SOURCE = Source(
    "github",
    (
        _resource("organizations", {403, 404}, contract=ORGANIZATIONS, declared="id bigint"),
        _resource("users", {403}, declared="id bigint", stamp_request=("organization",)),
        _resource(
            "repositories",
            {403, 404},
            disposition="append",
            declared=_REPOSITORY,
            cursor=_NEWEST_FIRST,
        ),
        _resource(
            "pull_requests",
            {404, 409},
            disposition="append",
            declared=_PULL,
            cursor=_NEWEST_FIRST,
            parent=_CRAWLED,
        ),
        _resource(
            "commits",
            {404, 409},
            key=("sha",),
            disposition="append",
            declared=_COMMIT,
            cursor=Cursor("commit.committer.date"),
            parent=Parent(
                "repositories",
                {"repository": "full_name"},
                {"repository": "full_name"},
                full=True,
                where=crawl_targets,
            ),
        ),
        _resource(
            "pull_request_commits",
            {403, 404, 409},
            key=("repository", "pull_number", "sha"),
            disposition="append",
            declared=_COMMIT,
            parent=Parent("pull_requests", _PULL_KEY, _PULL_KEY),
        ),
        _resource(
            "pull_request_stats",
            {403, 404, 409},
            disposition="append",
            declared=_PULL,
            parent=Parent("pull_requests", _PULL_KEY, {"repository": "base.repo.full_name"}),
        ),
    ),
)
