"""Boards and what hangs off them; numbered pages and an items cursor.

Items are read per board with rows lacking a cursor kept, which is what the feed is
documented to do.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators.dependent import unnest
from pagelake.specs import Cursor, Resource, Source

_BOARD = (
    "id string, name string, description string, state string, board_kind string, "
    "workspace_id string, columns array<struct<id:string,title:string,type:string>>, "
    "groups array<struct<id:string,title:string>>"
)


def _resource(name: str, selector: str, chain: str, **more: object) -> Resource:
    return Resource(
        "monday_crm",
        name,
        selector,
        chain,
        sentinel=True,
        **{"declared": "id string", **more},
    )


def _keep_objects(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").isNotNull())


def _under_board(name: str) -> Resource:
    return _resource(
        name,
        "data.boards",
        "page_of_50",
        declared=_BOARD,
        pages_of="boards",
        transforms=(partial(unnest, column=name, parent_key="id", name="board_id"),),
    )


SOURCE = Source(
    "monday_crm",
    (
        _resource("boards", "data.boards", "page_of_50", declared=_BOARD),
        _resource(
            "items",
            "data.boards[*].items_page.items",
            "items_cursor",
            disposition="merge",
            cursor=Cursor("updated_at", missing="include", floor=None),
            transforms=(_keep_objects,),
        ),
        _resource("users", "data.users", "page_of_100"),
        _resource("teams", "data.teams", "single"),
        _resource("tags", "data.tags", "single"),
        _resource("updates", "data.updates", "page_of_100"),
        _resource("workspaces", "data.workspaces", "page_of_50"),
        _under_board("columns"),
        _under_board("groups"),
    ),
)
