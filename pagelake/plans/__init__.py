"""Resource pipelines, staging views and the registered queries."""

from pagelake.plans import (  # noqa: F401  (importing a module registers its queries)
    chain_queries,
    child_queries,
    cursor_queries,
    document_queries,
    page_queries,
    row_queries,
    run_queries,
    source_queries,
    table_queries,
)
from pagelake.plans.registry import QUERIES

__all__ = ["QUERIES"]
