"""All queries of the core with their SQL: importing a module registers its queries."""

from testimonia.plans import claims, graph, loading, parsing, sources  # noqa: F401
from testimonia.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
