"""Every operator as a query over the test tables, each beside SQL that must agree."""

from feedlake.checks import apply, changes, images, merges, tables  # noqa: F401  (register checks)
from feedlake.checks.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
