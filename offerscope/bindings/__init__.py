"""Queries over the given tables, with comparison SQL."""

from offerscope.bindings import adverts, cleaning, mining, sources, summaries  # noqa: F401
from offerscope.bindings.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
