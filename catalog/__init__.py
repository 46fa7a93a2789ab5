"""Registered queries: every operator over the given tables, with its SQL twin."""

from catalog import analysis, facets, features, filters, keywords, maintenance, stores  # noqa: F401
from catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
