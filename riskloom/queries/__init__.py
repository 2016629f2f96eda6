"""Registered queries, one module per family."""

from riskloom.queries import aggregates, columns, decisions, events, joins, models, stores  # noqa: F401
from riskloom.queries.base import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
