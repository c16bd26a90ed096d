"""Registered queries, and the market tables they derive from the given ones."""

from __future__ import annotations

from gridclear.plans import file_queries, history_queries, market_queries, table_queries, view_queries  # noqa: F401
from gridclear.plans.registry import ORACLE, QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def comparison_sql() -> dict[str, str]:
    return dict(ORACLE)
