"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from wardlake.registry import check_queries, load_queries, primitive_queries, store_queries, warehouse_queries
from wardlake.registry.oracle_base import with_tables

GROUPS = [warehouse_queries.QUERIES, check_queries.QUERIES, load_queries.QUERIES, store_queries.QUERIES, primitive_queries.QUERIES]


def registered() -> dict:
    return {name: entry for group in GROUPS for name, entry in group.items()}


def queries() -> dict:
    return {name: run for name, (run, _) in registered().items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, (_, sql) in registered().items() if sql}
