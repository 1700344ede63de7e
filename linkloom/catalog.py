"""All registered queries and their DuckDB counterparts."""

from __future__ import annotations

from .plans import queries_matching, queries_text

MODULES = [queries_text, queries_matching]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
