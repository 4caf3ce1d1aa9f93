"""Catalogue of registered queries and their DuckDB oracles."""

from __future__ import annotations

from sievework.plans import case_queries, dedup_queries, dimensions, hits, rule_queries

_MODULES = (dedup_queries, rule_queries, case_queries, hits, dimensions)

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _m in _MODULES:
    QUERIES.update(_m.QUERIES)
    ORACLE_SQL.update(_m.ORACLE_SQL)
