"""Queries of the engine and the DuckDB SQL that states the same results."""

from .plans import block_queries, delivery_queries, gate_queries, text_queries

_MODULES = (text_queries, block_queries, gate_queries, delivery_queries)
QUERIES: dict = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: s for m in _MODULES for k, s in m.ORACLE_SQL.items()}
