"""Registered queries by name, and their oracles."""

from . import batch, linking, phrases, policies, reporting, stores, texts

_MODULES = (reporting, texts, phrases, linking, policies, stores, batch)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
