"""Queries over the driver's tables, each applying one operator to a whole table."""

from __future__ import annotations

from fathom.queries import audits, catalog, evidence, layout, metrics, model, native, sequences, spatial, text

_MODULES = (metrics, text, catalog, sequences, spatial, evidence, layout, model, audits, native)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in _MODULES for k, v in m.ORACLE_SQL.items()}
