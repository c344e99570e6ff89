"""Queries of the layout engine and their DuckDB SQL."""

from __future__ import annotations

from . import conversion, documents, lines_and_sections, tables_and_grids

_MODULES = (conversion, lines_and_sections, tables_and_grids, documents)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
