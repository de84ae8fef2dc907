"""Queries of the engine by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import buildings, graph, heating, labels, more, profile, proofs, references, reports, series, stores, streams

MODULES = (series, heating, labels, profile, graph, more, reports, buildings, stores, streams, proofs, references)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
