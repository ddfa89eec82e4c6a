"""All registered queries and their checking SQL, by name."""

from __future__ import annotations

from claimrisk.plans import audit, claims, documents, models, places, serving, sinks, streams

MODULES = [claims, audit, places, serving, documents, models, sinks, streams]


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
