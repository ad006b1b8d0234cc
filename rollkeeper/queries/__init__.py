"""Registered queries over the test tables, each with its comparison SQL."""

from __future__ import annotations

from rollkeeper.queries import changing, gating, jobs, lookups, newest, orderly, runs, scalars, whole

MODULES = [scalars, gating, newest, lookups, changing, orderly, jobs, whole, runs]


def all_queries() -> dict:
    return {name: query for m in MODULES for name, (query, _) in m.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
