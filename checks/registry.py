"""Queries and their SQL, collected by name."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; `sql` is its equivalent over the same parquet tables."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
