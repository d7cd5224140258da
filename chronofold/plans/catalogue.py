"""Registration of queries with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add
