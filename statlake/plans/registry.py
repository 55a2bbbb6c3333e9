"""Query registry: name → (spark callable, optional DuckDB SQL)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
