"""The table of registered queries and oracles, filled by the plan modules."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` (with its
    DuckDB oracle when the query has one)."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
