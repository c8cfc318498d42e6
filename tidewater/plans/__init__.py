"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their
DuckDB oracles (absent for queries that only have a rows check)."""

from __future__ import annotations

import importlib

from tidewater.plans.registry import ORACLES, QUERIES

_MODULES = ("log_queries", "text_queries", "scalar_queries", "session_queries", "learning_queries",
            "stream_queries")


def _load():
    for m in _MODULES:
        importlib.import_module(f"tidewater.plans.{m}")
    return QUERIES, ORACLES


def all_queries():
    return _load()[0]


def all_oracles():
    return _load()[1]
