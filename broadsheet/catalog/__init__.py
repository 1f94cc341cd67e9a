"""Registered queries: every operator over the given tables, with the equal DuckDB SQL where SQL can say it."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its oracle."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return register


def load_all() -> None:
    from . import aggregates, dedups, identity, jobs, joins, rules, sources, streams, texts, topks, windows  # noqa: F401
