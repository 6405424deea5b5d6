"""Registry of the library's queries over the driver tables, each with its DuckDB oracle.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  The oracle is ANSI SQL
over the pre-registered views (``events``, ``nation`` ...) computing the same
result, or ``None`` when the operator is not SQL-expressible (model fits,
iterative estimators, streaming state).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str | None] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from airshed.catalog import (  # noqa: F401
        q_mart, q_quality, q_series, q_stats, q_dashboards, q_sources, q_ml, q_streaming, q_scalars, q_runs, q_stateful,
    )
