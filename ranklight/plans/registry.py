"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Its oracle is SQL over the
driver tables (registered as views) that must return the same rows and
column names.  Queries that are learned or random register no oracle and
are checked by invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def load_all() -> None:
    """Import every section so its queries register."""
    from ranklight.plans import (catalog_q, clean_q, collab_q, content_q, embed_q,  # noqa: F401
                                 features_q, hybrid_q, metrics_q, profile_q, sources_q)
