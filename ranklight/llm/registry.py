"""Queries of the training-data operators, one ``opN_<name>`` per operator."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every operator module, and the pipeline, so the queries register."""
    import corpus_pipeline
    from ranklight.llm import (covertree, decontam, divergence, langid, licences, lines, neardup, packing,  # noqa: F401
                               pagediff, runs, secrets_ledger, spans, tokencount)

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
