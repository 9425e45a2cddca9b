"""Query name to (DataFrame function, SQL form or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = (fn, sql)
        return fn

    return register


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    """Import every query module and return what they registered."""
    from corpusloom.plans import chat, generation, metrics, rows, sequences, splits, tokens, vectors  # noqa: F401

    return QUERIES
