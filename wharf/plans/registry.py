"""Registry of named queries: each maps (spark, sf_dir) → DataFrame and,
where the result is expressible in SQL, carries the equivalent DuckDB SQL
over the same parquet tables (the oracle used by the correctness check).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    covers: tuple[str, ...] = ()
    stateful: bool = False          # writes and re-reads state (two-run loads, file round trips)


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, covers: tuple[str, ...] = (), stateful: bool = False):
    """Decorator registering a query function under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql, covers, stateful)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries, then return the registry."""
    from wharf.plans import queries  # noqa: F401  (registers on import)
    return REGISTRY
