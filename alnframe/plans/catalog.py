"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
operator is expressible in SQL, an independent DuckDB oracle over the driver's views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def _load() -> None:
    # Importing the modules fills the registry.
    from . import q_core, q_functions, q_io, q_joins, q_aggs, q_pipeline, q_rules, q_order, q_sweeps, q_store, q_headers, q_sql  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
