"""Registry of named queries: key -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if oracle is not None:
            _ORACLES[key] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the catalog modules fills the registry.
    from shelfcast.plans import (  # noqa: F401
        catalog_core, catalog_reshape, catalog_windows, catalog_encode, catalog_model)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
