"""The registry of queries: every module of this package adds its own."""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with the DuckDB SQL of the same result."""

    def add(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if oracle:
            _ORACLES[name] = oracle
        return fn

    return add


def _load() -> None:
    from tessera.plans import catalogue  # noqa: F401  registers on import


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
