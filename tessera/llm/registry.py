"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from tessera.llm import queries_corpus, queries_native, queries_text

_MODULES = [queries_text, queries_corpus, queries_native]


def queries() -> dict[str, Callable]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
