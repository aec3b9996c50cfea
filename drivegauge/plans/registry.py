"""All queries over the library's own operators, by name."""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def register(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return register


def _load() -> None:
    from . import depth_queries, evaluation_queries, object_queries, report_queries, semantics_queries, source_queries, stream_queries, time_queries  # noqa: F401


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
