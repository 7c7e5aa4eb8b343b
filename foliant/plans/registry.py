"""Registered queries with their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function, with the DuckDB SQL of the same rows where there is one."""

    def register(f: Callable) -> Callable:
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


def queries() -> dict[str, Callable]:
    _all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _all()
    return dict(ORACLES)


def _all() -> None:
    """Import the modules that register queries."""
    from foliant.plans import archive, documents, io, links, pieces, scalars  # noqa: F401
