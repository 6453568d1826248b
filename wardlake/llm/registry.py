"""The queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from wardlake.plans.registry import Query, QueryFn

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query under a name that is used once."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, fn, sql)
        return fn

    return add
