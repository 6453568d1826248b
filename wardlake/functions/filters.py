"""Report filter groups compiled to one predicate."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, functions as F

# Fields that a report may filter on, by data source.
FIELDS = {
    "oltp": (
        "database_name", "table_name", "schema_name", "column_name", "statement_type",
        "consuming_user", "event_source", "event_name", "repo_user", "repo_host",
        "repo_name", "repo_type", "application_name", "client_host", "connection_id",
        "statement_text", "policy_blocked", "execution_success", "row_count",
    ),
    "snowflake": (
        "username", "current_role", "ip_address", "client", "query_type", "warehouse",
        "warehouse_size",
    ),
}


def _one_pattern(field: str, pattern: dict) -> Column:
    text, value = F.col(field).cast("string"), pattern["value"]
    kind = pattern["match_type"]
    if kind == "exact":
        return text == F.lit(str(value))
    if kind == "prefix":
        return text.startswith(str(value))
    if kind == "suffix":
        return text.endswith(str(value))
    if kind == "contains":
        return text.contains(str(value))
    raise ValueError(f"unknown match_type {kind!r}")


def _one_filter(spec: dict, allowed: tuple[str, ...]) -> Column:
    field = spec["field"]
    if field not in allowed:
        raise ValueError(f"field {field!r} is not one of {', '.join(allowed)}")
    if not spec.get("patterns"):
        raise ValueError(f"filter on {field!r} has no patterns")
    hit = reduce(Column.__or__, (_one_pattern(field, p) for p in spec["patterns"]))
    if spec["mode"] == "include":
        return F.coalesce(hit, F.lit(False))
    if spec["mode"] == "exclude":
        return ~F.coalesce(hit, F.lit(False))
    raise ValueError(f"unknown mode {spec['mode']!r}")


def compile_filters(filters: str | dict | None, integration_type: str) -> Column:
    """Patterns OR inside a filter, filters AND inside a group, groups OR.

    A NULL field matches no pattern: ``include`` drops it, ``exclude`` keeps it.
    """
    if integration_type not in FIELDS:
        raise ValueError(f"integration_type is one of {', '.join(FIELDS)}")
    spec = json.loads(filters) if isinstance(filters, str) else (filters or {})
    groups = [g["filters"] for g in spec.get("filter_groups", []) if g.get("filters")]
    if not groups:
        return F.lit(True)
    allowed = FIELDS[integration_type]
    return reduce(
        Column.__or__,
        (reduce(Column.__and__, (_one_filter(f, allowed) for f in g)) for g in groups),
    )
