"""Operators that every domain reuses: filters, paging, patches, versions, guards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.operators.scaling import skew_join


def as_list(value: Any) -> list | None:
    """A scalar counts as a one-element list; None means "not given"."""
    if value is None:
        return None
    return list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]


def lower_in(col: Column, values: Sequence[str]) -> Column:
    """Case-insensitive membership."""
    return F.lower(col).isin(*[v.lower() for v in values])


def time_literal(df: DataFrame, column: str, value: dt.datetime) -> Column:
    """A time in the column's own type, so that a comparison with it can reach the file scan."""
    return F.lit(value).cast(df.schema[column].dataType)


def list_filtered(
    df: DataFrame,
    eq: Mapping[str, Any] | None = None,
    any_of: Mapping[str, Any] | None = None,
    prefix: Mapping[str, str] | None = None,
    contains: Mapping[str, str] | None = None,
) -> DataFrame:
    """AND of optional filters; a filter that is absent or None constrains nothing."""
    tests: list[Column] = []
    for name, value in (eq or {}).items():
        if value is not None:
            tests.append(F.col(name) == F.lit(value))
    for name, values in (any_of or {}).items():
        members = as_list(values)
        if members is not None:
            tests.append(F.col(name).isin(*members))
    for name, text in (prefix or {}).items():
        if text is not None:
            tests.append(F.lower(F.col(name)).startswith(text.lower()))
    for name, text in (contains or {}).items():
        if text is not None:
            tests.append(F.contains(F.col(name), F.lit(text)))
    return df.filter(reduce(Column.__and__, tests)) if tests else df


# Job states that count as active.
ACTIVE_JOB_STATES = ("RUNNING", "PAUSED")


def active_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.upper("status").isin(*ACTIVE_JOB_STATES))


def ordering(sort_by: str, order: str, tie_breaker: Sequence[str]) -> list[Column]:
    if order.lower() not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    descending = order.lower() == "desc"
    return [F.desc(c) if descending else F.asc(c) for c in (sort_by, *tie_breaker)]


#: Rows that a page may skip by sorting them, keys that are looked at to place a page, and ranges that are counted.
DEEP_OFFSET, SAMPLED_KEYS, RANGES = 10_000, 20_000, 128


def page_range(df: DataFrame, keys: Sequence[str], descending: bool, offset: int, limit: int) -> tuple[DataFrame, int]:
    """A range of rows that holds a page, and how many rows come before the range.

    A bounded sample of keys cuts the order into ranges, whose rows are counted
    exactly in one pass without a shuffle of rows. The range of the page is cut again
    while it is much larger than the page and gets smaller. Rows of equal keys stay
    together.
    """
    row = F.struct(*keys)
    left, before = df, 0
    n = df.count()
    while n > 2 * (DEEP_OFFSET + limit):
        sample = left.select(*keys).sample(fraction=min(1.0, SAMPLED_KEYS / n), seed=1).distinct()
        ranked = sample.orderBy(*[F.desc(k) if descending else F.asc(k) for k in keys]).limit(2 * SAMPLED_KEYS).collect()
        cuts = [ranked[i] for i in sorted({len(ranked) * k // RANGES for k in range(1, RANGES)}) if i < len(ranked)]
        kinds = [left.schema[k].dataType for k in keys]
        bounds = [F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, cut, kinds)]) for cut in cuts]
        behind = (lambda b: row <= b) if descending else (lambda b: row >= b)

        def place_among(lo: int, hi: int) -> Column:
            """How many of the bounds a row lies behind, found by halving."""
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(behind(bounds[mid]), place_among(mid + 1, hi)).otherwise(place_among(lo, mid))  # noqa: B023

        place = place_among(0, len(bounds))
        sizes = dict(left.groupBy(place.alias("place")).count().collect())
        first, seen = 0, 0
        while first < len(bounds) and seen + sizes.get(first, 0) <= offset - before:
            seen += sizes.get(first, 0)
            first += 1
        last, upto = first, seen + sizes.get(first, 0)
        while last < len(bounds) and upto < offset - before + limit:
            last += 1
            upto += sizes.get(last, 0)
        if upto - seen >= n:  # all rows are alike in what was looked at
            break
        inside = F.lit(True)
        if first > 0:
            inside = inside & behind(bounds[first - 1])
        if last < len(bounds):
            inside = inside & ~behind(bounds[last])
        left, before, n = left.where(inside), before + seen, upto - seen
    return left, before


def sort_limit_offset(df: DataFrame, tie_breaker: Sequence[str], sort_by: str = "event_time",
                      order: str = "desc", limit: int | None = None, offset: int = 0) -> DataFrame:
    """An ordered slice. The tie-breaker makes pages repeatable.

    A page behind ``DEEP_OFFSET`` rows is cut out of the range of the order in which it
    lies (``page_range``); the rows before it are counted, not sorted.
    """
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("limit and offset may not be negative")
    if limit is not None and offset > DEEP_OFFSET:
        df, before = page_range(df, [sort_by, *tie_breaker], order.lower() == "desc", offset, limit)
        offset -= before
    out = df.orderBy(*ordering(sort_by, order, tie_breaker))
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def after_cursor(keys: Sequence[str], cursor: Sequence[Any], order: str = "asc") -> Column:
    """Rows strictly behind a cursor in the order of the keys.

    The leading comparison on the first key alone can reach the file scan.
    """
    ascending = order.lower() == "asc"

    def beyond(name: str, value: Any) -> Column:
        return F.col(name) > F.lit(value) if ascending else F.col(name) < F.lit(value)

    steps = []
    for i, (name, value) in enumerate(zip(keys, cursor, strict=True)):
        same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], cursor[:i])]
        steps.append(reduce(Column.__and__, [*same, beyond(name, value)]))
    first = F.col(keys[0]) >= F.lit(cursor[0]) if ascending else F.col(keys[0]) <= F.lit(cursor[0])
    return first & reduce(Column.__or__, steps)


def keyset_rows(df: DataFrame, keys: Sequence[str], after: Sequence[Any] | None, limit: int,
                order: str = "asc") -> DataFrame:
    """The page behind a cursor; unlike an offset it does not read skipped rows."""
    rows = df if after is None else df.filter(after_cursor(keys, after, order))
    return rows.orderBy(*[F.asc(k) if order.lower() == "asc" else F.desc(k) for k in keys]).limit(limit)


def keyset_page(df: DataFrame, keys: Sequence[str], after: Sequence[Any] | None, limit: int,
                order: str = "asc") -> tuple[DataFrame, tuple | None]:
    """A page and the cursor of the next one (None at the end).

    The driver sees the key columns of one page plus one row, nothing more.
    """
    seen = keyset_rows(df.select(*keys), keys, after, limit + 1, order).collect()
    page = keyset_rows(df, keys, after, limit, order)
    cursor = tuple(seen[limit - 1]) if limit and len(seen) > limit else None
    return page, cursor


def merge_pages(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from a page is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# The policy types that one listing merges.
POLICY_TYPES = ("TAG", "COLUMN", "PUSHDOWN", "IMPERSONATION", "GRANT", "ROW", "OLTP")


def merge_policy_types(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Policies of several types in one list with their type."""
    return merge_pages([df.withColumn("policy_type", F.lit(kind)) for kind, df in frames.items()])


def patch_rows(base: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial update: a NULL or absent patch field keeps the old value.

    Several patches of a key count as one: per field the greatest value that is not
    NULL; reduce them with ``latest_version`` first if the latest shall win. Patches whose key has no base row are ignored.
    """
    fields = [c for c in patch.columns if c not in keys]
    if not fields:
        raise ValueError("a patch needs at least one field to change")
    unknown = set(fields) - set(base.columns)
    if unknown:
        raise ValueError(f"patch fields {sorted(unknown)} are not in the base table")
    renamed = patch.groupBy(*keys).agg(*[F.max(c).alias(f"_new_{c}") for c in fields])
    joined = base.join(renamed, list(keys), "left")
    return joined.select(*[
        F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns
    ])


def latest_version(df: DataFrame, keys: Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """The last version per key as an aggregate, which combines before the shuffle."""
    versions = as_list(version)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*versions)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def apply_tombstones(df: DataFrame, deletes: DataFrame, keys: Sequence[str], skewed: bool = False) -> DataFrame:
    """Hard removal by key; ``skewed`` spreads keys that hold very many rows."""
    gone = deletes.select(*keys).distinct()
    if skewed:
        return skew_join(df, gone, keys, "left_anti")
    return df.join(gone, list(keys), "left_anti")


def archive_state(events: DataFrame, keys: Sequence[str], ts: Sequence[str],
                  action: str = "action") -> DataFrame:
    """Whether the last archive or restore event of a key was an archive."""
    return events.groupBy(*keys).agg(
        (F.max_by(F.lower(action), F.struct(*ts)) == "archive").alias("archived")
    )


def soft_delete(df: DataFrame, events: DataFrame, keys: Sequence[str], ts: Sequence[str],
                archived: bool = False) -> DataFrame:
    """Active rows, or archived rows only. A key without events is active."""
    gone = archive_state(events, keys, ts).filter("archived").select(*keys)
    return df.join(gone, list(keys), "left_semi" if archived else "left_anti")


def reference_counts(parent: DataFrame, child: DataFrame, key: str, child_key: str | None = None,
                     name: str = "child_count") -> DataFrame:
    """Children per parent, zero when there are none."""
    counts = (
        child.filter(F.col(child_key or key).isNotNull())
        .groupBy(F.col(child_key or key).alias(key)).agg(F.count(F.lit(1)).alias(name))
    )
    joined = parent.join(counts, key, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0)))


def guarded_delete(df: DataFrame, requested: DataFrame, blockers: DataFrame,
                   keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Remaining rows, and requested rows that were refused because of dependents."""
    keys = list(keys)
    asked = requested.select(*keys).distinct()
    held = blockers.select(*keys).distinct()
    droppable = asked.join(held, keys, "left_anti")
    refused = df.join(asked.join(held, keys, "left_semi"), keys, "left_semi")
    return df.join(droppable, keys, "left_anti"), refused


def applied_state(df: DataFrame, pending: str, success: str, failed: str) -> DataFrame:
    """One status from three optional settings, and the setting in force.

    A pending change is reported first, then a failed one; the applied setting
    stays in force until a new one succeeds.
    """
    status = (
        F.when(F.col(pending).isNotNull(), F.lit("PENDING"))
        .when(F.col(failed).isNotNull(), F.lit("FAILED"))
        .when(F.col(success).isNotNull(), F.lit("SUCCESS"))
        .otherwise(F.lit("NONE"))
    )
    return df.withColumn("status", status).withColumn("effective", F.col(success))


def lookup_by_name(registry: DataFrame, wanted: DataFrame, name: str, fields: Sequence[str]) -> DataFrame:
    """Friendly name to its fields; an unknown name gives a row with ``found`` false."""
    known = registry.select(name, *fields, F.lit(True).alias("_hit"))
    return (
        wanted.select(name).join(known, name, "left")
        .withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")
    )
