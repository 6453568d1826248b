"""Search, exploration and summary of audit rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.operators.common import as_list, keyset_rows, lower_in, ordering, sort_limit_offset, time_literal

PAGE, KEEP_DAYS = 250, 30
SORTS = ("event_time", "rows_accessed")

# Categories of system audits.
CATEGORIES = (
    "API Keys", "Locks", "Data", "Administrators", "Thresholds", "Anomalies", "Applications",
    "User Groups", "Data Sources", "Row Access Policy", "Unified Access Policy", "Access Requests",
    "Access Management Policy", "Impersonation Policy",
)


def _check_slice(limit: int | None, sort_by: str) -> None:
    if limit is not None and limit < 1:
        raise ValueError("limit is at least 1, or None for all rows")
    if sort_by not in SORTS:
        raise ValueError(f"sort_by is one of {', '.join(SORTS)}")


def _time_range(df: DataFrame, ts: str, start: dt.datetime | None, end: dt.datetime | None) -> list[Column]:
    tests = []
    if start is not None:
        tests.append(F.col(ts) >= time_literal(df, ts, start))
    if end is not None:
        tests.append(F.col(ts) <= time_literal(df, ts, end))
    return tests


def _touches(part: str, names: Sequence[str]) -> Column:
    """Some scanned or projected column has one of the names at this part of its path."""
    request = F.col("statement_request")
    return reduce(Column.__or__, (
        F.coalesce(F.exists(request[side], lambda c: c[part].isin(*names)), F.lit(False))
        for side in ("scanned_columns", "projected_columns")
    ))


def search_audits(
    events: DataFrame, *, from_date_time: dt.datetime | None = None, to_date_time: dt.datetime | None = None,
    consuming_user: str | list[str] | None = None, consuming_user_email: str | list[str] | None = None,
    query_id: str | list[str] | None = None, sidecar_id: str | list[str] | None = None,
    sidecar_instance_id: str | list[str] | None = None, table_name: str | list[str] | None = None,
    schema_name: str | list[str] | None = None, database_name: str | list[str] | None = None,
    column_name: str | list[str] | None = None, statement_type: str | list[str] | None = None,
    statement_text_contains: str | None = None, limit: int | None = None, offset: int = 0,
    order_by: str = "desc", sort_by: str = "event_time",
) -> DataFrame:
    """Sidecar audits (nested events) that satisfy all given filters, sorted; all of them unless ``limit`` is given."""
    _check_slice(limit, sort_by)
    user, request = F.col("user_identity.consuming_user"), F.col("statement_request")
    tests = _time_range(events, "event_time", from_date_time, to_date_time)
    if consuming_user is not None:
        tests.append(lower_in(user["username"], as_list(consuming_user)))
    plain = {
        "event_id": query_id, "sidecar.id": sidecar_id, "sidecar.instance_id": sidecar_instance_id,
        "user_identity.consuming_user.email": consuming_user_email,
        "statement_request.statement_type": statement_type,
    }
    tests += [F.col(c).isin(*as_list(v)) for c, v in plain.items() if v is not None]
    paths = {"database": database_name, "schema": schema_name, "table": table_name, "column": column_name}
    tests += [_touches(part, as_list(v)) for part, v in paths.items() if v is not None]
    if statement_text_contains is not None:
        tests.append(F.contains(F.lower(request["statement"]), F.lit(statement_text_contains.lower())))
    rows = reduce(lambda df, t: df.filter(t), tests, events)
    rows = rows.withColumn("rows_accessed", request["response"]["records"])
    return sort_limit_offset(rows, ["event_id"], sort_by, order_by, limit, offset)


def search_query_audits(
    audits: DataFrame, *, now: dt.datetime | None = None, from_date_time: dt.datetime | None = None,
    to_date_time: dt.datetime | None = None, limit: int | None = None, offset: int = 0,
    order_by: str = "desc", sort_by: str = "event_time", **filters: str | None,
) -> DataFrame:
    """Masking audits, sorted; all of them unless ``limit`` is given. Every filter is one value, compared without regard to case."""
    _check_slice(limit, sort_by)
    # Filter names of the query audit search.
    known = (
        "executing_role", "executing_user", "query_id", "policy_tag_name", "policy_tag_value",
        "policy_column_database_name", "policy_column_schema_name", "policy_column_table_name",
        "policy_column_name",
    )
    unknown = set(filters) - set(known)
    if unknown:
        raise ValueError(f"unknown filters {sorted(unknown)}")
    clock = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if to_date_time is not None and to_date_time > clock:
        raise ValueError("to_date_time must not be in the future")
    tests = _time_range(audits, "event_time", from_date_time, to_date_time)
    tests += [F.lower(F.col(c)) == v.lower() for c, v in filters.items() if v is not None]
    rows = reduce(lambda df, t: df.filter(t), tests, audits)
    return sort_limit_offset(rows, ["query_id"], sort_by, order_by, limit, offset)


def search_system_audits(audits: DataFrame, category: str, limit: int | None = None, offset: int = 0,
                         from_date_time: dt.datetime | None = None, to_date_time: dt.datetime | None = None) -> DataFrame:
    """System audits of one category, newest first; all of them unless a time range or ``limit`` is given."""
    if category not in CATEGORIES:
        raise ValueError(f"category is one of {', '.join(CATEGORIES)}")
    _check_slice(limit, "event_time")
    rows = audits.filter(F.col("category") == category)
    rows = reduce(lambda df, t: df.filter(t), _time_range(audits, "event_time", from_date_time, to_date_time), rows)
    return sort_limit_offset(rows, ["event_id"], "event_time", "desc", limit, offset)


def save_search(df: DataFrame, search_id: str, root: str, run_date: dt.date, sort_by: str = "event_time",
                order: str = "desc", tie_breaker: Sequence[str] = ("event_id",)) -> None:
    """Keep a result in its order below (run date, search id); a search id that was kept that day is replaced.

    Rows are range-partitioned, sorted and numbered without a one-task window.
    """
    from wardlake.operators.scaling import number_rows

    numbered = number_rows(df, ordering(sort_by, order, tie_breaker), "row_no")
    numbered.withColumns({"run_date": F.lit(run_date), "search_id": F.lit(search_id)}).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "search_id").parquet(root)


def read_search(spark: SparkSession, root: str, search_id: str, today: dt.date, limit: int = PAGE,
                token: int | None = None) -> DataFrame:
    """One page of a kept result; results older than 30 days are not found.

    The token is the number of the last row seen.
    """
    if limit < 1:
        raise ValueError("limit is at least 1")
    kept = spark.read.parquet(root).filter(
        (F.col("search_id") == search_id) & (F.col("run_date") >= F.lit(today - dt.timedelta(days=KEEP_DAYS)))
    )
    return keyset_rows(kept, ["row_no"], None if token is None else [token], limit)


def explode_audit_columns(events: DataFrame) -> DataFrame:
    """One row per event and touched column, with how it was touched; one scan."""
    request = F.col("statement_request")

    def side(name: str, usage: str) -> Column:
        columns = F.coalesce(request[name], F.array())
        return F.transform(columns, lambda c: F.struct(
            F.lit(usage).alias("usage"), c["database"].alias("database_name"),
            c["schema"].alias("schema_name"), c["table"].alias("table_name"),
            c["column"].alias("column_name")))

    touched = F.concat(side("scanned_columns", "scanned"), side("projected_columns", "projected"))
    return events.select(
        "event_id", "event_time",
        F.col("user_identity.consuming_user.username").alias("consuming_user"),
        F.explode_outer(touched).alias("t"),
    ).select("event_id", "event_time", "consuming_user", "t.*")


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("statements"),
        F.sum("row_count").alias("rows_accessed"),
        F.sum("bytes").alias("bytes"),
        F.count_if(~F.col("execution_success")).alias("failures"),
        F.count_if("policy_blocked").alias("blocks"),
    ]


def audit_summary(audits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts, rows, bytes, failures and blocks per group."""
    return audits.groupBy(*by).agg(*_measures())


def audit_summary_sets(audits: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same for every column of ``by`` alone and for all rows, in one scan.

    Rows are first grouped by all columns together, so the expansion into grouping
    sets works on groups, not on raw rows.
    """
    fine = audits.groupBy(*by).agg(*_measures())
    total = {m: F.sum(m).alias(m) for m in ("statements", "rows_accessed", "bytes", "failures", "blocks")}
    sets = [[F.col(c)] for c in by] + [[]]
    return fine.groupingSets(sets, *[F.col(c) for c in by]).agg(
        F.grouping_id().alias("gid"), *total.values())


def policy_block_rate(audits: DataFrame, by: str) -> DataFrame:
    """Share of blocked and of failed statements per group."""
    n = F.count(F.lit(1))
    return audits.groupBy(by).agg(
        n.alias("statements"), F.count_if("policy_blocked").alias("blocked"),
        F.count_if(~F.col("execution_success")).alias("failed"),
    ).withColumns({
        "block_rate": F.col("blocked") / F.col("statements"),
        "failure_rate": F.col("failed") / F.col("statements"),
    })
