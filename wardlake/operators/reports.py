"""Audit reports: windows, schedules, trigger throttling, review coverage."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from dataclasses import dataclass
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from wardlake.functions.cron import parse_cron
from wardlake.functions.filters import compile_filters
from wardlake.operators.audits import audit_summary
from wardlake.operators.common import time_literal
from wardlake.operators.scaling import fan_out_join
from wardlake.session import write_through

THROTTLE_SECONDS = 300


@dataclass(frozen=True)
class ReportDefinition:
    """What a report covers and when it runs."""

    id: str
    integration_type: str = "oltp"
    lookback_days: int = 1
    timezone: str = "UTC"
    filters: str | dict | None = None
    cron: str | None = None
    schedule_enabled: bool = True
    schedule_timezone: str = "UTC"
    ts: str = "event_time"

    def filter_text(self) -> str | None:
        return self.filters if self.filters is None or isinstance(self.filters, str) else json.dumps(self.filters)


def report_window(trigger_ts: Column, lookback_days: Column, zone: str | Column) -> tuple[Column, Column]:
    """[start, end) of the complete local days before the trigger day, as UTC instants.

    Days are counted on the local calendar, so a day may have 23 or 25 hours.
    """
    zone_column = F.lit(zone) if isinstance(zone, str) else zone
    today = F.date_trunc("day", F.from_utc_timestamp(trigger_ts, zone_column))
    first = F.date_sub(today.cast("date"), lookback_days.cast("int")).cast("timestamp")
    return F.to_utc_timestamp(first, zone_column), F.to_utc_timestamp(today, zone_column)


def window_bounds(trigger_ts: dt.datetime, lookback_days: int, zone: str) -> tuple[dt.datetime, dt.datetime]:
    """The same window as literals, so that it reaches the file scan."""
    local = trigger_ts.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).date()

    def midnight(day: dt.date) -> dt.datetime:
        start = dt.datetime.combine(day, dt.time(), tzinfo=ZoneInfo(zone))
        return start.astimezone(dt.timezone.utc).replace(tzinfo=None)

    return midnight(local - dt.timedelta(days=lookback_days)), midnight(local)


def build_report(audits: DataFrame, definition: ReportDefinition, trigger_ts: dt.datetime,
                 summary_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Detail rows of a report and their summary."""
    start, end = window_bounds(trigger_ts, definition.lookback_days, definition.timezone)
    ts = F.col(definition.ts)
    inside = (ts >= time_literal(audits, definition.ts, start)) & (ts < time_literal(audits, definition.ts, end))
    detail = audits.filter(inside).filter(compile_filters(definition.filters, definition.integration_type))
    return detail, audit_summary(detail, summary_by or ["consuming_user"])


_FIELDS = T.StructType([
    T.StructField(n, T.ArrayType(T.IntegerType()))
    for n in ("minute", "hour", "day", "month", "weekday", "year")
])


@F.pandas_udf(_FIELDS)
def _cron_fields(expressions: pd.Series) -> pd.DataFrame:
    """Allowed values per field of each expression; NULL means every value."""
    parsed = [parse_cron(e) for e in expressions]
    return pd.DataFrame({n: [None if getattr(p, n) is None else list(getattr(p, n)) for p in parsed]
                         for n in _FIELDS.names})


def _allowed(field: str, part: Column) -> Column:
    return F.col(f"f.{field}").isNull() | F.array_contains(F.col(f"f.{field}"), part)


def _choices(field: str, most: int) -> Column:
    every = F.sequence(F.lit(0), F.lit(most))
    return F.explode(F.coalesce(F.col(f"f.{field}"), every))


def expand_cron(definitions: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Due runs of scheduled definitions (id, cron, enabled, timezone) in [start, end).

    Each different (cron, zone) pair is expanded once, along its own days, hours
    and minutes, so the work follows the number of runs, not the number of minutes.
    Local times are converted to UTC afterwards: a time that the clock skips gives
    no run, a time that it repeats gives two.
    """
    live = definitions.filter("enabled").select("id", "cron", "timezone")
    pairs = live.select("cron", "timezone").distinct().withColumn("f", _cron_fields("cron"))
    day_range = F.sequence(
        F.date_sub(F.lit(start).cast("date"), 1), F.date_add(F.lit(end).cast("date"), 1))
    days = pairs.select("*", F.explode(day_range).alias("d")).filter(
        _allowed("day", F.dayofmonth("d")) & _allowed("month", F.month("d"))
        & _allowed("weekday", F.dayofweek("d")) & _allowed("year", F.year("d")))
    local = (
        days.select("*", _choices("hour", 23).alias("h"))
        .select("cron", "timezone", "d", "h", _choices("minute", 59).alias("m"))
        .withColumn("local_time", F.timestamp_seconds(
            F.unix_seconds(F.col("d").cast("timestamp")) + F.col("h") * 3600 + F.col("m") * 60))
    )
    def offset(days: int) -> Column:
        """Seconds by which the zone's clock is ahead, so many days from the local time."""
        instant = F.timestamp_seconds(F.unix_seconds("local_time") + days * 86_400)
        return F.unix_seconds(F.from_utc_timestamp(instant, F.col("timezone"))) - F.unix_seconds(instant)

    # a change of the clock, however large, lies between the offsets of the day before and the day after
    instants = F.explode(F.array_distinct(F.array(*[F.unix_seconds("local_time") - offset(d) for d in (-1, 1)])))
    due = (
        local.select("*", instants.alias("base"))
        .withColumn("due_at", F.timestamp_seconds("base"))
        .filter(F.from_utc_timestamp("due_at", F.col("timezone")) == F.col("local_time"))
        .filter((F.col("due_at") >= F.lit(start).cast("timestamp"))
                & (F.col("due_at") < F.lit(end).cast("timestamp")))
        .select("cron", "timezone", "due_at")
    )
    # Many definitions share a schedule, and each makes many rows: definitions are dealt out, whatever their schedule.
    tasks = int(live.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fan_out_join(live.repartition(tasks, *live.columns), write_through(due, "due"), ["cron", "timezone"]).select(
        "id", "cron", "timezone", "due_at")


# ── throttling ──────────────────────────────────────────────────────────────
#
# "At most one accepted trigger per interval, counted from the last accepted one"
# is a walk along the pointers from each trigger to the first one that lies an
# interval behind it. Triggers are cut into range partitions by key, time and
# tie-breaker, so a definition of any size is spread. Inside a partition the walks
# of all its definitions are found together by doubling the pointers, in numpy. Only
# the definition that a partition begins with may have begun before: for it, the
# partition gives a step function from the first trigger accepted there to the last
# one. These few rows are folded along the partitions of each definition, and only
# the triggers of such stretches are walked a second time.

_US = 1_000_000
#: Triggers of a range partition, which a task holds in memory as numbers.
ROWS_PER_TASK = 500_000
_BEFORE_ALL = np.iinfo(np.int64).min


def _pointers(code: np.ndarray, us: np.ndarray, ready: np.ndarray) -> np.ndarray:
    """For each row the first row of its key at or after ``ready``; the number of rows if there is none.

    Rows are sorted by ``code`` and ``us``. Times are replaced by their ranks, so that
    key and time make one sorted number.
    """
    n = len(us)
    if not n:
        return np.zeros(0, np.int64)
    times, rank = np.unique(us, return_inverse=True)
    base = code * (len(times) + 1)
    to = np.searchsorted(base + rank, base + np.searchsorted(times, ready), side="left")
    found = (to < n) & (code[np.minimum(to, n - 1)] == code)
    return np.where(found, to, n)


def _walked(start: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    """Which rows the walks from ``start`` meet; each round doubles the steps taken."""
    n = len(pointers)
    met = np.zeros(n + 1, bool)
    met[start] = True
    jump = np.append(pointers, n)
    while True:
        on = jump[np.flatnonzero(met[:n])]
        if (on == n).all():
            return met[:n]
        met[on] = True
        jump = jump[jump]


def _ends(pointers: np.ndarray) -> np.ndarray:
    """The last row on the walk from each row."""
    n = len(pointers)
    jump = np.where(pointers < n, pointers, np.arange(n))
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump
        jump = further


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray] | None:
    """A partition as one table, and the number of the key of each row."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return None
    rows = pa.Table.from_batches(parts).combine_chunks()
    fresh = np.ones(len(rows), np.int64)
    if len(rows) > 1:
        key = rows.column("key").combine_chunks()
        fresh[1:] = pc.not_equal(key.slice(1), key.slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
    return rows, np.cumsum(fresh) - 1


def _judge_partition(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """Verdicts of a partition, but for the key that it begins with, and the steps by which that one goes on.

    Adds ``part``; ``accepted``, null for the first key; ``entry`` and ``leave`` on the
    rows that are steps: of the first key, neighbouring entries with the same last
    acceptance are one step, named by the last of them. The last key, unless it is
    the first too, has one step without entry, which is its state behind the partition.
    """
    got = _gathered(batches)
    if got is None:
        return
    rows, code = got
    us, state = (rows.column(c).to_numpy() for c in ("us", "state"))
    pointers = _pointers(code, us, state + gap)
    n = len(us)
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    met, ends = _walked(starts, pointers), _ends(pointers)
    first = int(starts[1]) if len(starts) > 1 else n
    near = 1 if us[0] == _BEFORE_ALL else min(int(np.searchsorted(us[:first], us[0] + gap, side="left")) + 1, first)
    leave = state[ends[:near]]
    step = np.append(leave[1:] != leave[:-1], True)
    entry, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    entry[:near], left[:near] = us[:near], leave
    no_entry, no_leave = np.ones(n, bool), np.ones(n, bool)
    no_entry[:near], no_leave[:near] = ~step, ~step
    if len(starts) > 1:
        last = starts[-1]
        no_leave[last], left[last] = False, state[ends[last]]
    yield pa.RecordBatch.from_arrays(
        [*(rows.column(c).combine_chunks() for c in rows.column_names),
         pa.array(np.full(n, TaskContext.get().partitionId(), np.int64)), pa.array(met, mask=np.arange(n) < first),
         pa.array(entry, mask=no_entry), pa.array(left, mask=no_leave)],
        [*rows.column_names, "part", "accepted", "entry", "leave"])


def _fold_steps(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """The state before each partition that begins with a key; steps come sorted by key, partition and entry.

    Reads the steps once and holds one state.
    """
    out: list[tuple] = []
    key = part = state = None
    taken = True  # whether this partition's step has been found
    for batch in batches:
        keys, parts = batch.column(0), batch.column(1).to_numpy()
        edges = np.ones(len(batch), bool)
        if len(batch) > 1:
            edges[1:] = (parts[1:] != parts[:-1]) | pc.not_equal(keys.slice(1), keys.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
        firsts = np.flatnonzero(edges)
        entry, leave = batch.column(2), batch.column(3)
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(batch)]):
            here = (keys[a].as_py(), int(parts[a]))
            if here != (key, part):
                if here[0] != key:
                    state = None
                key, part = here
                if entry[a].is_valid:
                    out.append((key, part, state))
                    taken = False
            if not entry[a].is_valid:
                state, taken = leave[a].as_py(), True
            elif not taken:
                at = a if state is None else a + int(np.searchsorted(entry.slice(a, b - a).to_numpy(), state + gap, side="left"))
                if at < b:
                    state, taken = leave[at].as_py(), True
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64()))], ["key", "part", "before"])


def _judge_first_keys(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """Verdicts for the first keys of partitions, given the state before them."""
    got = _gathered(batches)
    if got is None:
        return
    rows, _ = got
    part, us, state = (rows.column(c).to_numpy() for c in ("part", "us", "state"))
    code = np.cumsum(np.r_[0, part[1:] != part[:-1]])
    pointers = _pointers(code, us, state + gap)
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    known = rows.column("before").is_valid().to_numpy()[starts]
    before = rows.column("before").fill_null(0).to_numpy()[starts]
    times, rank = np.unique(us, return_inverse=True)
    numbers = code * (len(times) + 1) + rank
    entered = np.searchsorted(numbers, code[starts] * (len(times) + 1) + np.searchsorted(times, before + gap), side="left")
    entered = np.where(known, np.minimum(entered, np.append(starts[1:], len(us))), starts)
    begin = entered[entered < np.append(starts[1:], len(us))]
    met = _walked(begin, pointers)
    yield pa.RecordBatch.from_arrays(
        [*(rows.column(c).combine_chunks() for c in ("key", "ts", "tie", "us")), pa.array(met)], ["key", "ts", "tie", "us", "accepted"])


def throttle_triggers(triggers: DataFrame, key: str = "definition_id", ts: str = "ts", tie: str = "event_id",
                      seconds: int = THROTTLE_SECONDS, last_accepted: DataFrame | None = None,
                      rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All triggers with ``accepted``: at most one per key within ``seconds`` of the last accepted.

    Equal times are decided by the tie-breaker, which is unique per key. A trigger
    without key or time gets no verdict (null). Triggers are shuffled once, in ranges
    of about ``rows_per_task``, and the verdicts are written to the scratch folder;
    only keys that cross the border of a range are shuffled again. ``last_accepted``
    (key, state in microseconds) carries acceptances from earlier data.
    """
    spark = triggers.sparkSession
    gap = seconds * _US
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    all_rows = triggers.select(
        F.col(key).cast("string").alias("key"), F.col(ts).alias("ts"), F.col(tie).cast("long").alias("tie"), us.alias("us"))
    known = F.col("key").isNotNull() & F.col("us").isNotNull()
    rows = all_rows.where(known).withColumn("state", F.col("us"))
    if last_accepted is not None:  # an acceptance of its own, before all triggers of the key
        kind = rows.schema["ts"].dataType
        rows = rows.unionByName(last_accepted.where("state is not null").select(
            "key", F.lit(None).cast(kind).alias("ts"), F.lit(None).cast("long").alias("tie"),
            F.lit(_BEFORE_ALL).alias("us"), "state"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    plain = ", ".join(f"{c} {kinds[c]}" for c in ("key", "ts", "tie", "us"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-triggers.count() // rows_per_task))
    order = ["key", "us", "tie"]
    judged = write_through(
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
            lambda b: _judge_partition(b, gap), f"{plain}, state long, part long, accepted boolean, entry long, leave long"), "verdicts")
    steps = judged.where("leave is not null").select("key", "part", "entry", "leave")
    before = steps.repartition("key").sortWithinPartitions("key", "part", "entry").mapInArrow(
        lambda b: _fold_steps(b, gap), "key string, part long, before long")
    open_rows = judged.where("accepted is null").join(before, ["key", "part"])
    second = open_rows.select("part", *order, "ts", "state", "before").repartition("part").sortWithinPartitions("part", *order).mapInArrow(
        lambda b: _judge_first_keys(b, gap), f"{plain}, accepted boolean")
    out = judged.where("accepted is not null").select("key", "ts", "tie", "us", "accepted").unionByName(second)
    out = out.where(F.col("us") > _BEFORE_ALL) if last_accepted is not None else out
    unjudged = all_rows.where(~known).withColumn("accepted", F.lit(None).cast("boolean"))
    return out.unionByName(unjudged).select(F.col("key").alias(key), F.col("ts").alias(ts), F.col("tie").alias(tie), "accepted")


def review_coverage(instances: DataFrame, sign_offs: DataFrame, me: str) -> DataFrame:
    """Per report instance: approvals, attestations, own sign-off, and what is outstanding.

    Only the latest sign-off of a user counts.
    """
    latest = sign_offs.groupBy("instance_id", "user_id").agg(
        F.max_by(F.struct("action", "attestation"), F.struct("signed_at", "sign_off_id")).alias("s"))
    approved = F.col("s.action") == "approved"
    per_instance = latest.groupBy("instance_id").agg(
        F.count_if(approved).alias("approvals"),
        F.count_if(approved & F.col("s.attestation")).alias("attested"),
        F.max(F.when(F.col("user_id") == me, F.col("s.action"))).alias("own_sign_off"),
    )
    return (
        instances.join(per_instance, "instance_id", "left")
        .fillna(0, ["approvals", "attested"])
        .withColumn("outstanding", F.col("approvals") == 0)
    )
