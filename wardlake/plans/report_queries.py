"""Report filters, windows, schedules, throttling and review coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import reports as R
from wardlake.operators.common import time_literal
from wardlake.plans import derived as D
from wardlake.plans.registry import query, sql_stamp, stamp
from wardlake.session import scratch_path
from wardlake.sources.sinks import write_report

FILTERS = {
    "filter_groups": [
        {"filters": [
            {"field": "table_name", "mode": "include", "patterns": [
                {"match_type": "exact", "value": "orders"}, {"match_type": "prefix", "value": "line"}]},
            {"field": "consuming_user", "mode": "exclude", "patterns": [{"match_type": "suffix", "value": "7"}]},
        ]},
        {"filters": [
            {"field": "policy_blocked", "mode": "include", "patterns": [{"match_type": "exact", "value": "true"}]},
            {"field": "statement_text", "mode": "include", "patterns": [{"match_type": "contains", "value": "VIEW"}]},
        ]},
    ]
}
REPORT = R.ReportDefinition("weekly", lookback_days=7, timezone="America/New_York", filters=FILTERS)
TRIGGER = dt.datetime(2024, 1, 20, 12, 0)
_MATCH = """((table_name = 'orders' OR table_name LIKE 'line%') AND consuming_user NOT LIKE '%7')
  OR (policy_blocked AND contains(statement_text, 'VIEW'))"""
_IN_WINDOW = "event_time >= TIMESTAMP '2024-01-13 05:00:00' AND event_time < TIMESTAMP '2024-01-20 05:00:00'"


@query("report_filters", f"""
WITH {D.AUDITS}
SELECT event_id, {sql_stamp('event_time')} AS event_time, consuming_user, table_name, statement_type, row_count
FROM audits WHERE {_IN_WINDOW} AND ({_MATCH})""")
def report_filters(spark: SparkSession, base: str) -> DataFrame:
    detail, _ = R.build_report(D.audits(spark, base), REPORT, TRIGGER)
    return detail.select("event_id", stamp("event_time").alias("event_time"), "consuming_user", "table_name",
                         "statement_type", "row_count")


@query("report_summary", f"""
WITH {D.AUDITS}
SELECT consuming_user, statement_type, count(*) AS statements, CAST(sum(row_count) AS BIGINT) AS rows_accessed,
  CAST(sum(bytes) AS BIGINT) AS bytes, count_if(NOT execution_success) AS failures, count_if(policy_blocked) AS blocks
FROM audits WHERE {_IN_WINDOW} AND ({_MATCH}) GROUP BY ALL""")
def report_summary(spark: SparkSession, base: str) -> DataFrame:
    return R.build_report(D.audits(spark, base), REPORT, TRIGGER, ["consuming_user", "statement_type"])[1]


@query("report_snowflake", f"""
WITH {D.AUDITS}
SELECT consuming_user AS username, count(*) AS queries FROM audits
WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'
  AND executing_role = 'ANALYST' AND NOT contains(sidecar_id, '_3') GROUP BY 1""")
def report_snowflake(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).selectExpr(
        "event_time", "consuming_user AS username", "executing_role AS current_role", "sidecar_id AS warehouse")
    spec = {"filter_groups": [{"filters": [
        {"field": "current_role", "mode": "include", "patterns": [{"match_type": "exact", "value": "ANALYST"}]},
        {"field": "warehouse", "mode": "exclude", "patterns": [{"match_type": "contains", "value": "_3"}]}]}]}
    kept = rows.filter(R.compile_filters(spec, "snowflake"))
    start, end = R.window_bounds(TRIGGER, 10, "UTC")
    ts = F.col("event_time")
    kept = kept.filter((ts >= time_literal(rows, "event_time", start)) & (ts < time_literal(rows, "event_time", end)))
    return kept.groupBy("username").agg(F.count(F.lit(1)).alias("queries"))


_ZONES = ("America/New_York", "Europe/Berlin", "UTC")


def _day(ts: str, zone: str, back: str) -> str:
    local = f"date_trunc('day', timezone({zone}, timezone('UTC', {ts})))"
    return sql_stamp(f"timezone('UTC', timezone({zone}, CAST({local} - {back} AS TIMESTAMP)))")


@query("report_window", f"""
WITH t AS (SELECT o_orderkey, o_orderdate + to_minutes(o_orderkey % 1440) AS ts, o_orderkey % 30 AS back,
             {D.sql_pick(_ZONES, 'o_orderkey')} AS zone FROM orders)
SELECT o_orderkey, {_day('ts', 'zone', "to_days(CAST(back AS INTEGER))")} AS window_start,
  {_day('ts', 'zone', "to_days(0)")} AS window_end FROM t""")
def report_window(spark: SparkSession, base: str) -> DataFrame:
    """Windows of one trigger per order, across all clock changes of seven years."""
    t = D.load(spark, base, "orders").selectExpr(
        "o_orderkey", "timestampadd(MINUTE, o_orderkey % 1440, CAST(o_orderdate AS TIMESTAMP)) AS ts",
        "CAST(o_orderkey % 30 AS INT) AS back", f"{D.spark_pick(_ZONES, 'o_orderkey')} AS zone")
    start, end = R.report_window(F.col("ts"), F.col("back"), F.col("zone"))
    return t.select("o_orderkey", stamp(start).alias("window_start"), stamp(end).alias("window_end"))


CRONS = (
    "0 12 * * ? *", "0 9 * * ? *", "0 9 ? * MON *", "30 8 ? * MON-FRI *", "0 18 ? * SUN *", "0 0 1 * ? *",
    "0 * * * ? *", "0/15 * * * ? *", "0 7 ? * TUE,THU *",
)
_CRON_SQL = (
    "h = 12 AND m = 0", "h = 9 AND m = 0", "h = 9 AND m = 0 AND dow = 1", "h = 8 AND m = 30 AND dow BETWEEN 1 AND 5",
    "h = 18 AND m = 0 AND dow = 0", "h = 0 AND m = 0 AND dom = 1", "m = 0", "m % 15 = 0", "h = 7 AND m = 0 AND dow IN (2, 4)",
)


def _cron_sql(start: str, end: str) -> str:
    branches = " OR ".join(f"(cron = '{c}' AND {t})" for c, t in zip(CRONS, _CRON_SQL))
    return f"""
WITH defs AS (SELECT 'def_' || c_custkey AS id, {D.sql_pick(CRONS, 'c_custkey')} AS cron,
    {D.sql_pick(_ZONES, 'c_nationkey')} AS zone FROM customer WHERE c_acctbal >= 0),
minutes AS (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}' - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS due),
local AS (SELECT due, zone, timezone(zone, timezone('UTC', due)) AS l FROM minutes CROSS JOIN (SELECT DISTINCT zone FROM defs)),
parts AS (SELECT due, zone, hour(l) AS h, minute(l) AS m, dayofweek(l) AS dow, day(l) AS dom FROM local),
hits AS (SELECT due, zone, cron FROM parts CROSS JOIN (SELECT unnest({list(CRONS)}) AS cron) WHERE {branches})
SELECT id, cron, zone AS timezone, {sql_stamp('due')} AS due_at FROM defs JOIN hits USING (cron, zone)"""


def _due(spark: SparkSession, base: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    defs = D.load(spark, base, "customer").selectExpr(
        "'def_' || c_custkey AS id", f"{D.spark_pick(CRONS, 'c_custkey')} AS cron",
        "c_acctbal >= 0 AS enabled", f"{D.spark_pick(_ZONES, 'c_nationkey')} AS timezone")
    due = R.expand_cron(defs, start, end)
    return due.withColumn("due_at", stamp("due_at"))


@query("expand_cron_january", _cron_sql("2024-01-01", "2024-02-01"))
def expand_cron_january(spark: SparkSession, base: str) -> DataFrame:
    return _due(spark, base, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))


@query("expand_cron_clock_change", _cron_sql("2024-03-10", "2024-03-11"))
def expand_cron_clock_change(spark: SparkSession, base: str) -> DataFrame:
    return _due(spark, base, dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 11))


_THROTTLE = """
WITH RECURSIVE t AS (
  SELECT 'd_' || (user_id % 20) AS definition_id, ts, event_id,
    row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS n
  FROM events WHERE {where}),
walk AS (
  SELECT definition_id, n, ts, event_id, true AS accepted, ts AS last FROM t WHERE n = 1
  UNION ALL
  SELECT t.definition_id, t.n, t.ts, t.event_id, t.ts >= walk.last + INTERVAL {s} SECOND,
    CASE WHEN t.ts >= walk.last + INTERVAL {s} SECOND THEN t.ts ELSE walk.last END
  FROM walk JOIN t ON t.definition_id = walk.definition_id AND t.n = walk.n + 1)
SELECT definition_id, {t} AS ts, event_id, accepted FROM walk"""


@query("throttle_triggers", _THROTTLE.format(where="true", s=300, t=sql_stamp("ts")))
def throttle_triggers(spark: SparkSession, base: str) -> DataFrame:
    return R.throttle_triggers(D.triggers(spark, base)).withColumn("ts", stamp("ts"))


@query("throttle_null_keys", _THROTTLE.format(where="user_id % 20 < 15 AND event_id % 10 <> 3", s=300, t=sql_stamp("ts")) + f"""
UNION ALL SELECT CASE WHEN user_id % 20 < 15 THEN 'd_' || (user_id % 20) END,
  CASE WHEN event_id % 10 <> 3 THEN {sql_stamp("ts")} END, event_id, CAST(NULL AS BOOLEAN) FROM events
WHERE user_id % 20 >= 15 OR event_id % 10 = 3""")
def throttle_null_keys(spark: SparkSession, base: str) -> DataFrame:
    """Triggers without a definition or a time stay, without a verdict."""
    e = D.load(spark, base, "events").selectExpr(
        "CASE WHEN user_id % 20 < 15 THEN 'd_' || (user_id % 20) END AS definition_id",
        "CASE WHEN event_id % 10 <> 3 THEN ts END AS ts", "event_id")
    return R.throttle_triggers(e).withColumn("ts", stamp("ts"))


@query("throttle_triggers_dense", _THROTTLE.format(where="true", s=14400, t=sql_stamp("ts")))
def throttle_triggers_dense(spark: SparkSession, base: str) -> DataFrame:
    """A long interval over many triggers: most are refused, across the borders of ranges."""
    e = D.load(spark, base, "events").selectExpr(
        "'d_' || (user_id % 20) AS definition_id", "ts", "event_id")
    return R.throttle_triggers(e, seconds=14400).withColumn("ts", stamp("ts"))


@query("review_coverage", f"""
WITH {D.SIGN_OFFS},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instance_id, user_id ORDER BY signed_at DESC, sign_off_id DESC) AS rn
  FROM sign_offs) WHERE rn = 1)
SELECT i.instance_id, i.definition_id, count_if(coalesce(action = 'approved', false)) AS approvals,
  count_if(coalesce(action = 'approved' AND attestation, false)) AS attested,
  max(CASE WHEN user_id = 'u_3' THEN action END) AS own_sign_off,
  count_if(coalesce(action = 'approved', false)) = 0 AS outstanding
FROM instances i LEFT JOIN latest l ON l.instance_id = i.instance_id GROUP BY 1, 2""")
def review_coverage(spark: SparkSession, base: str) -> DataFrame:
    return R.review_coverage(D.report_instances(spark, base), D.sign_offs(spark, base), "u_3")


@query("write_report_csv", f"""
WITH {D.AUDITS}
SELECT CAST(event_id AS VARCHAR) AS event_id, consuming_user, CAST(row_count AS VARCHAR) AS row_count
FROM audits WHERE {_IN_WINDOW} AND ({_MATCH})""")
def write_report_csv(spark: SparkSession, base: str) -> DataFrame:
    """The report as written to CSV, read back as text."""
    detail, _ = R.build_report(D.audits(spark, base), REPORT, TRIGGER)
    path = scratch_path(spark, "report")
    write_report(detail.select("event_id", "consuming_user", "row_count"), path)
    return spark.read.option("header", True).csv(path, schema="event_id string, consuming_user string, row_count string")
