"""Tags and telemetry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import findings as C
from wardlake.operators import fleet as H
from wardlake.plans import derived as D
from wardlake.plans.registry import query, sql_stamp, stamp

NOW = dt.datetime(2024, 1, 31)


@query("tag_values", f"WITH {D.ASSIGNMENTS} SELECT DISTINCT tag_value FROM assignments WHERE upper(tag_name) = 'PII'")
def tag_values(spark: SparkSession, base: str) -> DataFrame:
    return H.tag_values(D.assignments(spark, base), "pii")


@query("tag_coverage", f"""
WITH {D.STATUS},
assignments AS (
  SELECT column_id, database_name, schema_name, table_name, column_name,
    {D.sql_pick(('PII', 'Money', 'LEGACY', 'pac_level'), 'column_id')} AS tag_name FROM inventory WHERE column_size <= 33),
policies AS (SELECT unnest(['PII', 'MONEY', 'UNUSED']) AS tag_name)
SELECT 'tagged_without_policy' AS gap, database_name, schema_name, table_name, column_name, upper(tag_name) AS tag_name
FROM assignments WHERE upper(tag_name) NOT IN ('PII', 'MONEY', 'UNUSED')
UNION SELECT 'policy_without_column', NULL, NULL, NULL, NULL, tag_name FROM policies
WHERE tag_name NOT IN (SELECT upper(tag_name) FROM assignments)
UNION SELECT 'approved_without_tag', database_name, schema_name, table_name, column_name, NULL FROM reviewed
WHERE status = 'approved' AND column_name NOT IN (SELECT column_name FROM assignments)""")
def tag_coverage(spark: SparkSession, base: str) -> DataFrame:
    reviewed = C.resolve_status(D.findings_log(spark, base), D.decisions(spark, base), ["decided_at", "decision_id"])
    policies = spark.createDataFrame([("PII",), ("MONEY",), ("unused",)], "tag string")
    return H.tag_coverage(D.inventory(spark, base), D.assignments(spark, base), policies,
                          reviewed.filter("status = 'approved'"))


_LATEST = """latest AS (
  SELECT *, CAST(floor(epoch(TIMESTAMP '2024-01-31')) - floor(epoch(checkin_time)) AS BIGINT) AS age_seconds FROM (
    SELECT *, row_number() OVER (PARTITION BY agent_id, instance_id ORDER BY checkin_time DESC, event_id DESC) AS rn FROM heartbeats)
  WHERE rn = 1)"""


@query("latest_instances", f"""
WITH {D.HEARTBEATS}, {_LATEST}
SELECT agent_id, instance_id, event_id, {sql_stamp('checkin_time')} AS checkin_time, active_tasks, idle_tasks, version,
  age_seconds, age_seconds <= 90000 AS running FROM latest""")
def latest_instances(spark: SparkSession, base: str) -> DataFrame:
    out = H.latest_instances(D.heartbeats(spark, base), "agent_id", F.lit(NOW).cast("timestamp"), 90000, tie="event_id")
    return out.withColumn("checkin_time", stamp("checkin_time"))


@query("fleet_summary", f"""
WITH {D.HEARTBEATS}, {_LATEST}
SELECT agent_id, count(*) AS instances, count_if(age_seconds <= 90000) AS running,
  CAST(sum(active_tasks) AS BIGINT) AS active_tasks, CAST(sum(idle_tasks) AS BIGINT) AS idle_tasks,
  string_agg(DISTINCT version, ',' ORDER BY version) AS versions
FROM latest GROUP BY agent_id""")
def fleet_summary(spark: SparkSession, base: str) -> DataFrame:
    last = H.latest_instances(D.heartbeats(spark, base), "agent_id", F.lit(NOW).cast("timestamp"), 90000, tie="event_id")
    return H.fleet_summary(last, "agent_id", ["active_tasks", "idle_tasks"], "version")


def _tasks(spark: SparkSession, base: str) -> DataFrame:
    """Task telemetry: one row per event, with as many messages as k modulo 3 says."""
    return D.heartbeats(spark, base).join(
        D.load(spark, base, "events").select("event_id", "event_type"), "event_id").selectExpr(
        "'t_' || event_id AS task_id", "agent_id", "CASE WHEN idle_tasks = 0 THEN 'FAILED' ELSE 'RUNNING' END AS status",
        "event_type AS task_type", "unix_millis(checkin_time) AS checkin_time",
        "transform(slice(array(0, 1), 1, idle_tasks), i -> named_struct('severity', "
        "element_at(array('INFO', 'WARN', 'ERROR'), CAST((active_tasks + i) % 3 + 1 AS INT)), 'message', event_type)) AS messages")


_TASKS = D.HEARTBEATS + """,
tasks AS (
  SELECT 't_' || h.event_id AS task_id, agent_id, CASE WHEN idle_tasks = 0 THEN 'FAILED' ELSE 'RUNNING' END AS status,
    event_type AS task_type, checkin_time, event_type AS message, active_tasks, idle_tasks
  FROM heartbeats h JOIN events e ON e.event_id = h.event_id),
entries AS (
  SELECT task_id, agent_id, status, task_type, checkin_time,
    CASE WHEN i < idle_tasks THEN ['INFO', 'WARN', 'ERROR'][CAST((active_tasks + i) % 3 + 1 AS INTEGER)] END AS severity,
    CASE WHEN i < idle_tasks THEN message END AS message
  FROM tasks CROSS JOIN (SELECT unnest([0, 1]) AS i) WHERE i < idle_tasks OR (i = 0 AND idle_tasks = 0))"""


@query("task_telemetry", f"""
WITH {_TASKS}
SELECT agent_id, status, coalesce(severity, 'NONE') AS severity, count(*) AS entries FROM entries
WHERE agent_id IN ('a_1', 'a_3') GROUP BY ALL""")
def task_telemetry(spark: SparkSession, base: str) -> DataFrame:
    return H.task_telemetry(_tasks(spark, base), ["a_1", "a_3"])


@query("task_detail", f"""
WITH {_TASKS}
SELECT task_id, agent_id, status, task_type, {sql_stamp("date_trunc('millisecond', checkin_time)")} AS checkin_time, severity, message
FROM entries WHERE task_id = 't_17'""")
def task_detail(spark: SparkSession, base: str) -> DataFrame:
    out = H.task_detail(_tasks(spark, base), "t_17")
    return out.withColumn("checkin_time", stamp(H.from_millis(F.col("checkin_time"))))
