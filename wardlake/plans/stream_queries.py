"""Streaming operators fed from the event files, compared with closed batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import masking as M
from wardlake.plans import derived as D
from wardlake.plans.token_queries import SECRET, retired_events, sql_token
from wardlake.plans.registry import query, sql_stamp, stamp
from wardlake.session import scratch_path
from wardlake.streaming import live as X

_EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, base: str) -> DataFrame:
    return spark.readStream.schema(_EVENTS_DDL).option("pathGlobFilter", "events.parquet").parquet(base)


@query("mask_stream", """
SELECT event_id, repeat('*', length('user_' || user_id)) AS consuming_user, CAST(NULL AS DOUBLE) AS value FROM events""")
def mask_stream(spark: SparkSession, base: str) -> DataFrame:
    rows = event_stream(spark, base).selectExpr("event_id", "'user_' || user_id AS consuming_user", "value")
    rules = [M.MaskRule("ANALYST", "PII_NAME", 10001)]
    masked = X.mask_stream(rows, {"consuming_user": "PII_NAME", "value": "UNRULED"}, rules, "ANALYST")
    return X.run_to_files(masked, scratch_path(spark, "masked"), scratch_path(spark, "cp"))


@query("stream_rate_breaches", f"""
WITH {D.AUDITS}, bound AS (SELECT max(ts) - INTERVAL 1 DAY AS closed FROM events)
SELECT 'r1' AS rule_id, consuming_user, 'HOUR' AS unit, {sql_stamp("date_trunc('hour', event_time)")} AS window_start,
  count(*) AS accesses, 1 AS access_rate_limit, 'block' AS action
FROM audits WHERE executing_role = 'ADMIN'
GROUP BY consuming_user, date_trunc('hour', event_time)
HAVING count(*) > 1 AND date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT closed FROM bound)""")
def stream_rate_breaches(spark: SparkSession, base: str) -> DataFrame:
    rows = event_stream(spark, base).selectExpr(
        "CAST(ts AS TIMESTAMP) AS event_time", "'user_' || user_id AS consuming_user",
        f"{D.spark_pick(D.ROLES, 'user_id')} AS executing_role")
    rules = spark.createDataFrame(
        [("r1", "ADMIN", [("hour", 1, "block")])],
        "rule_id string, role string, access_rate_thresholds array<struct<access_rate_unit:string,access_rate_limit:int,action:string>>")
    breaches = X.stream_rate_breaches(rows, rules, "hour", "1 day")
    out = X.run_to_files(breaches, scratch_path(spark, "rates"), scratch_path(spark, "cp"))
    return out.withColumn("window_start", stamp("window_start"))


@query("stream_instance_liveness", f"""
WITH {D.HEARTBEATS},
marked AS (SELECT *, CASE WHEN checkin_time < lag(checkin_time) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
  FROM heartbeats WINDOW w AS (PARTITION BY agent_id, instance_id ORDER BY checkin_time, event_id)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY agent_id, instance_id ORDER BY checkin_time, event_id) AS run FROM marked)
SELECT agent_id, instance_id, {sql_stamp('min(checkin_time)')} AS up_from,
  {sql_stamp("max(checkin_time) + INTERVAL 2 HOUR")} AS up_to, count(*) AS checkins
FROM runs GROUP BY agent_id, instance_id, run
HAVING max(checkin_time) + INTERVAL 2 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_instance_liveness(spark: SparkSession, base: str) -> DataFrame:
    rows = event_stream(spark, base).selectExpr(
        "event_id", "'i_' || (user_id % 20) AS instance_id", "'a_' || (user_id % 4) AS agent_id",
        "CAST(ts AS TIMESTAMP) AS checkin_time")
    up = X.stream_instance_liveness(rows, "2 hours", "1 hour")
    out = X.run_to_files(up, scratch_path(spark, "liveness"), scratch_path(spark, "cp"))
    return out.withColumns({"up_from": stamp("up_from"), "up_to": stamp("up_to")})


@query("stream_throttle", f"""
WITH RECURSIVE t AS (
  SELECT 'd_' || (user_id % 20) AS definition_id, ts, event_id,
    row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS n FROM events),
walk AS (
  SELECT definition_id, n, ts, event_id, true AS accepted, ts AS last FROM t WHERE n = 1
  UNION ALL
  SELECT t.definition_id, t.n, t.ts, t.event_id, t.ts >= walk.last + INTERVAL 3600 SECOND,
    CASE WHEN t.ts >= walk.last + INTERVAL 3600 SECOND THEN t.ts ELSE walk.last END
  FROM walk JOIN t ON t.definition_id = walk.definition_id AND t.n = walk.n + 1)
SELECT definition_id, {sql_stamp('ts')} AS ts, event_id, accepted FROM walk""")
def stream_throttle(spark: SparkSession, base: str) -> DataFrame:
    """The events arrive in three parts; after each the query starts again from its checkpoint."""
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "throttle", "cp"))
    rows = spark.read.parquet(f"{base}/events.parquet").selectExpr("'d_' || (user_id % 20) AS definition_id", "ts", "event_id")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first, first + (last - first) / 3, first + (last - first) * 2 / 3, None]
    for start, end in zip(cuts, cuts[1:]):
        later = F.col("ts") >= F.lit(start).cast("timestamp_ntz")
        rows.where(later if end is None else later & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        verdicts = X.run_to_files(X.stream_throttle(stream, 3600), out, checkpoint)
    return verdicts.withColumn("ts", stamp("ts"))


@query("stream_tokenize", f"""
SELECT event_id, event_type, {sql_token('event_type')} AS token FROM events""")
def stream_tokenize(spark: SparkSession, base: str) -> DataFrame:
    """Events in three micro-batches, the vault compacted after the first; tokens joined with the vault that they wrote."""
    root, inbox, checkpoint = (scratch_path(spark, n) for n in ("tokens", "inbox", "cp"))
    rows = spark.read.parquet(f"{base}/events.parquet").select("event_id", "event_type")
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        X.stream_tokenize(stream, ["event_type"], root, checkpoint, secret=SECRET).awaitTermination()
        if part == 0:
            X.compact_vault(spark, root)
    vault = X.read_vault(spark, root).select("token", "value")
    tokens = spark.read.parquet(f"{root}/rows").select("event_id", F.col("event_type").alias("token"))
    return tokens.join(vault, "token").select("event_id", F.col("value").alias("event_type"), "token")


@query("delete_and_retokenize_stream", f"""
SELECT event_id, {sql_token('event_type', generation="CASE WHEN event_type IN ('view', 'error') THEN '1' ELSE '0' END")} AS token
FROM events""")
def delete_and_retokenize_stream(spark: SparkSession, base: str) -> DataFrame:
    """The stream looks at the generations of deleted values."""
    root = scratch_path(spark, "tokens")
    rows = event_stream(spark, base).select("event_id", "event_type")
    X.stream_tokenize(rows, ["event_type"], root, scratch_path(spark, "cp"), secret=SECRET,
                      retired=retired_events(spark, base)).awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("event_id", F.col("event_type").alias("token"))
