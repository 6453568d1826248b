"""Tags, and telemetry of agents, sidecars and tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.operators.scaling import fan_out_join

COLUMN_KEYS = ("database_name", "schema_name", "table_name", "column_name")


def tag_values(assignments: DataFrame, tag_name: str) -> DataFrame:
    """Distinct allowed values of a tag."""
    return assignments.filter(F.upper("tag_name") == tag_name.upper()).select("tag_value").distinct()


def tag_coverage(catalog: DataFrame, assignments: DataFrame, policies: DataFrame,
                 approved: DataFrame) -> DataFrame:
    """Three kinds of gaps: tagged columns without policy, policies without a tagged
    column, and untagged columns with approved findings."""
    tag = F.upper("tag_name")
    tagged = assignments.select(*COLUMN_KEYS, tag.alias("tag_name"))
    ruled = policies.select(F.upper("tag").alias("tag_name")).distinct()
    no_policy = fan_out_join(tagged, ruled, ["tag_name"], "left_anti").select(
        F.lit("tagged_without_policy").alias("gap"), *COLUMN_KEYS, "tag_name")
    no_column = ruled.join(tagged.select("tag_name").distinct(), "tag_name", "left_anti").select(
        F.lit("policy_without_column").alias("gap"),
        *[F.lit(None).cast("string").alias(c) for c in COLUMN_KEYS], "tag_name")
    known = catalog.select(*COLUMN_KEYS)
    untagged = (
        approved.select(*COLUMN_KEYS).distinct().join(known, list(COLUMN_KEYS), "left_semi")
        .join(tagged.select(*COLUMN_KEYS).distinct(), list(COLUMN_KEYS), "left_anti")
        .select(F.lit("approved_without_tag").alias("gap"), *COLUMN_KEYS, F.lit(None).cast("string").alias("tag_name"))
    )
    return no_policy.unionByName(no_column).unionByName(untagged).distinct()


def from_millis(col: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(col)


def latest_instances(heartbeats: DataFrame, owner: str, now: Column, ttl_seconds: int,
                     ts: str = "checkin_time", tie: str | None = None) -> DataFrame:
    """Last check-in per instance, its age in seconds, and whether it still runs."""
    rest = [c for c in heartbeats.columns if c not in (owner, "instance_id")]
    order = F.struct(ts, tie) if tie else F.col(ts)
    last = heartbeats.groupBy(owner, "instance_id").agg(F.max_by(F.struct(*rest), order).alias("h"))
    age = F.unix_seconds(now) - F.unix_seconds(F.col(ts).cast("timestamp"))
    return (
        last.select(owner, "instance_id", "h.*").withColumn("age_seconds", age)
        .withColumn("running", F.col("age_seconds") <= ttl_seconds)
    )


def task_detail(rows: DataFrame, task_id: str) -> DataFrame:
    """One task with a row per message."""
    return rows.filter(F.col("task_id") == task_id).select(
        "*", F.explode_outer("messages").alias("m")
    ).select("task_id", "agent_id", "status", "task_type", "checkin_time", "m.severity", "m.message")


def task_telemetry(rows: DataFrame, agent_id: str | Sequence[str] | None = None) -> DataFrame:
    """Messages per agent, task status and severity; tasks without messages count once."""
    if agent_id is not None:
        ids = [agent_id] if isinstance(agent_id, str) else list(agent_id)
        rows = rows.filter(F.col("agent_id").isin(*ids))
    return (
        rows.select("agent_id", "status", F.explode_outer("messages").alias("m"))
        .groupBy("agent_id", "status", F.coalesce("m.severity", F.lit("NONE")).alias("severity"))
        .agg(F.count(F.lit(1)).alias("entries"))
    )


def fleet_summary(instances: DataFrame, owner: str, sums: Sequence[str], version: str | None = None) -> DataFrame:
    """Per agent or sidecar: instances, running ones, summed gauges, versions in use."""
    extra = []
    if version:
        extra.append(F.array_join(F.array_sort(F.collect_set(version)), ",").alias("versions"))
    return instances.groupBy(owner).agg(
        F.count(F.lit(1)).alias("instances"), F.count_if("running").alias("running"),
        *[F.sum(c).alias(c) for c in sums], *extra)
