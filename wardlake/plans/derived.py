"""Security views over the given tables, once as DataFrames and once as SQL.

The given tables hold sales, events and text. These views read them as audit
logs, inventories, findings, decisions and so on, row for row, so that every
operator works on data that grows with the tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.operators.audits import CATEGORIES
from wardlake.session import scratch_path

TABLES = ("customer", "orders", "lineitem", "part", "supplier")
ROLES = ("ADMIN", "ANALYST", "PUBLIC")
TAG_VALUES = ("PII_NAME", "PII_EMAIL", "MONEY")
CLASSIFIERS = ("EMAIL", "PHONE", "CARD", "SSN", "IP", "SECRET_TOKEN")


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


#: Lengths under which a source declares text columns.
DECLARED = {("documents", "lang"): 5, ("documents", "source"): 64, ("customer", "c_name"): 25, ("customer", "c_mktsegment"): 10,
            ("conversations", "role"): 9}


def register_tables(spark: SparkSession, base: str, names: Sequence[str]) -> str:
    """A database of the session's metastore that holds the given tables where they lie, with declared lengths."""
    database = f"wardlake_{zlib.crc32(base.encode()):08x}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_path(spark, database)}'")
    for name in names:
        kind = lambda f: f"varchar({n})" if (n := DECLARED.get((name, f.name))) else f.dataType.simpleString()  # noqa: E731, B023
        columns = ", ".join(f"{f.name} {kind(f)}" for f in load(spark, base, name).schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet LOCATION '{base}/{name}.parquet'")
    return database


def pick(options: tuple[str, ...], index: Column) -> Column:
    """The option at an index, wrapping around."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(index, F.lit(len(options))) + 1).cast("int"))


def sql_pick(options: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"[{listed}][CAST(({index}) % {len(options)} + 1 AS INTEGER)]"


def spark_pick(options: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{o}'" for o in options)
    return f"element_at(array({listed}), CAST(({index}) % {len(options)} + 1 AS INT))"


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ── audits ──────────────────────────────────────────────────────────────────


def audits(spark: SparkSession, base: str) -> DataFrame:
    e = load(spark, base, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return e.selectExpr(
        "event_id", "ts AS event_time", "user_id", "k", "event_type",
        "'user_' || user_id AS consuming_user",
        "'user_' || user_id || '@example.com' AS consuming_user_email",
        "upper(event_type) AS statement_type", "'tpch' AS database_name", "'main' AS schema_name",
        f"{spark_pick(TABLES, 'k')} AS table_name", "'col_' || (k % 7) AS column_name",
        f"upper(event_type) || ' ' || {spark_pick(TABLES, 'k')} AS statement_text",
        "CAST(floor(value) AS BIGINT) AS row_count", "CAST(floor(value) AS BIGINT) * 8 AS bytes",
        "event_type <> 'error' AS execution_success", "user_id % 17 = 0 AS policy_blocked",
        "'sc_' || (user_id % 5) AS sidecar_id", "'sc_' || (user_id % 5) || '_' || (k % 3) AS sidecar_instance_id",
        "'repo_' || (k % 4) AS repo_name", "'q_' || event_id AS query_id",
        f"{spark_pick(ROLES, 'user_id')} AS executing_role",
        f"{spark_pick(('PII', 'MONEY'), 'k')} AS policy_tag_name",
        f"{spark_pick(TAG_VALUES, 'k')} AS policy_tag_value",
        f"{spark_pick(CATEGORIES, 'k')} AS category",
    )


AUDITS = f"""
audits AS (
  SELECT event_id, ts AS event_time, user_id, k, event_type,
    'user_' || user_id AS consuming_user,
    'user_' || user_id || '@example.com' AS consuming_user_email,
    upper(event_type) AS statement_type, 'tpch' AS database_name, 'main' AS schema_name,
    {sql_pick(TABLES, 'k')} AS table_name, 'col_' || (k % 7) AS column_name,
    upper(event_type) || ' ' || {sql_pick(TABLES, 'k')} AS statement_text,
    CAST(floor(value) AS BIGINT) AS row_count, CAST(floor(value) AS BIGINT) * 8 AS bytes,
    event_type <> 'error' AS execution_success, user_id % 17 = 0 AS policy_blocked,
    'sc_' || (user_id % 5) AS sidecar_id, 'sc_' || (user_id % 5) || '_' || (k % 3) AS sidecar_instance_id,
    'repo_' || (k % 4) AS repo_name, 'q_' || event_id AS query_id,
    {sql_pick(ROLES, 'user_id')} AS executing_role,
    {sql_pick(('PII', 'MONEY'), 'k')} AS policy_tag_name,
    {sql_pick(TAG_VALUES, 'k')} AS policy_tag_value,
    {sql_pick(CATEGORIES, 'k')} AS category
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def audit_events(spark: SparkSession, base: str) -> DataFrame:
    """The audits in the nested shape of sidecar events."""

    def column(name: str) -> str:
        return f"named_struct('database', database_name, 'schema', schema_name, 'table', table_name, 'column', {name})"

    none = "CAST(array() AS ARRAY<STRING>)"
    no_columns = "CAST(array() AS ARRAY<STRUCT<database: STRING, schema: STRING, table: STRING, column: STRING>>)"
    return audits(spark, base).selectExpr(
        "CAST(event_id AS STRING) AS event_id", "'Query' AS event_name", "'sidecar' AS event_source", "event_time",
        "0 AS event_time_nano_seconds", "'1.0' AS event_version", "'org' AS org_id",
        "'track_' || event_id AS tracking_id", "'cfg' AS configuration_version_id", "'pol' AS policy_version_id",
        "named_struct('connection_id', 'conn_' || user_id, 'connection_time', CAST(event_time AS TIMESTAMP), 'host', '10.0.0.' || k, "
        "'port', 5432, 'application_name', 'psql') AS client",
        "named_struct('id', sidecar_id, 'instance_id', sidecar_instance_id, 'version', '1.2.3') AS sidecar",
        "named_struct('host', 'db.example.com', 'name', repo_name, 'port', 5432, 'type', 'Postgres') AS repo",
        "named_struct('repo_user', 'svc', 'consuming_user', named_struct('username', consuming_user, "
        "'email', consuming_user_email, 'user_groups', array(executing_role))) AS user_identity",
        "named_struct('statement', statement_text, 'statement_type', statement_type, "
        "'applied_policy_result', named_struct('block', policy_blocked), "
        f"'applied_policies', {none}, 'scanned_columns', array({column('column_name')}), "
        f"""'projected_columns', CASE WHEN k % 2 = 0 THEN array({column("'out_' || (k % 3)")}) ELSE {no_columns} END, """
        f"'destinations', {none}, 'response', named_struct('success', execution_success, "
        "'execution_time', CAST(CAST(k / 1000 AS DECIMAL(6, 3)) AS STRING) || 's', 'message', '', "
        "'records', row_count, 'bytes', bytes)) AS statement_request",
    )


def audit_lines(spark: SparkSession, base: str) -> DataFrame:
    """The nested events as JSON text, as a log file holds them."""
    e = audit_events(spark, base).withColumn("event_time", F.col("event_time").cast("timestamp"))
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return e.select(F.to_json(F.struct(*[F.col(c) for c in e.columns]), micros).alias("value"))


# ── inventory, findings, decisions ──────────────────────────────────────────

DATA_TYPES = ("varchar", "decimal", "date", "bigint")


def inventory(spark: SparkSession, base: str) -> DataFrame:
    """One protected column per part."""
    return load(spark, base, "part").selectExpr(
        "p_partkey AS column_id", "'db_' || (p_size % 5) AS database_name", "lower(p_brand) AS schema_name",
        "lower(p_type) || '_' || (p_partkey % 50) AS table_name", "'col_' || p_partkey AS column_name",
        f"{spark_pick(DATA_TYPES, 'p_partkey')} AS data_type", "p_size AS column_size", "p_name AS description",
        "CASE WHEN p_partkey % 50 < 5 THEN 'view' ELSE 'table' END AS object_type")


INVENTORY = f"""
inventory AS (
  SELECT p_partkey AS column_id, 'db_' || (p_size % 5) AS database_name, lower(p_brand) AS schema_name,
    lower(p_type) || '_' || (p_partkey % 50) AS table_name, 'col_' || p_partkey AS column_name,
    {sql_pick(DATA_TYPES, 'p_partkey')} AS data_type, p_size AS column_size, p_name AS description,
    CASE WHEN p_partkey % 50 < 5 THEN 'view' ELSE 'table' END AS object_type
  FROM part
)"""


def table_inventory(spark: SparkSession, base: str) -> DataFrame:
    return inventory(spark, base).select("database_name", "schema_name", "table_name", "object_type").distinct()


TABLE_INVENTORY = INVENTORY + """,
tables AS (SELECT DISTINCT database_name, schema_name, table_name, object_type FROM inventory)"""


def assignments(spark: SparkSession, base: str) -> DataFrame:
    """Tags on the inventory's columns; the larger columns have none."""
    return inventory(spark, base).filter("column_size <= 33").selectExpr(
        "column_id", "database_name", "schema_name", "table_name", "column_name",
        f"{spark_pick(('PII', 'Money', 'LEGACY', 'pac_level'), 'column_id')} AS tag_name",
        f"{spark_pick(TAG_VALUES, 'column_id')} AS tag_value")


ASSIGNMENTS = INVENTORY + f""",
assignments AS (
  SELECT column_id, database_name, schema_name, table_name, column_name,
    {sql_pick(('PII', 'Money', 'LEGACY', 'pac_level'), 'column_id')} AS tag_name,
    {sql_pick(TAG_VALUES, 'column_id')} AS tag_value
  FROM inventory WHERE column_size <= 33
)"""


def findings_log(spark: SparkSession, base: str) -> DataFrame:
    """Findings of three jobs: line items say which classifier hit which column."""
    hits = load(spark, base, "lineitem").selectExpr(
        "l_partkey AS column_id", f"{spark_pick(CLASSIFIERS, 'l_suppkey')} AS classifier_name", "l_quantity"
    ).groupBy("column_id", "classifier_name").agg(
        F.expr("count(1) AS matched"), F.expr("CAST(sum(l_quantity) AS BIGINT) AS sampled"))
    return hits.join(inventory(spark, base), "column_id").selectExpr(
        "'job_' || (column_id % 3) AS job_id", "database_name", "schema_name", "table_name", "column_name",
        "classifier_name", "matched * 100.0D / sampled AS score", "sampled", "matched")


FINDINGS = INVENTORY + f""",
findings AS (
  SELECT 'job_' || (column_id % 3) AS job_id, database_name, schema_name, table_name, column_name,
    classifier_name, matched * CAST(100.0 AS DOUBLE) / sampled AS score, sampled, matched
  FROM (SELECT l_partkey, {sql_pick(CLASSIFIERS, 'l_suppkey')} AS classifier_name,
          count(*) AS matched, CAST(sum(l_quantity) AS BIGINT) AS sampled
        FROM lineitem GROUP BY ALL) h
  JOIN inventory ON column_id = l_partkey
)"""


def decisions(spark: SparkSession, base: str) -> DataFrame:
    """Review decisions at all scopes: one per order, about the column of its customer number."""
    depth = """CASE WHEN o_orderkey % 5000 = 17 AND column_id % 3 = 0 THEN 0
      WHEN o_orderkey % 1000 = 7 AND column_id % 3 <= 1 THEN 1 WHEN o_orderkey % 20 = 0 THEN 2
      WHEN o_orderkey % 20 <= 2 THEN 3 WHEN o_orderkey % 20 <= 9 THEN 4 ELSE 5 END"""
    rows = load(spark, base, "orders").join(inventory(spark, base), F.expr("o_custkey = column_id"))
    return rows.selectExpr("*", f"{depth} AS depth").selectExpr(
        "o_orderkey AS decision_id", "'job_' || (column_id % 3) AS job_id",
        *[f"CASE WHEN depth >= {n} THEN {c} END AS {c}"
          for n, c in enumerate(("database_name", "schema_name", "table_name", "column_name"), 1)],
        f"CASE WHEN depth = 5 THEN {spark_pick(CLASSIFIERS, 'o_orderkey')} END AS classifier_name",
        "CASE WHEN o_orderstatus = 'F' THEN 'rejected' ELSE 'approved' END AS confirmed_status",
        "o_orderdate AS decided_at")


DECISIONS = FINDINGS + f""",
decisions AS (
  SELECT o_orderkey AS decision_id, 'job_' || (column_id % 3) AS job_id,
    CASE WHEN depth >= 1 THEN database_name END AS database_name,
    CASE WHEN depth >= 2 THEN schema_name END AS schema_name,
    CASE WHEN depth >= 3 THEN table_name END AS table_name,
    CASE WHEN depth >= 4 THEN column_name END AS column_name,
    CASE WHEN depth = 5 THEN {sql_pick(CLASSIFIERS, 'o_orderkey')} END AS classifier_name,
    CASE WHEN o_orderstatus = 'F' THEN 'rejected' ELSE 'approved' END AS confirmed_status,
    o_orderdate AS decided_at
  FROM (SELECT *, CASE WHEN o_orderkey % 5000 = 17 AND column_id % 3 = 0 THEN 0
                       WHEN o_orderkey % 1000 = 7 AND column_id % 3 <= 1 THEN 1
                       WHEN o_orderkey % 20 = 0 THEN 2 WHEN o_orderkey % 20 <= 2 THEN 3
                       WHEN o_orderkey % 20 <= 9 THEN 4 ELSE 5 END AS depth
        FROM orders JOIN inventory ON o_custkey = column_id)
)"""

# Status by the plain definition: every covering decision, most specific and latest first.
STATUS = DECISIONS + """,
reviewed AS (
  SELECT * FROM (
    SELECT f.*, coalesce(d.confirmed_status, 'pending') AS status,
      row_number() OVER (
        PARTITION BY f.job_id, f.database_name, f.schema_name, f.table_name, f.column_name, f.classifier_name
        ORDER BY (d.database_name IS NOT NULL)::INT + (d.schema_name IS NOT NULL)::INT
          + (d.table_name IS NOT NULL)::INT + (d.column_name IS NOT NULL)::INT
          + (d.classifier_name IS NOT NULL)::INT DESC, d.decided_at DESC, d.decision_id DESC) AS rn
    FROM findings f LEFT JOIN decisions d
      ON d.job_id = f.job_id
     AND (d.database_name IS NULL OR d.database_name = f.database_name)
     AND (d.schema_name IS NULL OR d.schema_name = f.schema_name)
     AND (d.table_name IS NULL OR d.table_name = f.table_name)
     AND (d.column_name IS NULL OR d.column_name = f.column_name)
     AND (d.classifier_name IS NULL OR d.classifier_name = f.classifier_name)
  ) WHERE rn = 1
)"""


# ── telemetry, triggers, reports, requests ──────────────────────────────────


def heartbeats(spark: SparkSession, base: str) -> DataFrame:
    e = load(spark, base, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    return e.selectExpr(
        "event_id", "'i_' || (user_id % 20) AS instance_id", "'a_' || (user_id % 4) AS agent_id",
        "CAST(ts AS TIMESTAMP) AS checkin_time", "k % 7 AS active_tasks", "k % 3 AS idle_tasks",
        "'1.' || (k % 4) AS version")


HEARTBEATS = """
heartbeats AS (
  SELECT event_id, 'i_' || (user_id % 20) AS instance_id, 'a_' || (user_id % 4) AS agent_id,
    ts AS checkin_time, k % 7 AS active_tasks, k % 3 AS idle_tasks, '1.' || (k % 4) AS version
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def triggers(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "events").select(
        text("d_", F.col("user_id") % 20).alias("definition_id"), "ts", "event_id")


def report_instances(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "customer").select(
        text("ri_", F.col("c_custkey")).alias("instance_id"),
        text("def_", F.col("c_nationkey")).alias("definition_id"))


def sign_offs(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").select(
        F.col("o_orderkey").alias("sign_off_id"), text("ri_", F.col("o_custkey")).alias("instance_id"),
        text("u_", F.col("o_orderkey") % 9).alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", "approved").otherwise("rejected").alias("action"),
        (F.col("o_orderkey") % 2 == 0).alias("attestation"), F.col("o_orderdate").alias("signed_at"))


SIGN_OFFS = """
instances AS (SELECT 'ri_' || c_custkey AS instance_id, 'def_' || c_nationkey AS definition_id FROM customer),
sign_offs AS (
  SELECT o_orderkey AS sign_off_id, 'ri_' || o_custkey AS instance_id, 'u_' || (o_orderkey % 9) AS user_id,
    CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'rejected' END AS action,
    o_orderkey % 2 = 0 AS attestation, o_orderdate AS signed_at
  FROM orders
)"""

ACTIONS = (
    "submit", "review", "approve", "review", "submit", "deny", "review", "cancel", "approve", "review",
    "submit", "complete_approve", "complete_deny", "review", "complete_cancel", "close", "fail", "review",
    "complete_approve",
)


def request_events(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").select(
        F.col("o_orderkey").alias("event_id"), text("rq_", F.col("o_custkey")).alias("request_id"),
        pick(ACTIONS, F.col("o_orderkey")).alias("action"), text("r_", F.col("o_custkey")).alias("requester"),
        F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderkey").cast("string")).alias("justification"),
        F.col("o_orderdate").alias("ts"))


REQUEST_EVENTS = f"""
request_events AS (
  SELECT o_orderkey AS event_id, 'rq_' || o_custkey AS request_id, {sql_pick(ACTIONS, 'o_orderkey')} AS action,
    'r_' || o_custkey AS requester, o_orderpriority || ' ' || o_orderkey AS justification, o_orderdate AS ts
  FROM orders
)"""
