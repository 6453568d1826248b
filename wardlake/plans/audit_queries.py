"""Audit events, searches and summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import audits as A
from wardlake.plans import derived as D
from wardlake.plans.registry import query, sql_stamp, stamp
from wardlake.session import scratch_path
from wardlake.sources.audit_log import (
    PG_CSV_COLUMNS, flatten_audit_events, ingest_native_audit_log, normalise_native_log, parse_audit_events, stream_native_log,
)


@query("read_audit_events", f"""
WITH {D.AUDITS}
SELECT CAST(event_id AS VARCHAR) AS event_id, {sql_stamp('event_time')} AS event_time, '10.0.0.' || k AS client_host,
  repo_name, consuming_user, consuming_user_email, statement_text, policy_blocked, execution_success,
  CAST(CAST(k / CAST(1000 AS DOUBLE) AS DECIMAL(6, 3)) AS DOUBLE) AS execution_seconds, row_count, bytes,
  CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS projected
FROM audits""")
def read_audit_events(spark: SparkSession, base: str) -> DataFrame:
    """JSON lines parsed with the declared schema, then flattened."""
    flat = flatten_audit_events(parse_audit_events(D.audit_lines(spark, base)))
    return flat.select(
        "event_id", stamp("event_time").alias("event_time"), "client_host", "repo_name", "consuming_user",
        "consuming_user_email", "statement_text", "policy_blocked", "execution_success", "execution_seconds",
        "row_count", "bytes", F.size("projected_columns").alias("projected"))


@query("ingest_postgres_log", f"""
WITH {D.AUDITS}
SELECT {sql_stamp("date_trunc('second', event_time)")} AS event_time, consuming_user AS repo_user,
  'tpch' AS database_name, CASE WHEN execution_success THEN 'select ' || event_id || ' from ' || table_name END AS statement_text,
  CASE WHEN execution_success THEN 'SELECT' END AS statement_type, execution_success
FROM audits WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_type <> 'purchase'""")
def ingest_postgres_log(spark: SparkSession, base: str) -> DataFrame:
    """Log lines with a configured prefix; purchases are noise."""
    message = F.when(
        F.col("execution_success"), F.concat(F.lit("LOG:  statement: select "), F.col("event_id").cast("string"),
                                             F.lit(" from "), F.col("table_name"))
    ).otherwise(F.lit("ERROR:  permission denied"))
    prefix = F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC [77] "),
                      F.col("consuming_user"), F.lit("@tpch "))
    lines = D.audits(spark, base).select(
        F.when(F.col("event_type") == "purchase", F.lit("checkpoint complete")).otherwise(F.concat(prefix, message)).alias("value"))
    out = normalise_native_log(lines, "postgresql", "log", "%t [%p] %u@%d ",
                               F.lit("2024-01-10 00:00:00").cast("timestamp"))
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "database_name", "statement_text",
                      "statement_type", "execution_success")


def _log_file(lines: DataFrame, order: str, name: str) -> str:
    """Text files with the lines in order."""
    path = scratch_path(lines.sparkSession, name)
    lines.repartitionByRange(order).sortWithinPartitions(order).select("value").write.text(path)
    return path


@query("ingest_postgres_multiline", f"""
WITH {D.AUDITS}
SELECT {sql_stamp("date_trunc('second', event_time)")} AS event_time, consuming_user AS repo_user,
  'select ' || event_id || ',' || chr(10) || '  "LOG: x"' || chr(10) || chr(10) || 'from ' || table_name AS statement_text,
  'SELECT' AS statement_type FROM audits""")
def ingest_postgres_multiline(spark: SparkSession, base: str) -> DataFrame:
    """Statements over four lines, one of them empty, read from files."""
    lines = D.audits(spark, base).select("event_id", F.concat(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC [77] "), F.col("consuming_user"),
        F.lit("@tpch LOG:  statement: select "), F.col("event_id").cast("string"), F.lit(',\n  "LOG: x"\n\nfrom '),
        F.col("table_name")).alias("value"))
    out = ingest_native_audit_log(spark, _log_file(lines, "event_id", "pg-log"), "postgresql", "log", "%t [%p] %u@%d ")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "statement_text", "statement_type")


@query("stream_postgres_log", f"""
WITH {D.AUDITS}
SELECT {sql_stamp("date_trunc('second', event_time)")} AS event_time, consuming_user AS repo_user,
  'select ' || event_id || ',' || chr(10) || '  "LOG: x"' || chr(10) || chr(10) || 'from ' || table_name AS statement_text,
  'SELECT' AS statement_type FROM audits""")
def stream_postgres_log(spark: SparkSession, base: str) -> DataFrame:
    """Statements over four lines in files that arrive in two parts."""
    rows = D.audits(spark, base)
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("pg-inbox", "pg-stream", "cp"))
    for part in range(2):
        lines = rows.where(F.col("event_id") % 2 == part).select("event_id", F.concat(
            F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC [77] "), F.col("consuming_user"),
            F.lit("@tpch LOG:  statement: select "), F.col("event_id").cast("string"), F.lit(',\n  "LOG: x"\n\nfrom '),
            F.col("table_name")).alias("value"))
        lines.repartitionByRange("event_id").sortWithinPartitions("event_id").select("value").write.mode("append").text(inbox)
        stream_native_log(spark, inbox, "postgresql", "log", out, checkpoint, "%t [%p] %u@%d ").awaitTermination()
    return spark.read.parquet(out).select(stamp("event_time").alias("event_time"), "repo_user", "statement_text", "statement_type")


@query("ingest_postgres_csv", f"""
WITH {D.AUDITS}
SELECT {sql_stamp('event_time')} AS event_time, consuming_user AS repo_user, database_name, '10.0.0.' || k AS client_host,
  'select "' || event_id || '",' || chr(10) || 'x from ' || table_name AS statement_text, 'SELECT' AS statement_type, execution_success FROM audits""")
def ingest_postgres_csv(spark: SparkSession, base: str) -> DataFrame:
    """The csv log: quoted statements over two lines, failed ones in the query column."""
    ok, statement = F.col("execution_success"), D.text('select "', F.col("event_id"), '",\nx from ', F.col("table_name"))
    values = {
        "log_time": stamp("event_time"), "user_name": F.col("consuming_user"), "database_name": F.col("database_name"),
        "connection_from": D.text("10.0.0.", F.col("k"), ":5432"), "error_severity": F.when(ok, "LOG").otherwise("ERROR"),
        "message": F.when(ok, F.concat(F.lit("statement: "), statement)).otherwise("permission denied"), "query": F.when(~ok, statement)}
    none = F.lit(None).cast("string")
    path = scratch_path(spark, "pg-csv")
    D.audits(spark, base).select(*[values.get(c, none).alias(c) for c in PG_CSV_COLUMNS]).write.option("escape", '"').csv(path)
    out = ingest_native_audit_log(spark, path, "postgresql", "csv")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "database_name", "client_host", "statement_text",
                      "statement_type", "execution_success")


@query("ingest_postgres_json", f"""
WITH {D.AUDITS}
SELECT {sql_stamp('event_time')} AS event_time, consuming_user AS repo_user, database_name, '10.0.0.' || k AS client_host,
  'select ' || event_id || chr(10) || 'from ' || table_name AS statement_text, execution_success FROM audits""")
def ingest_postgres_json(spark: SparkSession, base: str) -> DataFrame:
    """The json log: a record a line, whatever line breaks its statement has."""
    ok, statement = F.col("execution_success"), D.text("select ", F.col("event_id"), "\nfrom ", F.col("table_name"))
    record = F.to_json(F.struct(
        stamp("event_time").alias("timestamp"), F.col("consuming_user").alias("user"), F.col("database_name").alias("dbname"),
        D.text("10.0.0.", F.col("k")).alias("remote_host"), F.when(ok, "LOG").otherwise("ERROR").alias("error_severity"),
        F.when(ok, F.concat(F.lit("statement: "), statement)).otherwise("permission denied").alias("message"),
        F.when(~ok, statement).alias("statement")))
    path = scratch_path(spark, "pg-json")
    D.audits(spark, base).select(record.alias("value")).write.text(path)
    out = ingest_native_audit_log(spark, path, "postgresql", "json")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "database_name", "client_host", "statement_text", "execution_success")


@query("ingest_mysql_log", f"""
WITH {D.AUDITS}
SELECT {sql_stamp('event_time')} AS event_time, consuming_user AS repo_user, 'db' AS client_host,
  'select ' || event_id || chr(10) || 'from ' || table_name AS statement_text FROM audits""")
def ingest_mysql_log(spark: SparkSession, base: str) -> DataFrame:
    """Two records of a thread: who connected, and a statement of two lines without a name."""
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    thread = F.col("event_id").cast("string")
    lines = D.audits(spark, base).select("event_id", F.concat(
        at, F.lit("\t"), thread, F.lit(" Connect\t"), F.col("consuming_user"), F.lit("@db on tpch using TCP/IP\n"),
        at, F.lit("\t"), thread, F.lit(" Query\tselect "), thread, F.lit("\nfrom "), F.col("table_name")).alias("value"))
    out = ingest_native_audit_log(spark, _log_file(lines, "event_id", "mysql-log"), "mysql", "log")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "client_host", "statement_text")


@query("ingest_mysql_table", f"""
WITH {D.AUDITS}
SELECT {sql_stamp('event_time')} AS event_time, consuming_user AS repo_user, '10.0.0.' || k AS client_host, statement_text
FROM audits WHERE event_type <> 'click'""")
def ingest_mysql_table(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).select(
        stamp("event_time").alias("event_time"),
        F.concat(F.col("consuming_user"), F.lit("["), F.col("consuming_user"), F.lit("] @ 10.0.0."),
                 F.col("k").cast("string"), F.lit(" []")).alias("user_host"),
        F.lit("1").alias("thread_id"), F.lit("1").alias("server_id"),
        F.when(F.col("event_type") == "click", "Connect").otherwise("Query").alias("command_type"),
        F.col("statement_text").alias("argument"))
    out = normalise_native_log(rows, "mysql", "table")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "client_host", "statement_text")


@query("ingest_oracle_table", f"""
WITH {D.AUDITS}
SELECT {sql_stamp('event_time')} AS event_time, consuming_user AS repo_user, statement_text, execution_success FROM audits""")
def ingest_oracle_table(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).select(
        stamp("event_time").alias("EVENT_TIMESTAMP"), F.col("consuming_user").alias("DBUSERNAME"),
        F.lit("host").alias("USERHOST"), F.lit("sqlplus").alias("CLIENT_PROGRAM_NAME"), F.lit("TPCH").alias("DBNAME"),
        F.col("statement_type").alias("ACTION_NAME"), F.col("statement_text").alias("SQL_TEXT"),
        F.when(F.col("execution_success"), "0").otherwise("942").alias("RETURN_CODE"))
    out = normalise_native_log(rows, "oracle", "table")
    return out.select(stamp("event_time").alias("event_time"), "repo_user", "statement_text", "execution_success")


_SLICE = """SELECT CAST(event_id AS VARCHAR) AS event_id, {t} AS event_time, consuming_user, row_count AS rows_accessed FROM (
  SELECT * FROM audits WHERE {where} {slice})"""


def _flat_slice(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", stamp("event_time").alias("event_time"),
                       F.col("user_identity.consuming_user.username").alias("consuming_user"), "rows_accessed")


@query("search_audits_top", f"WITH {D.AUDITS} " + _SLICE.format(
    t=sql_stamp("event_time"), slice="",
    where="event_time >= TIMESTAMP '2024-01-05' AND event_time <= TIMESTAMP '2024-01-25' "
          "AND lower(consuming_user) IN ('user_7', 'user_12', 'user_40') AND statement_type IN ('VIEW', 'CLICK', 'PURCHASE')"))
def search_audits_top(spark: SparkSession, base: str) -> DataFrame:
    return _flat_slice(A.search_audits(
        D.audit_events(spark, base), from_date_time=dt.datetime(2024, 1, 5), to_date_time=dt.datetime(2024, 1, 25),
        consuming_user=["User_7", "USER_12", "user_40"], statement_type=["VIEW", "CLICK", "PURCHASE"],
        sort_by="rows_accessed"))


@query("search_audits_columns", f"WITH {D.AUDITS} " + _SLICE.format(
    t=sql_stamp("event_time"), slice="ORDER BY event_time, CAST(event_id AS VARCHAR) LIMIT 500",
    where="(column_name IN ('col_3', 'out_1') OR (k % 2 = 0 AND 'out_' || (k % 3) IN ('col_3', 'out_1'))) "
          "AND table_name IN ('orders', 'part') AND sidecar_id = 'sc_2' AND contains(lower(statement_text), 'view')"))
def search_audits_columns(spark: SparkSession, base: str) -> DataFrame:
    return _flat_slice(A.search_audits(
        D.audit_events(spark, base), column_name=["col_3", "out_1"], table_name=["orders", "part"], sidecar_id="sc_2",
        statement_text_contains="VIEW", order_by="asc", limit=500))


@query("search_audits_all", f"WITH {D.AUDITS} " + _SLICE.format(t=sql_stamp("event_time"), slice="", where="true"))
def search_audits_all(spark: SparkSession, base: str) -> DataFrame:
    """No filter and no limit: every audit comes back."""
    return _flat_slice(A.search_audits(D.audit_events(spark, base)))


@query("search_query_audits", f"""
WITH {D.AUDITS}
SELECT query_id, {sql_stamp('event_time')} AS event_time, executing_user, policy_tag_value, rows_accessed FROM (
  SELECT query_id, event_time, consuming_user AS executing_user, policy_tag_value, row_count AS rows_accessed
  FROM audits WHERE executing_role = 'ANALYST' AND policy_tag_name = 'PII' AND table_name = 'orders')""")
def search_query_audits(spark: SparkSession, base: str) -> DataFrame:
    a = D.audits(spark, base).selectExpr(
        "query_id", "event_time", "executing_role", "consuming_user AS executing_user", "policy_tag_name",
        "policy_tag_value", "database_name AS policy_column_database_name", "schema_name AS policy_column_schema_name",
        "table_name AS policy_column_table_name", "column_name AS policy_column_name", "row_count AS rows_accessed")
    out = A.search_query_audits(a, executing_role="analyst", policy_tag_name="pii", policy_column_table_name="ORDERS",
                                to_date_time=dt.datetime(2024, 2, 1))
    return out.select("query_id", stamp("event_time").alias("event_time"), "executing_user", "policy_tag_value",
                      "rows_accessed")


@query("search_system_audits", f"""
WITH {D.AUDITS}
SELECT event_id, category, {sql_stamp('event_time')} AS event_time FROM (
  SELECT * FROM audits WHERE category = 'Thresholds')""")
def search_system_audits(spark: SparkSession, base: str) -> DataFrame:
    rows = A.search_system_audits(D.audits(spark, base), "Thresholds")
    return rows.select("event_id", "category", stamp("event_time").alias("event_time"))


@query("saved_search_page", f"""
WITH {D.AUDITS}
SELECT row_no, event_id, row_count FROM (
  SELECT row_number() OVER (ORDER BY event_time DESC, event_id DESC) AS row_no, event_id, row_count FROM audits
  WHERE statement_type = 'ERROR') WHERE row_no > 250 AND row_no <= 500""")
def saved_search_page(spark: SparkSession, base: str) -> DataFrame:
    """A result is kept in its order; the second page of 250 is read back."""
    root = scratch_path(spark, "searches")
    found = D.audits(spark, base).filter("statement_type = 'ERROR'").select("event_id", "event_time", "row_count")
    A.save_search(found, "s-1", root, dt.date(2024, 2, 1))
    page = A.read_search(spark, root, "s-1", dt.date(2024, 2, 20), token=250)
    return page.select(F.col("row_no").cast("long").alias("row_no"), "event_id", "row_count")


@query("explode_audit_columns", f"""
WITH {D.AUDITS}
SELECT CAST(event_id AS VARCHAR) AS event_id, consuming_user, 'scanned' AS usage, database_name, schema_name, table_name, column_name FROM audits
UNION ALL
SELECT CAST(event_id AS VARCHAR), consuming_user, 'projected', database_name, schema_name, table_name, 'out_' || (k % 3) FROM audits WHERE k % 2 = 0""")
def explode_audit_columns(spark: SparkSession, base: str) -> DataFrame:
    return A.explode_audit_columns(D.audit_events(spark, base)).drop("event_time")


@query("who_touched_column", f"""
WITH {D.AUDITS}
SELECT table_name, column_name, count(DISTINCT consuming_user) AS users, count(*) AS touches FROM audits GROUP BY ALL""")
def who_touched_column(spark: SparkSession, base: str) -> DataFrame:
    """Users per scanned column, first reduced to one row per column and user."""
    touched = A.explode_audit_columns(D.audit_events(spark, base)).filter("usage = 'scanned'")
    per_user = touched.groupBy("table_name", "column_name", "consuming_user").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("table_name", "column_name").agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("touches"))


_MEASURES = """count(*) AS statements, CAST(sum(row_count) AS BIGINT) AS rows_accessed, CAST(sum(bytes) AS BIGINT) AS bytes,
  count_if(NOT execution_success) AS failures, count_if(policy_blocked) AS blocks"""


@query("audit_summary", f"""
WITH {D.AUDITS}
SELECT consuming_user, strftime(event_time, '%Y-%m-%d') AS day, {_MEASURES} FROM audits GROUP BY ALL""")
def audit_summary(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    return A.audit_summary(rows, ["consuming_user", "day"])


@query("audit_summary_cube", f"""
WITH {D.AUDITS}, a AS (SELECT *, strftime(event_time, '%Y-%m-%d') AS day FROM audits)
SELECT consuming_user, table_name, statement_type, day,
  CAST(grouping(consuming_user, table_name, statement_type, day) AS BIGINT) AS gid, {_MEASURES}
FROM a GROUP BY GROUPING SETS ((consuming_user), (table_name), (statement_type), (day), ())""")
def audit_summary_cube(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    out = A.audit_summary_sets(rows, ["consuming_user", "table_name", "statement_type", "day"])
    return out.withColumn("gid", F.col("gid").cast("long"))


@query("policy_block_rate", f"""
WITH {D.AUDITS}
SELECT table_name, count(*) AS statements, count_if(policy_blocked) AS blocked, count_if(NOT execution_success) AS failed,
  count_if(policy_blocked) / CAST(count(*) AS DOUBLE) AS block_rate, count_if(NOT execution_success) / CAST(count(*) AS DOUBLE) AS failure_rate
FROM audits GROUP BY table_name""")
def policy_block_rate(spark: SparkSession, base: str) -> DataFrame:
    return A.policy_block_rate(D.audits(spark, base), "table_name")
