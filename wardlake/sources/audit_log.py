"""Sidecar audit events and native database audit logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wardlake.sources.log_records import text_lines, whole_records

# The shape of a sidecar audit event.
_COLUMN = "struct<database:string,schema:string,table:string,column:string>"
EVENT_DDL = (
    "event_id string, event_name string, event_source string, event_time timestamp, "
    "event_time_nano_seconds int, event_version string, org_id string, tracking_id string, "
    "configuration_version_id string, policy_version_id string, "
    "client struct<connection_id:string,connection_time:timestamp,host:string,port:int,"
    "application_name:string>, "
    "sidecar struct<id:string,instance_id:string,version:string>, "
    "repo struct<host:string,name:string,port:int,type:string>, "
    "user_identity struct<repo_user:string,consuming_user:struct<username:string,email:string,"
    "user_groups:array<string>>>, "
    "statement_request struct<statement:string,statement_type:string,"
    "applied_policy_result:struct<block:boolean>,applied_policies:array<string>,"
    f"scanned_columns:array<{_COLUMN}>,projected_columns:array<{_COLUMN}>,"
    "destinations:array<string>,"
    "response:struct<success:boolean,execution_time:string,message:string,records:bigint,"
    "bytes:bigint>>"
)


def read_audit_events(spark: SparkSession, path: str) -> DataFrame:
    """Nested audit events from JSON lines, with the declared schema."""
    return spark.read.schema(EVENT_DDL).json(path)


def parse_audit_events(lines: DataFrame, json_column: str = "value") -> DataFrame:
    """Nested audit events from a column of JSON text (batch or stream)."""
    return lines.select(F.from_json(json_column, EVENT_DDL).alias("e")).select("e.*")


def seconds(duration: Column) -> Column:
    """``"0.023s"`` to 0.023."""
    return F.regexp_replace(duration, "s$", "").try_cast("double")


def flatten_audit_events(events: DataFrame) -> DataFrame:
    """Flat view of audit events for filters, reports and summaries."""
    request, user = F.col("statement_request"), F.col("user_identity")
    return events.select(
        "event_id", "event_name", "event_source", "event_time", "event_time_nano_seconds",
        F.col("client.connection_id").alias("connection_id"),
        F.col("client.host").alias("client_host"),
        F.col("client.application_name").alias("application_name"),
        F.col("sidecar.id").alias("sidecar_id"),
        F.col("sidecar.instance_id").alias("sidecar_instance_id"),
        F.col("repo.host").alias("repo_host"),
        F.col("repo.name").alias("repo_name"),
        F.col("repo.type").alias("repo_type"),
        user["repo_user"].alias("repo_user"),
        user["consuming_user"]["username"].alias("consuming_user"),
        user["consuming_user"]["email"].alias("consuming_user_email"),
        request["statement"].alias("statement_text"),
        request["statement_type"].alias("statement_type"),
        request["applied_policy_result"]["block"].alias("policy_blocked"),
        request["response"]["success"].alias("execution_success"),
        seconds(request["response"]["execution_time"]).alias("execution_seconds"),
        request["response"]["records"].alias("row_count"),
        request["response"]["bytes"].alias("bytes"),
        request["scanned_columns"].alias("scanned_columns"),
        request["projected_columns"].alias("projected_columns"),
    )


# ── native logs ─────────────────────────────────────────────────────────────

# Escapes of the PostgreSQL log_line_prefix setting that we read.
_PREFIX_ESCAPES = {
    "t": ("log_time", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} \S+"),
    "m": ("log_time", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+ \S+"),
    "u": ("user_name", r"[^ @:,|\]]*"),
    "d": ("database_name", r"[^ @:,|\]]*"),
    "a": ("application_name", r"[^|@,\]]*?"),
    "h": ("client_host", r"[^ :,|\](]*"),
    "r": ("client_host", r"[^ ,|\]]*"),
    "p": ("process_id", r"\d+"),
    "c": ("session_id", r"[0-9a-f.]+"),
    "l": ("line_number", r"\d+"),
    "e": ("sqlstate", r"[0-9A-Z]{5}"),
    "x": ("transaction_id", r"\d+"),
    "i": ("command_tag", r"[A-Z ]*"),
    "v": ("virtual_id", r"[^ ]*"),
    "q": (None, ""),
    "%": (None, "%"),
}


def prefix_pattern(log_line_prefix: str) -> tuple[str, dict[str, int]]:
    """Regex for a PostgreSQL log line and the group number of each field."""
    groups: dict[str, int] = {}
    groups_seen: list[str] = []
    pattern, at = "^", 0
    while at < len(log_line_prefix):
        char = log_line_prefix[at]
        if char == "%" and at + 1 < len(log_line_prefix):
            escape = log_line_prefix[at + 1]
            if escape not in _PREFIX_ESCAPES:
                raise ValueError(f"log_line_prefix escape %{escape} is not supported")
            name, part = _PREFIX_ESCAPES[escape]
            if name is None:
                pattern += part
            else:
                pattern += f"({part})"
                groups_seen.append(name)
                groups.setdefault(name, len(groups_seen))
            at += 2
            continue
        pattern += re.escape(char) if not char.isspace() else r"\s"
        at += 1
    base = len(groups_seen)
    groups["severity"], groups["message"] = base + 1, base + 2
    return pattern + r"\s*([A-Z]+):\s+([\s\S]*)$", groups


def _statement(message: Column) -> Column:
    return F.trim(F.regexp_extract(message, r"(?i)(?:statement|execute [^:]*): ([\s\S]*)$", 1))


def _common(df: DataFrame, *, event_time: Column, user: Column, database: Column, host: Column,
            application: Column, statement: Column, success: Column, message: Column,
            source: str) -> DataFrame:
    """One shape for every native log: the flat names of the sidecar view."""
    text = F.nullif(statement, F.lit(""))
    return df.select(
        event_time.alias("event_time"),
        F.lit(source).alias("event_source"),
        F.nullif(user, F.lit("")).alias("repo_user"),
        F.nullif(database, F.lit("")).alias("database_name"),
        F.nullif(host, F.lit("")).alias("client_host"),
        F.nullif(application, F.lit("")).alias("application_name"),
        text.alias("statement_text"),
        F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1)).alias("statement_type"),
        success.alias("execution_success"),
        message.alias("message"),
    )


def _blank() -> Column:
    return F.lit(None).cast("string")


def parse_postgres_log(lines: DataFrame, log_line_prefix: str, column: str = "value") -> DataFrame:
    """Text log lines: statements (``LOG``) and failures (``ERROR``, ``FATAL``).

    One regex run splits a line into all its fields. The fields come out of an
    ``explode`` of at most one element, because a filter on them would be pushed
    down and run the regex again for each of its conditions.
    """
    pattern, groups = prefix_pattern(log_line_prefix)
    count, mark = groups["message"], "\u0001"
    marked = F.regexp_replace(column, pattern, "".join(f"{mark}${i}" for i in range(1, count + 1)))
    whole = F.filter(F.array(F.split(marked, mark, count + 1)),
                     lambda f: (F.size(f) == count + 1) & (F.get(f, F.lit(0)) == ""))
    fields = lines.select(F.explode(whole).alias("f"))

    def part(name: str) -> Column:
        return F.get("f", groups[name]) if name in groups else _blank()

    severity, message = part("severity"), part("message")
    out = _common(
        fields, event_time=F.try_to_timestamp(part("log_time")), user=part("user_name"),
        database=part("database_name"), host=part("client_host"),
        application=part("application_name"), statement=_statement(message),
        success=~severity.isin("ERROR", "FATAL", "PANIC"), message=message, source="postgresql",
    )
    return out.filter(F.col("statement_text").isNotNull() | ~F.col("execution_success"))


# Column order of the PostgreSQL csv log.
PG_CSV_COLUMNS = (
    "log_time", "user_name", "database_name", "process_id", "connection_from", "session_id",
    "session_line_num", "command_tag", "session_start_time", "virtual_transaction_id",
    "transaction_id", "error_severity", "sql_state_code", "message", "detail", "hint",
    "internal_query", "internal_query_pos", "context", "query", "query_pos", "location",
    "application_name", "backend_type", "leader_pid", "query_id",
)
PG_JSON_DDL = (
    "timestamp string, user string, dbname string, pid int, remote_host string, session_id string,"
    " ps string, error_severity string, message string, statement string, application_name string"
)
MYSQL_TABLE_COLUMNS = ("event_time", "user_host", "thread_id", "server_id", "command_type", "argument")
ORACLE_COLUMNS = ("EVENT_TIMESTAMP", "DBUSERNAME", "USERHOST", "CLIENT_PROGRAM_NAME", "DBNAME",
                  "ACTION_NAME", "SQL_TEXT", "RETURN_CODE")


def _postgres_csv(df: DataFrame) -> DataFrame:
    severity, message = F.col("error_severity"), F.col("message")
    statement = F.coalesce(F.nullif(_statement(message), F.lit("")), F.col("query"))
    return _common(
        df, event_time=F.try_to_timestamp("log_time"), user=F.col("user_name"),
        database=F.col("database_name"), host=F.split_part("connection_from", F.lit(":"), F.lit(1)),
        application=F.col("application_name"), statement=statement,
        success=~severity.isin("ERROR", "FATAL", "PANIC"), message=message, source="postgresql")


def _postgres_json(df: DataFrame) -> DataFrame:
    message = F.col("message")
    statement = F.coalesce(F.nullif(_statement(message), F.lit("")), F.col("statement"))
    return _common(
        df, event_time=F.try_to_timestamp("timestamp"), user=F.col("user"), database=F.col("dbname"),
        host=F.col("remote_host"), application=F.col("application_name"), statement=statement,
        success=~F.col("error_severity").isin("ERROR", "FATAL", "PANIC"), message=message,
        source="postgresql")


def _mysql(df: DataFrame) -> DataFrame:
    """Rows of the general log, from its table or from tab-separated lines."""
    who = F.col("user_host")
    return _common(
        df.filter(F.col("command_type").isin("Query", "Execute")),
        event_time=F.try_to_timestamp(F.col("event_time").cast("string")),
        user=F.regexp_extract(who, r"^([^\[@]*)", 1), database=_blank(),
        host=F.regexp_extract(who, r"@ ?([^ \[]*)", 1), application=_blank(),
        statement=F.col("argument").cast("string"), success=F.lit(True), message=_blank(),
        source="mysql")


_MYSQL_LINE = r"^(\S+)\s+(\d+)\s+([A-Z][a-z]+)\t([\s\S]*)$"


def _mysql_lines(df: DataFrame, column: str = "value") -> DataFrame:
    def part(i: int) -> Column:
        return F.regexp_extract(column, _MYSQL_LINE, i)

    who = F.regexp_replace(F.coalesce("who", F.lit("")), "@", "@ ") if "who" in df.columns else F.lit("")
    rows = df.filter(F.col(column).rlike(_MYSQL_LINE)).select(
        part(1).alias("event_time"), who.alias("user_host"), part(2).alias("thread_id"),
        part(3).alias("command_type"), part(4).alias("argument"))
    return _mysql(rows)


def _oracle(df: DataFrame) -> DataFrame:
    """Rows of the unified audit trail."""
    statement = F.coalesce(F.col("SQL_TEXT"), F.col("ACTION_NAME"))
    return _common(
        df, event_time=F.try_to_timestamp(F.col("EVENT_TIMESTAMP").cast("string")),
        user=F.col("DBUSERNAME"), database=F.col("DBNAME"), host=F.col("USERHOST"),
        application=F.col("CLIENT_PROGRAM_NAME"), statement=statement,
        success=F.col("RETURN_CODE").cast("int") == 0, message=_blank(), source="oracle")


def normalise_native_log(df: DataFrame, db_type: str, file_type: str = "log",
                         log_line_prefix: str = "%m [%p] ",
                         initial_ts: Column | None = None) -> DataFrame:
    """Native rows or lines to the common shape, from ``initial_ts`` on."""
    kind = (db_type.lower(), file_type.lower())
    if kind == ("postgresql", "log"):
        out = parse_postgres_log(df, log_line_prefix)
    elif kind == ("postgresql", "csv"):
        out = _postgres_csv(df)
    elif kind == ("postgresql", "json"):
        out = _postgres_json(df)
    elif kind == ("mysql", "table"):
        out = _mysql(df)
    elif kind == ("mysql", "log"):
        out = _mysql_lines(df)
    elif kind == ("oracle", "table"):
        out = _oracle(df)
    else:
        raise ValueError(f"no native log reader for {db_type} {file_type}")
    return out if initial_ts is None else out.filter(F.col("event_time") >= initial_ts)


def _record_start(db_type: str, file_type: str, log_line_prefix: str) -> tuple | None:
    """How records of a line-based log begin, and where it names threads; None for other files."""
    return {("postgresql", "log"): (prefix_pattern(log_line_prefix)[0], None),
            ("mysql", "log"): (_MYSQL_LINE, (2, 3, 4))}.get((db_type.lower(), file_type.lower()))


def ingest_native_audit_log(spark: SparkSession, path: str, db_type: str, file_type: str,
                            log_line_prefix: str = "%m [%p] ", initial_ts: Column | None = None,
                            stream: bool = False) -> DataFrame:
    """Read native audit files, in batch or, where a row is a record, as a file stream.

    Statements of several lines are put together; in a MySQL file log the user of a
    thread is the one who connected. Streams of such logs need ``stream_native_log``.
    """
    reader = spark.readStream if stream else spark.read
    kind = (db_type.lower(), file_type.lower())
    records = _record_start(db_type, file_type, log_line_prefix)
    if records is not None:
        if stream:
            raise ValueError("records of several lines are put together by micro-batch: use stream_native_log")
        raw = whole_records(text_lines(reader, path), *records)
    elif kind == ("postgresql", "csv"):
        ddl = ", ".join(f"{c} string" for c in PG_CSV_COLUMNS)
        raw = reader.schema(ddl).option("multiLine", True).option("escape", '"').csv(path)
    elif kind == ("postgresql", "json"):
        raw = reader.schema(PG_JSON_DDL).json(path)
    elif kind[1] == "table":
        names = MYSQL_TABLE_COLUMNS if kind[0] == "mysql" else ORACLE_COLUMNS
        raw = reader.schema(", ".join(f"{c} string" for c in names)).option("header", True).csv(path)
    else:
        raw = reader.text(path)
    return normalise_native_log(raw, db_type, file_type, log_line_prefix, initial_ts)


def stream_native_log(spark: SparkSession, path: str, db_type: str, file_type: str, out: str, checkpoint: str,
                      log_line_prefix: str = "%m [%p] ", initial_ts: Column | None = None) -> StreamingQuery:
    """Native audit files as they arrive, in the common shape below ``out``, a folder for each micro-batch.

    A file arrives whole in one micro-batch, however many blocks it has, so its records
    and the users of its threads are put together as in batch: pieces at the borders of
    blocks are joined, none is lost. A repeated batch overwrites its folder.
    """
    records = _record_start(db_type, file_type, log_line_prefix)
    if records is None:
        rows = ingest_native_audit_log(spark, path, db_type, file_type, log_line_prefix, initial_ts, stream=True)
    else:
        rows = text_lines(spark.readStream, path)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if records is not None:
            whole = whole_records(batch, *records)
            batch = normalise_native_log(whole, db_type, file_type, log_line_prefix, initial_ts)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return rows.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
