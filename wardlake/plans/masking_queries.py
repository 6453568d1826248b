"""Masking levels, policies and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wardlake.functions import masks
from wardlake.functions.detectors import EMAIL
from wardlake.operators import masking as M
from wardlake.operators import thresholds as TH
from wardlake.plans import derived as D
from wardlake.plans.registry import query, sql_stamp, stamp

RULES = M.mask_rules([
    {"role": "ANALYST", "tag_value": "PII_NAME", "masking_policy": 10001},
    {"role": "ANALYST", "tag_value": "SEGMENT", "masking_policy": 10006},
    {"role": "ANALYST", "tag_value": "MONEY", "masking_policy": 10004},
    {"role": "ANALYST", "tag_value": "KEY", "masking_policy": 10000},
    {"role": "ADMIN", "tag_value": "PII_NAME", "masking_policy": 10000},
    {"role": "ADMIN", "tag_value": "SEGMENT", "masking_policy": 10000},
    {"role": "ADMIN", "tag_value": "MONEY", "masking_policy": 10000},
    {"role": "ADMIN", "tag_value": "KEY", "masking_policy": 10000},
    {"role": "PUBLIC", "tag_value": "PII_NAME", "masking_policy": 10003},
    {"role": "PUBLIC", "tag_value": "SEGMENT", "masking_policy": 10008},
])
CUSTOMER_TAGS = {"c_name": "PII_NAME", "c_mktsegment": "SEGMENT", "c_acctbal": "MONEY", "c_custkey": "KEY"}


@query("mask_customer_analyst", """
SELECT c_custkey, repeat('*', length(c_name)) AS c_name, c_nationkey, CAST(1 AS DOUBLE) AS c_acctbal,
  sha256(c_mktsegment) AS c_mktsegment
FROM customer""")
def mask_customer_analyst(spark: SparkSession, base: str) -> DataFrame:
    return M.apply_masking(D.load(spark, base, "customer"), CUSTOMER_TAGS, RULES, "ANALYST")


@query("mask_customer_public", """
SELECT CAST(NULL AS BIGINT) AS c_custkey,
  regexp_replace(left(c_name, length(c_name) - 4), '[A-Za-z0-9]', '*', 'g') || right(c_name, 4) AS c_name,
  c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
  sha256(left(c_mktsegment, length(c_mktsegment) - 4)) || right(c_mktsegment, 4) AS c_mktsegment
FROM customer""")
def mask_customer_public(spark: SparkSession, base: str) -> DataFrame:
    return M.apply_masking(D.load(spark, base, "customer"), CUSTOMER_TAGS, RULES, "PUBLIC")


_EMAIL = EMAIL


def _level_query(level: int, name: str, email_sql: str, segment_sql: str, date_sql: str, key_sql: str) -> None:
    """One masking level on an e-mail, a text, a timestamp and a number."""
    sql = f"""
WITH v AS (SELECT event_id, 'user_' || user_id || CASE WHEN user_id % 7 = 0 THEN '' ELSE '@example.com' END AS email,
             right(event_type, 1 + user_id % 6) AS word, ts, user_id AS num FROM events)
SELECT event_id, {email_sql} AS email, {segment_sql} AS word, {date_sql} AS day, {key_sql} AS num FROM v"""

    def run(spark: SparkSession, base: str) -> DataFrame:
        user = F.col("user_id")
        v = D.load(spark, base, "events").select(
            "event_id",
            F.concat(D.text("user_", user), F.when(user % 7 == 0, "").otherwise("@example.com")).alias("email"),
            F.right("event_type", (1 + user % 6).cast("int")).alias("word"), F.col("ts").alias("day"),
            user.alias("num"))
        out = M.project_levels(v, {c: level for c in ("email", "word", "day", "num")})
        if isinstance(out.schema["day"].dataType, T.TimestampNTZType):
            out = out.withColumn("day", stamp("day"))
        return out

    query(name, sql)(run)


# A timestamp as Spark prints it when cast to text: no trailing zeros of the fraction.
_TS_TEXT = "CAST(ts AS VARCHAR)"


def _stars(c: str) -> str:
    return f"repeat('*', length({c}))"


def _last4(c: str) -> str:
    return (f"CASE WHEN length({c}) <= 4 THEN {_stars(c)} ELSE "
            f"regexp_replace(left({c}, length({c}) - 4), '[A-Za-z0-9]', '*', 'g') || right({c}, 4) END")


def _last4_hash(c: str) -> str:
    return (f"CASE WHEN length({c}) <= 4 THEN sha256({c}) ELSE "
            f"sha256(left({c}, length({c}) - 4)) || right({c}, 4) END")


def _email(c: str) -> str:
    return (f"CASE WHEN contains({c}, '@') THEN '****@' || split_part({c}, '@', -1) "
            f"ELSE {_stars(c)} END")


def _email_hash(c: str) -> str:
    return (f"CASE WHEN contains({c}, '@') THEN sha256(left({c}, length({c}) - length(split_part({c}, '@', -1)) - 1)) "
            f"|| '@' || split_part({c}, '@', -1) ELSE sha256({c}) END")


_NUM = "CAST(num AS VARCHAR)"
_level_query(10000, "mask_level_none", "email", "word", sql_stamp("ts"), "num")
_level_query(10004, "mask_level_constant", "'*'", "'*'", "'2000-01-01 00:00:00.000000'", "CAST(1 AS BIGINT)")
_level_query(10005, "mask_level_null", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)",
             "CAST(NULL AS BIGINT)")
_level_query(10009, "mask_level_constant_date", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)",
             "'9999-12-31 00:00:00.000000'", "CAST(NULL AS BIGINT)")
for _level, _name, _fn in (
    (10001, "mask_level_full", _stars), (10002, "mask_level_email", _email),
    (10003, "mask_level_last_four", _last4), (10006, "mask_level_hash", lambda c: f"sha256({c})"),
    (10007, "mask_level_email_hash", _email_hash), (10008, "mask_level_last_four_hash", _last4_hash),
):
    _level_query(_level, _name, _fn("email"), _fn("word"), _fn(_TS_TEXT), _fn(_NUM))


@query("mask_levels_all_on_email", f"""
SELECT doc_id, email AS m10000, repeat('*', length(email)) AS m10001, {_email('email')} AS m10002,
  {_last4('email')} AS m10003, '*' AS m10004, sha256(email) AS m10006, {_email_hash('email')} AS m10007,
  {_last4_hash('email')} AS m10008
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_EMAIL}')) AS email FROM documents)""")
def mask_levels_all_on_email(spark: SparkSession, base: str) -> DataFrame:
    # Texts without the sign cannot match, and the byte search is far cheaper than the regex.
    found = D.load(spark, base, "documents").filter(F.contains("text", F.lit("@"))).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(_EMAIL), F.lit(0))).alias("email"))
    levels = (10000, 10001, 10002, 10003, 10004, 10006, 10007, 10008)
    return found.select("doc_id", *[
        masks.mask(F.col("email"), T.StringType(), n).alias(f"m{n}") for n in levels])


@query("masked_views_by_role", """
SELECT 'ADMIN' AS role, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT 'ANALYST', c_custkey, repeat('*', length(c_name)), c_nationkey, CAST(1 AS DOUBLE), sha256(c_mktsegment)
FROM customer
UNION ALL
SELECT 'PUBLIC', NULL, regexp_replace(left(c_name, length(c_name) - 4), '[A-Za-z0-9]', '*', 'g') || right(c_name, 4),
  c_nationkey, NULL, sha256(left(c_mktsegment, length(c_mktsegment) - 4)) || right(c_mktsegment, 4)
FROM customer""")
def masked_views_by_role(spark: SparkSession, base: str) -> DataFrame:
    return M.masked_views(D.load(spark, base, "customer"), CUSTOMER_TAGS, RULES, list(D.ROLES))


@query("mask_by_row_role", """
WITH a AS (SELECT event_id, user_id, 'user_' || user_id AS consuming_user,
             ['ADMIN', 'ANALYST', 'PUBLIC'][CAST(user_id % 3 + 1 AS INTEGER)] AS executing_role FROM events)
SELECT event_id, executing_role,
  CASE executing_role WHEN 'ADMIN' THEN consuming_user
    WHEN 'ANALYST' THEN repeat('*', length(consuming_user))
    ELSE regexp_replace(left(consuming_user, length(consuming_user) - 4), '[A-Za-z0-9]', '*', 'g')
      || right(consuming_user, 4) END AS consuming_user
FROM a""")
def mask_by_row_role(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).select("event_id", "executing_role", "consuming_user")
    return M.mask_by_role_column(rows, {"consuming_user": "PII_NAME"}, RULES, F.col("executing_role"))


RULE_ROWS = [
    ("PII", "PII_NAME", "ANALYST", 10001), ("PII", "PII_EMAIL", "ANALYST", 10002),
    ("MONEY", "MONEY", "ANALYST", 10004), ("PII", "PII_NAME", "ADMIN", 10000),
    ("PII", "PII_EMAIL", "ADMIN", 10000), ("LEGACY", "MONEY", "PUBLIC", 10005),
]
_RULES_DDL = "tag_name string, tag_value string, role string, masking_policy int"
_RULES_SQL = "(VALUES " + ", ".join(str(r) for r in RULE_ROWS) + ") AS r(tag_name, tag_value, role, masking_policy)"


@query("effective_levels", f"""
WITH {D.ASSIGNMENTS}, rules AS (SELECT * FROM {_RULES_SQL}),
roles AS (SELECT unnest(['ADMIN', 'ANALYST', 'PUBLIC']) AS role)
SELECT roles.role, database_name, schema_name, table_name, column_name, a.tag_name, a.tag_value, masking_policy
FROM assignments a CROSS JOIN roles
LEFT JOIN rules r ON r.role = roles.role AND r.tag_name = a.tag_name AND r.tag_value = a.tag_value""")
def effective_levels(spark: SparkSession, base: str) -> DataFrame:
    rules = spark.createDataFrame(RULE_ROWS, _RULES_DDL)
    return M.effective_levels(D.assignments(spark, base), rules, list(D.ROLES))


@query("mask_from_control_tables", """
SELECT c_custkey, repeat('*', length(c_name)) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
  c_mktsegment
FROM customer""")
def mask_from_control_tables(spark: SparkSession, base: str) -> DataFrame:
    tags = spark.createDataFrame(
        [("customer", "c_name", "PII", "PII_NAME"), ("customer", "c_acctbal", "MONEY", "UNRULED"),
         ("orders", "o_totalprice", "MONEY", "MONEY")],
        "table_name string, column_name string, tag_name string, tag_value string")
    rules = spark.createDataFrame(RULE_ROWS, _RULES_DDL)
    return M.apply_masking(D.load(spark, base, "customer"), tags, rules, "ANALYST", table="customer")


POLICY_ROWS = [
    ("p1", "TAG", "PII", True, None), ("p2", "TAG", "MONEY", True, None), ("p3", "TAG", "LEGACY", False, None),
    ("p4", "PUSHDOWN", "PAC_LEVEL", False, [1, 3]), ("p5", "PUSHDOWN", "pii", False, None),
    ("p6", "TAG", "MONEY", True, None),
]


@query("match_policies", f"""
WITH {D.ASSIGNMENTS}
SELECT database_name, schema_name, table_name, column_name, tag_name, tag_value, policy_id, policy_type
FROM (SELECT *, CAST(substr(database_name, 4) AS INTEGER) AS db FROM assignments) a
JOIN (VALUES ('p1', 'TAG', 'PII', NULL), ('p2', 'TAG', 'MONEY', NULL), ('p6', 'TAG', 'MONEY', NULL),
             ('p4', 'PUSHDOWN', 'PAC_LEVEL', [1, 3])) p(policy_id, policy_type, tag, ids)
  ON (policy_type = 'TAG' AND upper(tag_name) = tag)
  OR (policy_type = 'PUSHDOWN' AND lower(tag_name) = lower(tag) AND list_contains(ids, db))""")
def match_policies(spark: SparkSession, base: str) -> DataFrame:
    policies = spark.createDataFrame(
        POLICY_ROWS, "policy_id string, policy_type string, tag string, connected boolean, database_ids array<int>")
    rows = D.assignments(spark, base).drop("column_id")
    database = F.substring("database_name", 4, 10).cast("int")
    return M.match_policies(rows, policies, database)


@query("duplicate_policies", """
SELECT 'TAG' AS policy_type, upper(p_type) AS tag, count(*) AS policies
FROM part GROUP BY 2 HAVING count(*) > 1""")
def duplicate_policies(spark: SparkSession, base: str) -> DataFrame:
    policies = D.load(spark, base, "part").select(F.lit("TAG").alias("policy_type"), F.upper("p_type").alias("tag"))
    return M.duplicate_policies(policies)


@query("mask_column_policy", f"""
SELECT s_suppkey, {_last4('s_name')} AS s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier""")
def mask_column_policy(spark: SparkSession, base: str) -> DataFrame:
    rules = [M.MaskRule("ANALYST", "s_name", 10003), M.MaskRule("ADMIN", "s_acctbal", 10000)]
    return M.mask_column_policy(D.load(spark, base, "supplier"), rules, "ANALYST")


@query("mask_data_types", f"""
WITH {D.ASSIGNMENTS}
SELECT a.* FROM assignments a JOIN inventory i USING (column_id) WHERE i.data_type IN ('varchar', 'date')""")
def mask_data_types(spark: SparkSession, base: str) -> DataFrame:
    return M.mask_data_types(D.assignments(spark, base), D.inventory(spark, base), ["VARCHAR", "date"])


_THRESHOLDS_DDL = (
    "rule_id string, role string, "
    "access_rate_thresholds array<struct<access_rate_unit:string,access_rate_limit:int,action:string>>, "
    "time_window_thresholds array<struct<day:array<string>,start_time:struct<hour:int,minute:int>,"
    "end_time:struct<hour:int,minute:int>,timezone:string,action:string>>"
)
_WEEK = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY"]
THRESHOLD_ROWS = [
    ("r1", "ADMIN", [("hour", 1, "block"), ("MINUTE", 1, "ALERT")],
     [(_WEEK, (9, 30), (17, 0), "America/New_York", "block")]),
    ("r2", "ANALYST", [("DAY", 5, "block")],
     [(["SATURDAY", "sunday"], (22, 0), (6, 15), "Europe/Berlin", "ALERT"),
      (["FRIDAY"], (0, 0), (0, 0), "UTC", "block")]),
    ("r3", "PUBLIC", [("HOUR", 2, "ALERT")], []),
]


def threshold_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLD_ROWS, _THRESHOLDS_DDL)


@query("rate_breaches", f"""
WITH {D.AUDITS}, limits AS (
  SELECT * FROM (VALUES ('r1', 'ADMIN', 'HOUR', 1, 'block'), ('r1', 'ADMIN', 'MINUTE', 1, 'ALERT'),
    ('r2', 'ANALYST', 'DAY', 5, 'block'), ('r3', 'PUBLIC', 'HOUR', 2, 'ALERT'))
  AS l(rule_id, role, unit, access_rate_limit, action)),
counts AS (
  SELECT consuming_user, executing_role, unit, date_trunc(lower(unit), event_time) AS w, count(*) AS accesses
  FROM audits CROSS JOIN (SELECT unnest(['MINUTE', 'HOUR', 'DAY']) AS unit) GROUP BY ALL)
SELECT rule_id, consuming_user, unit, {sql_stamp('w')} AS window_start, accesses, access_rate_limit, action
FROM counts JOIN limits USING (unit) WHERE executing_role = role AND accesses > access_rate_limit""")
def rate_breaches(spark: SparkSession, base: str) -> DataFrame:
    out = TH.access_rate_breaches(D.audits(spark, base), threshold_rules(spark))
    return out.withColumn("window_start", stamp("window_start"))


@query("rate_breaches_hourly", f"""
WITH {D.AUDITS}
SELECT 'any' AS rule_id, consuming_user, 'HOUR' AS unit, {sql_stamp("date_trunc('hour', event_time)")} AS window_start,
  count(*) AS accesses, 1 AS access_rate_limit, 'block' AS action
FROM audits GROUP BY consuming_user, date_trunc('hour', event_time) HAVING count(*) > 1""")
def rate_breaches_hourly(spark: SparkSession, base: str) -> DataFrame:
    rule = spark.createDataFrame([("any", "ANY", [("hour", 1, "block")], [])], _THRESHOLDS_DDL)
    out = TH.access_rate_breaches(D.audits(spark, base), rule, role=None)
    return out.withColumn("window_start", stamp("window_start"))


def _local(zone: str) -> str:
    return f"timezone('{zone}', timezone('UTC', event_time))"


@query("time_window_breaches", f"""
WITH {D.AUDITS}, local AS (
  SELECT event_id, consuming_user, {_local('America/New_York')} AS ny, {_local('Europe/Berlin')} AS be, event_time AS ut
  FROM audits),
m AS (SELECT *, dayofweek(ny) AS nyd, hour(ny) * 60 + minute(ny) AS nym, dayofweek(be) AS bed,
        hour(be) * 60 + minute(be) AS bem, dayofweek(ut) AS utd FROM local)
SELECT event_id, consuming_user, 'r1' AS rule_id, 0 AS threshold_no, 'America/New_York' AS zone, 'block' AS action
FROM m WHERE nyd BETWEEN 1 AND 5 AND nym >= 570 AND nym < 1020
UNION ALL
SELECT event_id, consuming_user, 'r2', 0, 'Europe/Berlin', 'ALERT' FROM m
WHERE (bed IN (6, 0) AND bem >= 1320) OR (bed IN (0, 1) AND bem < 375)
UNION ALL
SELECT event_id, consuming_user, 'r2', 1, 'UTC', 'block' FROM m WHERE utd = 5""")
def time_window_breaches(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).select("event_id", "consuming_user", "event_time")
    zones = sorted({t[3] for r in THRESHOLD_ROWS for t in r[3]})
    return TH.time_window_breaches(rows, threshold_rules(spark), zones).drop("event_time")
