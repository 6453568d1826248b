"""Grants, compliance, unauthorised access and access requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import access as P
from wardlake.plans import derived as D
from wardlake.plans.registry import query

_RULES_DDL = P.RULE_DDL
ROLES = ("ADMIN", "ANALYST", "ANALYST_EU", "PUBLIC", "APP_RO")


def _actor(condition: str, *names: str) -> tuple:
    return ("role", condition, list(names))


def _objects(kind: str, condition: str, names: list[str], paths: list[tuple] | None = None) -> tuple:
    return (kind, condition, names, paths or [])


RULES = [
    ("g1", [_actor("equals", "ADMIN")], [_objects("database", "equals", ["db_1", "db_2"])], [("read",), ("write",)], []),
    ("g2", [_actor("starts_with", "ANALYST")], [_objects("schema", "starts_with", ["brand#1"])], [("read",)], []),
    ("g3", [_actor("ends_with", "_RO", "LIC")],
     [_objects("table", "ends_with", ["_17", "_23"]), _objects("view", "starts_with", ["large"])], [("read",)], []),
    ("g4", [_actor("equals", "PUBLIC")],
     [_objects("table", "fully_qualified", [], [("db_3", "brand#5", None, None), ("db_4", None, None, None),
                                                ("db_0", "brand#2", "promo_7", None)])], [("read",)], []),
]
_TABLES = D.TABLE_INVENTORY
_OBJECT_SQL = """
objects AS (
  SELECT 'g1' AS rule_id, database_name, schema_name, table_name FROM tables WHERE database_name IN ('db_1', 'db_2')
  UNION SELECT 'g2', database_name, schema_name, table_name FROM tables WHERE schema_name LIKE 'brand#1%'
  UNION SELECT 'g3', database_name, schema_name, table_name FROM tables WHERE object_type = 'table' AND (table_name LIKE '%\\_17' ESCAPE '\\' OR table_name LIKE '%\\_23' ESCAPE '\\')
  UNION SELECT 'g3', database_name, schema_name, table_name FROM tables WHERE object_type = 'view' AND table_name LIKE 'large%'
  UNION SELECT 'g4', database_name, schema_name, table_name FROM tables
    WHERE (database_name = 'db_3' AND schema_name = 'brand#5') OR database_name = 'db_4'
       OR (database_name = 'db_0' AND schema_name = 'brand#2' AND table_name = 'promo_7')),
actors AS (
  SELECT * FROM (VALUES ('g1', 'ADMIN', 'read'), ('g1', 'ADMIN', 'write'), ('g2', 'ANALYST', 'read'), ('g2', 'ANALYST_EU', 'read'),
    ('g3', 'APP_RO', 'read'), ('g3', 'PUBLIC', 'read'), ('g4', 'PUBLIC', 'read')) a(rule_id, role, access)),
grants AS (SELECT rule_id, role, database_name, schema_name, table_name, access FROM objects JOIN actors USING (rule_id))"""


def roles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r,) for r in ROLES], "role string")


def grants(spark: SparkSession, base: str) -> DataFrame:
    return P.expand_grants(spark.createDataFrame(RULES, _RULES_DDL), roles(spark), D.table_inventory(spark, base))


@query("grants_expand", f"WITH {_TABLES}, {_OBJECT_SQL} SELECT * FROM grants")
def grants_expand(spark: SparkSession, base: str) -> DataFrame:
    return grants(spark, base)


def _tags(spark: SparkSession, base: str) -> DataFrame:
    """Tags on databases, schemas and tables of the inventory."""
    t = D.table_inventory(spark, base)
    per_table = t.selectExpr(
        "object_type AS level", "database_name", "schema_name", "table_name", "'gov' AS tag_database", "'tags' AS tag_schema",
        "explode(array(named_struct('n', 'tier', 'v', right(table_name, 1)), named_struct('n', 'owner', 'v', left(table_name, 3)))) AS x")
    per_table = per_table.selectExpr("level", "database_name", "schema_name", "table_name", "tag_database", "tag_schema",
                                     "x.n AS tag_name", "x.v AS tag_value")
    per_db = t.select("database_name").distinct().selectExpr(
        "'database' AS level", "database_name", "CAST(NULL AS STRING) AS schema_name", "CAST(NULL AS STRING) AS table_name",
        "'gov' AS tag_database", "'tags' AS tag_schema", "'zone' AS tag_name", "right(database_name, 1) AS tag_value")
    return per_table.unionByName(per_db)


TAG_RULES = [
    ("t1", [_actor("equals", "ANALYST")], [], [("read",)],
     [(["tables"], [("gov", "tags", "tier", "7"), ("gov", "tags", "owner", "pro")], "and")]),
    ("t2", [_actor("equals", "PUBLIC")], [], [("read",)],
     [(["views", "databases"], [("gov", "tags", "owner", "lar"), ("gov", "tags", "zone", "3")], "or")]),
]


@query("tagged_objects", f"""
WITH {_TABLES}
SELECT 't1' AS rule_id, 'ANALYST' AS role, database_name, schema_name, table_name, 'read' AS access FROM tables
WHERE object_type = 'table' AND table_name LIKE '%7' AND table_name LIKE 'pro%'
UNION SELECT 't2', 'PUBLIC', database_name, schema_name, table_name, 'read' FROM tables
WHERE (object_type = 'view' AND table_name LIKE 'lar%') OR database_name = 'db_3'""")
def tagged_objects(spark: SparkSession, base: str) -> DataFrame:
    rules = spark.createDataFrame(TAG_RULES, _RULES_DDL)
    return P.expand_grants(rules, roles(spark), D.table_inventory(spark, base), _tags(spark, base))


def _part(name: str | None) -> tuple:
    return (name, False) if name is not None else ("", True)


OLTP_RULES = [
    ("o1", "read", [("idp_user", "equals", ["USER_5"]), ("idp_group", "equals", ["admin"])],
     [("column", [(_part("DB_1"), _part(None), _part(None), _part(None))])]),
    ("o2", "read", [("idp_group", "equals", ["Public"])],
     [("column", [(_part("db_2"), _part("brand#3"), _part(None), _part(None)),
                  (_part(None), _part(None), _part(None), _part("COL_77"))])]),
]


@query("expand_oltp_grants", f"""
WITH {D.INVENTORY}, {D.AUDITS},
users AS (SELECT DISTINCT consuming_user AS username, executing_role AS grp FROM audits),
who AS (SELECT 'o1' AS rule_id, username FROM users WHERE lower(username) = 'user_5' OR lower(grp) = 'admin'
  UNION SELECT 'o2', username FROM users WHERE lower(grp) = 'public'),
cols AS (SELECT 'o1' AS rule_id, database_name, schema_name, table_name, column_name FROM inventory WHERE database_name = 'db_1'
  UNION SELECT 'o2', database_name, schema_name, table_name, column_name FROM inventory
    WHERE (database_name = 'db_2' AND schema_name = 'brand#3') OR column_name = 'col_77')
SELECT rule_id, username, database_name, schema_name, table_name, column_name, 'read' AS access FROM cols JOIN who USING (rule_id)""")
def expand_oltp_grants(spark: SparkSession, base: str) -> DataFrame:
    rules = spark.createDataFrame(OLTP_RULES, P.OLTP_RULE_DDL)
    users = D.audits(spark, base).groupBy(F.col("consuming_user").alias("username")).agg(
        F.collect_set("executing_role").alias("user_groups"))
    return P.expand_oltp_grants(rules, users, D.inventory(spark, base), "case_insensitive")


_ACTUAL_SQL = """
actual AS (
  SELECT role, database_name, schema_name, table_name, access FROM grants WHERE length(table_name) % 3 <> 0
  UNION SELECT 'PUBLIC', database_name, schema_name, table_name, 'write' FROM tables WHERE table_name LIKE 'small%')"""


@query("compliance_diff", f"""
WITH {_TABLES}, {_OBJECT_SQL}, {_ACTUAL_SQL},
expected AS (SELECT DISTINCT role, database_name, schema_name, table_name, access FROM grants)
SELECT *, 'missing' AS compliance FROM (SELECT * FROM expected EXCEPT SELECT * FROM actual)
UNION ALL SELECT *, 'excess' FROM (SELECT * FROM actual EXCEPT SELECT * FROM expected)""")
def compliance_diff(spark: SparkSession, base: str) -> DataFrame:
    expected = grants(spark, base).select(*P.GRANT_KEYS)
    extra = D.table_inventory(spark, base).filter("table_name LIKE 'small%'").selectExpr(
        "'PUBLIC' AS role", "database_name", "schema_name", "table_name", "'write' AS access")
    actual = expected.filter("length(table_name) % 3 <> 0").unionByName(extra)
    return P.compliance_check(expected, actual)


@query("can_access", f"""
WITH {_TABLES}, {_OBJECT_SQL}
SELECT count(*) > 0 AS allowed FROM grants WHERE role = 'PUBLIC' AND access = 'read' AND database_name = 'db_4'""")
def can_access(spark: SparkSession, base: str) -> DataFrame:
    return P.can_access(grants(spark, base), "PUBLIC", {"database_name": "db_4"})


@query("unauthorised_accesses", f"""
WITH {D.AUDITS}, granted AS (SELECT * FROM (VALUES ('ADMIN', 'orders'), ('ADMIN', 'customer'), ('ADMIN', 'lineitem'),
  ('ANALYST', 'part'), ('ANALYST', 'orders'), ('PUBLIC', 'part')) g(role, t))
SELECT event_id, executing_role AS role, table_name, column_name FROM audits
WHERE (executing_role, table_name) NOT IN (SELECT (role, t) FROM granted)""")
def unauthorised_accesses(spark: SparkSession, base: str) -> DataFrame:
    """A few (role, table) pairs hold all rows, so the anti join has to spread them."""
    held = [("ADMIN", "orders"), ("ADMIN", "customer"), ("ADMIN", "lineitem"), ("ANALYST", "part"),
            ("ANALYST", "orders"), ("PUBLIC", "part")]
    granted = spark.createDataFrame(held, "role string, table_name string")
    touched = D.audits(spark, base).selectExpr("event_id", "executing_role AS role", "table_name", "column_name")
    return P.unauthorised_accesses(touched, granted, ["role", "table_name"])


AUDIT_RULES = [
    ("a1", [_actor("equals", "ADMIN")], [_objects("database", "equals", ["tpch"])], [("read",), ("write",)], []),
    ("a2", [_actor("starts_with", "ANALYST")], [_objects("table", "ends_with", ["s", "item"])], [("read",)], []),
    ("a3", [_actor("ends_with", "LIC")],
     [_objects("table", "fully_qualified", [], [("tpch", "main", "part", None), ("tpch", "other", None, None)])], [("read",)], []),
    ("a4", [_actor("equals", "PUBLIC")], [_objects("view", "starts_with", ["or"])], [("write",)], []),
]
#: What a statement does to its table.
_WRITES = ("PURCHASE", "SIGNUP")
_WRITES_SQL = ", ".join(f"'{w}'" for w in _WRITES)


@query("uncovered_accesses", f"""
WITH {D.AUDITS},
asked AS (SELECT event_id, executing_role AS role, table_name,
  CASE WHEN statement_type IN ({_WRITES_SQL}) THEN 'write' ELSE 'read' END AS access FROM audits)
SELECT event_id, role, table_name, access FROM asked
WHERE NOT (role = 'ADMIN' OR access = 'read' AND (role LIKE 'ANALYST%' AND (table_name LIKE '%s' OR table_name LIKE '%item')
  OR role LIKE '%LIC' AND table_name = 'part'))""")
def uncovered_accesses(spark: SparkSession, base: str) -> DataFrame:
    """Reads and writes of the audit log against rules, which stay factored; a view rule covers no table."""
    done = D.audits(spark, base)
    access = F.when(F.col("statement_type").isin(*_WRITES), "write").otherwise("read")
    asked = done.select("event_id", F.col("executing_role").alias("role"), *P.TABLE_KEYS, access.alias("access"))
    catalog = done.select(*P.TABLE_KEYS, F.lit("table").alias("object_type")).distinct()
    held = P.access_grants(spark.createDataFrame(AUDIT_RULES, _RULES_DDL), asked.select("role").distinct(), catalog)
    return P.uncovered_accesses(asked, held, catalog).select("event_id", "role", "table_name", "access")


OLTP_AUDIT_RULES = [
    ("c1", "read", [("idp_group", "equals", ["Admin"])], [("column", [(_part("TPCH"), _part(None), _part(None), _part(None))])]),
    ("c2", None, [("idp_user", "equals", ["USER_5", "user_6"])],
     [("column", [(_part(None), _part("Main"), _part("orders"), _part(None)), (None, None, None, _part("COL_3"))])]),
    ("c3", "WRITE", [("idp_group", "equals", ["public"])], [("column", [(_part("tpch"), _part("main"), _part(None), _part("col_1"))])]),
]


@query("uncovered_column_accesses", f"""
WITH {D.AUDITS},
asked AS (SELECT event_id, consuming_user AS username, table_name, column_name,
  CASE WHEN statement_type IN ({_WRITES_SQL}) THEN 'write' ELSE 'read' END AS access FROM audits),
groups AS (SELECT consuming_user AS username, bool_or(executing_role = 'ADMIN') AS admin, bool_or(executing_role = 'PUBLIC') AS public
  FROM audits GROUP BY consuming_user)
SELECT event_id, username, table_name, column_name, access FROM asked JOIN groups USING (username)
WHERE NOT (access = 'read' AND admin OR access = 'read' AND username IN ('user_5', 'user_6') AND (table_name = 'orders' OR column_name = 'col_3')
  OR access = 'write' AND public AND column_name = 'col_1')""")
def uncovered_column_accesses(spark: SparkSession, base: str) -> DataFrame:
    """The same for users, groups and column paths with wildcards, without regard to case."""
    done = D.audits(spark, base)
    access = F.when(F.col("statement_type").isin(*_WRITES), "write").otherwise("read")
    asked = done.select("event_id", F.col("consuming_user").alias("username"), *P.COLUMN_PARTS, access.alias("access"))
    users = done.groupBy(F.col("consuming_user").alias("username")).agg(F.collect_set("executing_role").alias("user_groups"))
    held = P.oltp_grants(spark.createDataFrame(OLTP_AUDIT_RULES, P.OLTP_RULE_DDL), users, "case_insensitive")
    return P.uncovered_accesses(asked, held).select("event_id", "username", "table_name", "column_name", "access")


_STATE_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in P.ACTION_STATES.items()) + "}"
_STATE_SQL = f"""
ev AS (SELECT *, {_STATE_MAP}[action] AS state FROM request_events),
fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts, event_id) AS rn FROM ev
  WHERE state IN ('CLOSED_APPROVED', 'CLOSED_DENIED', 'CLOSED_CANCELLED', 'CLOSED', 'FAILED')) WHERE rn = 1),
opn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev
  WHERE state NOT IN ('CLOSED_APPROVED', 'CLOSED_DENIED', 'CLOSED_CANCELLED', 'CLOSED', 'FAILED')) WHERE rn = 1),
sub AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts, event_id) AS rn FROM ev
  WHERE state = 'OPEN') WHERE rn = 1),
states AS (
  SELECT i.request_id, sub.requester, sub.justification AS requester_justification, coalesce(fin.state, opn.state) AS status,
    CASE WHEN coalesce(fin.state, opn.state) <> 'OPEN' THEN CASE WHEN fin.state IS NOT NULL THEN fin.justification ELSE opn.justification END END AS reviewer_justification
  FROM (SELECT DISTINCT request_id FROM ev) i LEFT JOIN fin USING (request_id) LEFT JOIN opn USING (request_id) LEFT JOIN sub USING (request_id))"""


@query("request_state", f"WITH {D.REQUEST_EVENTS}, {_STATE_SQL} SELECT * FROM states")
def request_state(spark: SparkSession, base: str) -> DataFrame:
    return P.request_state(D.request_events(spark, base))


@query("grants_from_requests", f"""
WITH {_TABLES}, {D.REQUEST_EVENTS}, {_STATE_SQL}
SELECT request_id, 'ANALYST' AS role, database_name, schema_name, table_name, 'read' AS access
FROM states JOIN customer ON request_id = 'rq_' || c_custkey
JOIN tables ON table_name = lower(['large', 'small', 'promo', 'economy'][CAST(c_nationkey % 4 + 1 AS INTEGER)]) || '_' || (c_custkey % 50)
  AND object_type = 'table'
WHERE status = 'CLOSED_APPROVED'""")
def grants_from_requests(spark: SparkSession, base: str) -> DataFrame:
    """One request per customer for the tables of one name."""
    name = "element_at(array('large', 'small', 'promo', 'economy'), CAST(c_nationkey % 4 + 1 AS INT)) || '_' || (c_custkey % 50)"
    requests = D.load(spark, base, "customer").selectExpr(
        "'rq_' || c_custkey AS request_id",
        "array(named_struct('type', 'role', 'condition', 'equals', 'identifiers', array('ANALYST'))) AS actors",
        f"array(named_struct('type', 'table', 'condition', 'equals', 'identifiers', array({name}), "
        "'fully_qualified_identifiers', CAST(NULL AS ARRAY<STRUCT<database: STRING, schema: STRING, table: STRING, view: STRING>>))) AS objects",
        "array(named_struct('name', 'read')) AS access")
    states = P.request_state(D.request_events(spark, base))
    return P.grants_from_requests(states, requests, roles(spark), D.table_inventory(spark, base))
