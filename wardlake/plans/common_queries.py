"""Filters, slices, pages, patches, versions and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.operators import common as G
from wardlake.plans import derived as D
from wardlake.plans.registry import query, sql_stamp, stamp
from wardlake.sources.policy_rules import explode_rules


@query("load_tables_counts", """
SELECT r_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name""")
def load_tables_counts(spark: SparkSession, base: str) -> DataFrame:
    from wardlake.sources.tables import load_tables

    t = load_tables(spark, base, ["region", "nation", "customer", "orders"])
    # Orders are counted per customer before the join, so few rows are joined.
    per_customer = t["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return (
        t["customer"].join(per_customer, "c_custkey", "left")
        .groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("c"), F.sum(F.coalesce("n", F.lit(0))).alias("o"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name").agg(F.sum("c").alias("customers"), F.sum("o").alias("orders")))


@query("list_filtered", f"""
WITH {D.AUDITS}
SELECT event_id, consuming_user, statement_type, table_name, statement_text FROM audits
WHERE sidecar_id = 'sc_1' AND statement_type IN ('VIEW', 'CLICK') AND lower(consuming_user) LIKE 'user\\_1%' ESCAPE '\\'
  AND contains(statement_text, 'item')""")
def list_filtered(spark: SparkSession, base: str) -> DataFrame:
    rows = G.list_filtered(
        D.audits(spark, base), eq={"sidecar_id": "sc_1", "table_name": None},
        any_of={"statement_type": ["VIEW", "CLICK"], "category": None},
        prefix={"consuming_user": "USER_1"}, contains={"statement_text": "item"})
    return rows.select("event_id", "consuming_user", "statement_type", "table_name", "statement_text")


@query("active_jobs", """
SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'PAUSED' ELSE 'COMPLETED' END AS status
FROM orders WHERE o_orderstatus IN ('O', 'P')""")
def active_jobs(spark: SparkSession, base: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "RUNNING").when(F.col("o_orderstatus") == "P", "PAUSED")
    jobs = D.load(spark, base, "orders").select(
        F.col("o_orderkey").alias("job_id"), status.otherwise("COMPLETED").alias("status"))
    return G.active_jobs(jobs)


@query("deep_page", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC
LIMIT 40 OFFSET (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM lineitem)""")
def deep_page(spark: SparkSession, base: str) -> DataFrame:
    """A page behind four fifths of the table."""
    rows = D.load(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return G.sort_limit_offset(rows, ["l_orderkey", "l_linenumber"], "l_extendedprice", "desc", 40, rows.count() * 8 // 10)


@query("sort_limit_offset", f"""
WITH {D.AUDITS}
SELECT event_id, {sql_stamp('event_time')} AS event_time, row_count FROM (
  SELECT * FROM audits ORDER BY row_count DESC, event_id DESC LIMIT 50 OFFSET 25)""")
def sort_limit_offset(spark: SparkSession, base: str) -> DataFrame:
    rows = G.sort_limit_offset(D.audits(spark, base), ["event_id"], "row_count", "desc", limit=50, offset=25)
    return rows.select("event_id", stamp("event_time").alias("event_time"), "row_count")


@query("keyset_page", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE (o_custkey, o_orderkey) > (100, 500) ORDER BY o_custkey, o_orderkey LIMIT 250""")
def keyset_page(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return G.keyset_rows(rows, ["o_custkey", "o_orderkey"], [100, 500], 250)


@query("merge_policy_types", """
SELECT 'p_' || p_partkey AS policy_id, p_name AS name, CAST(NULL AS VARCHAR) AS repo, 'TAG' AS policy_type FROM part
UNION ALL SELECT 's_' || s_suppkey, s_name, 'repo_' || s_nationkey, 'OLTP' FROM supplier
UNION ALL SELECT 'c_' || c_custkey, c_name, NULL, 'GRANT' FROM customer""")
def merge_policy_types(spark: SparkSession, base: str) -> DataFrame:
    part = D.load(spark, base, "part").select(D.text("p_", F.col("p_partkey")).alias("policy_id"), F.col("p_name").alias("name"))
    supplier = D.load(spark, base, "supplier").select(
        D.text("s_", F.col("s_suppkey")).alias("policy_id"), F.col("s_name").alias("name"),
        D.text("repo_", F.col("s_nationkey")).alias("repo"))
    customer = D.load(spark, base, "customer").select(D.text("c_", F.col("c_custkey")).alias("policy_id"), F.col("c_name").alias("name"))
    return G.merge_policy_types({"TAG": part, "OLTP": supplier, "GRANT": customer})


@query("patch_rows", """
SELECT c.c_custkey, coalesce(p.c_name, c.c_name) AS c_name, c.c_nationkey,
  coalesce(p.c_acctbal, c.c_acctbal) AS c_acctbal, c.c_mktsegment
FROM customer c LEFT JOIN (
  SELECT o_custkey, CASE WHEN max(o_orderkey) % 2 = 0 THEN 'renamed ' || o_custkey END AS c_name,
    CASE WHEN max(o_orderkey) % 3 = 0 THEN max(o_totalprice) END AS c_acctbal
  FROM orders GROUP BY o_custkey) p ON p.o_custkey = c.c_custkey""")
def patch_rows(spark: SparkSession, base: str) -> DataFrame:
    patch = D.load(spark, base, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderkey").alias("k"), F.max("o_totalprice").alias("price")).select(
        "c_custkey", F.when(F.col("k") % 2 == 0, D.text("renamed ", F.col("c_custkey"))).alias("c_name"),
        F.when(F.col("k") % 3 == 0, F.col("price")).alias("c_acctbal"))
    return G.patch_rows(D.load(spark, base, "customer"), patch, ["c_custkey"])


@query("latest_version", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
  arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
FROM orders GROUP BY o_custkey""")
def latest_version(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return G.latest_version(rows, ["o_custkey"], "o_orderkey")


@query("key_versions", """
SELECT 'ns_' || c_nationkey AS namespace, c_mktsegment AS name, max(CAST(c_custkey AS INTEGER)) AS sequence
FROM customer WHERE c_acctbal >= 0 GROUP BY ALL""")
def key_versions(spark: SparkSession, base: str) -> DataFrame:
    from wardlake.functions.fpe import latest_version as latest_key

    keys = D.load(spark, base, "customer").select(
        D.text("ns_", F.col("c_nationkey")).alias("namespace"), F.col("c_mktsegment").alias("name"),
        F.col("c_custkey").cast("string").alias("sequence"),
        F.when(F.col("c_acctbal") < 0, "deactivated").otherwise("ACTIVE").alias("status"))
    return latest_key(keys)


@query("apply_tombstones", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P')""")
def apply_tombstones(spark: SparkSession, base: str) -> DataFrame:
    deletes = D.load(spark, base, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = D.load(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return G.apply_tombstones(rows, deletes, ["l_orderkey"], skewed=True)


def _archive_events(spark: SparkSession, base: str) -> DataFrame:
    return D.load(spark, base, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("n"),
        F.when(F.col("o_orderstatus") == "F", "archive").otherwise("restore").alias("action"))


_ARCHIVED = """(SELECT o_custkey FROM (
    SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1 AND o_orderstatus = 'F')"""


@query("soft_delete_active", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN {_ARCHIVED}")
def soft_delete_active(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "customer").select("c_custkey", "c_name")
    return G.soft_delete(rows, _archive_events(spark, base), ["c_custkey"], ["ts", "n"])


@query("soft_delete_archived", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN {_ARCHIVED}")
def soft_delete_archived(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "customer").select("c_custkey", "c_name")
    return G.soft_delete(rows, _archive_events(spark, base), ["c_custkey"], ["ts", "n"], archived=True)


@query("reference_counts", """
SELECT c_custkey, count(o_orderkey) AS order_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def reference_counts(spark: SparkSession, base: str) -> DataFrame:
    return G.reference_counts(
        D.load(spark, base, "customer").select("c_custkey"), D.load(spark, base, "orders"), "c_custkey", "o_custkey",
        "order_count")


def _guarded(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    customers = D.load(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal")
    requested = customers.filter("c_acctbal < 5000")
    blockers = D.load(spark, base, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return G.guarded_delete(customers, requested, blockers, ["c_custkey"])


@query("guarded_delete_remaining", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_acctbal >= 5000 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def guarded_delete_remaining(spark: SparkSession, base: str) -> DataFrame:
    return _guarded(spark, base)[0]


@query("guarded_delete_refused", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_acctbal < 5000 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def guarded_delete_refused(spark: SparkSession, base: str) -> DataFrame:
    return _guarded(spark, base)[1]


_STATE_SQL = """
SELECT event_id, CASE WHEN user_id % 4 = 1 THEN '10002' END AS pending,
  CASE WHEN user_id % 3 <> 0 THEN '10001' END AS success, CASE WHEN user_id % 5 = 2 THEN '10006' END AS failed
FROM events"""


@query("applied_state", f"""
SELECT *, CASE WHEN pending IS NOT NULL THEN 'PENDING' WHEN failed IS NOT NULL THEN 'FAILED'
  WHEN success IS NOT NULL THEN 'SUCCESS' ELSE 'NONE' END AS status, success AS effective FROM ({_STATE_SQL})""")
def applied_state(spark: SparkSession, base: str) -> DataFrame:
    u = F.col("user_id")
    rows = D.load(spark, base, "events").select(
        "event_id", F.when(u % 4 == 1, "10002").alias("pending"), F.when(u % 3 != 0, "10001").alias("success"),
        F.when(u % 5 == 2, "10006").alias("failed"))
    return G.applied_state(rows, "pending", "success", "failed")


@query("lookup_by_name", """
SELECT w.friendly_name, c_custkey AS database_id, c_mktsegment AS database_name, c_custkey IS NOT NULL AS found
FROM (SELECT 'Customer#' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS friendly_name FROM orders) w
LEFT JOIN customer ON c_name = w.friendly_name""")
def lookup_by_name(spark: SparkSession, base: str) -> DataFrame:
    registry = D.load(spark, base, "customer").select(
        F.col("c_name").alias("friendly_name"), F.col("c_custkey").alias("database_id"),
        F.col("c_mktsegment").alias("database_name"))
    wanted = D.load(spark, base, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("friendly_name"))
    return G.lookup_by_name(registry, wanted, "friendly_name", ["database_id", "database_name"])


@query("explode_rules", """
SELECT 'h_' || c_custkey AS rule_key, 'rule_' || c_custkey || '_' || i AS rule_id, 'pol_' || c_nationkey AS policy_id,
  c_mktsegment AS role, c_name AS tag_value, CAST(10000 + (c_custkey + i) % 10 AS INTEGER) AS masking_policy
FROM customer CROSS JOIN (SELECT unnest([0, 1]) AS i) WHERE (c_custkey + i) % 4 <> 0""")
def explode_rules_query(spark: SparkSession, base: str) -> DataFrame:
    key = F.col("c_custkey")

    def rule(i: int):
        code = (10000 + (key + i) % 10).cast("string")
        empty = F.struct(F.lit(None).cast("string").alias("masking_policy"))
        live = F.when((key + i) % 4 != 0, F.struct(code.alias("masking_policy")))
        return F.struct(
            D.text("rule_", key, f"_{i}").alias("rule_id"), F.lit("x").alias("rule_hash"),
            empty.alias("pending_rule_json"), live.alias("success_rule_json"), empty.alias("failed_rule_json"),
            D.text("pol_", F.col("c_nationkey")).alias("policy_id"), F.col("c_mktsegment").alias("role"),
            F.col("c_name").alias("tag_value"), F.lit(None).cast("timestamp").alias("updated_at"))

    wire = D.load(spark, base, "customer").select(
        F.to_json(F.create_map(D.text("h_", key), F.array(rule(0), rule(1)))).alias("items"))
    return explode_rules(wire).drop("updated_at")
