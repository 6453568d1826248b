"""Sampling, classifiers, findings and review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardlake.functions import detectors
from wardlake.functions.content import is_format
from wardlake.operators import findings as C
from wardlake.operators import rulesets as R
from wardlake.operators import sampling as S
from wardlake.operators import sketches as K
from wardlake.plans import derived as D
from wardlake.plans.registry import query
from wardlake.session import scratch_path, write_through
from wardlake.sources.sinks import write_classification_report
from wardlake.sources.tables import column_catalog as read_catalog, frames_catalog, load_tables

# ── sampling and profiles ───────────────────────────────────────────────────


@query("sample_rows_percent", """
SELECT c_custkey, c_name FROM customer
WHERE CAST('0x' || substr(md5('7|' || c_custkey), 1, 8) AS BIGINT) % 100 < 20""")
def sample_rows_percent(spark: SparkSession, base: str) -> DataFrame:
    return S.sample_rows(D.load(spark, base, "customer").select("c_custkey", "c_name"), "ROW_PERCENT", 20,
                         ["c_custkey"], seed="7")


@query("sample_rows_count", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('0|' || o_orderkey), o_orderkey LIMIT 100""")
def sample_rows_count(spark: SparkSession, base: str) -> DataFrame:
    return S.sample_rows(D.load(spark, base, "orders").select("o_orderkey", "o_totalprice"), "ROWS",
                         S.DEFAULT_WAREHOUSE_ROWS, ["o_orderkey"])


@query("melt_columns", """
SELECT 'tpch' AS database_name, 'main' AS schema_name, 'customer' AS table_name, column_name, value FROM (
  SELECT 'c_custkey' AS column_name, CAST(c_custkey AS VARCHAR) AS value FROM customer
  UNION ALL SELECT 'c_name', c_name FROM customer
  UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)""")
def melt_columns(spark: SparkSession, base: str) -> DataFrame:
    return S.melt_columns(D.load(spark, base, "customer"), "customer")


@query("sample_columns", " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, md5('0|{c}|' || o_orderkey) AS digest FROM orders "
    f"WHERE {c} IS NOT NULL ORDER BY digest LIMIT {S.DEFAULT_OLTP_ROWS})" for c in ("o_orderkey", "o_custkey", "o_orderstatus")))
def sample_columns(spark: SparkSession, base: str) -> DataFrame:
    """The default sample of an OLTP job: so many values of each column."""
    orders = D.load(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return S.sample_columns(orders, "orders", S.DEFAULT_OLTP_ROWS, key=["o_orderkey"])[1].select("column_name", "value", "digest")


_SKETCHED = {"documents": ("doc_id", "text", "lang", "source", "n_chars"), "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")}


@query("merged_sketches", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count({c}) AS non_null, "
    f"CAST(min(length(CAST({c} AS VARCHAR))) AS INTEGER) AS min_length, CAST(max(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length, "
    f"CAST(least(count({c}), {S.DEFAULT_OLTP_ROWS}) AS INTEGER) AS sampled, true AS distinct_close, true AS median_close FROM {t}"
    for t, cs in _SKETCHED.items() for c in cs))
def merged_sketches(spark: SparkSession, base: str) -> DataFrame:
    """Sketches of a first job, stored, and of the rows that came later, merged; estimates against the exact numbers."""
    out = []
    for t, columns in _SKETCHED.items():
        rows = D.load(spark, base, t).select(*columns)
        later = F.col(columns[0]) % 3 == 0
        sketch = lambda df: K.sketch_columns(df, t, key=[columns[0]], sample=S.DEFAULT_OLTP_ROWS)  # noqa: E731, B023
        stored = write_through(sketch(rows.where(~later)), "sketches")
        read = write_through(K.read_sketches(K.merge_sketches(stored.unionByName(sketch(rows.where(later)))), (0.5,)), "read")
        long = S.melt_columns(rows, t)
        size = F.char_length("value")
        half = F.broadcast(read.select("column_name", "length_p50"))  # one row for each column; values are not moved
        exact = long.join(half, "column_name").groupBy("column_name").agg(
            F.count_distinct(F.unhex(F.md5("value"))).alias("k"), (F.count_if(size <= F.col("length_p50")) / F.count("value")).alias("upto"),
            (F.count_if(size < F.col("length_p50")) / F.count("value")).alias("below"))
        out.append(read.join(exact, "column_name").select(
            "table_name", "column_name", "rows", "non_null", "min_length", "max_length", "sampled",
            (F.abs(F.col("distinct_values") - F.col("k")) <= F.greatest(F.lit(1), 0.08 * F.col("k"))).alias("distinct_close"),
            ((F.col("upto") >= 0.47) & (F.col("below") <= 0.53)).alias("median_close")))
    return reduce(DataFrame.unionByName, out)


TEXT_TABLES = {"documents": ("doc_id", "text", "lang", "source", "n_chars"), "pages": ("page_id", "url", "html"),
               "benchmark": ("item_id", "text"), "conversations": ("conv_id", "turn", "role", "text")}
_LEAVES = {"email": detectors.EMAIL_PRESENT, "phone": detectors.PHONE_PRESENT, "secret": r'"[0-9a-f]{40}"'}


def _profile_sql() -> str:
    parts = []
    for t, c in [(t, c) for t, columns in TEXT_TABLES.items() for c in columns]:
        v = f"CAST({c} AS VARCHAR)"
        counts = ", ".join(f"count_if(regexp_matches({v}, '{p}')) AS {n}" for n, p in _LEAVES.items())
        parts.append(
            f"SELECT 'tpch' AS database_name, 'main' AS schema_name, '{t}' AS table_name, '{c}' AS column_name, "
            f"count(*) AS sampled, count({c}) AS non_null, CAST(min(length({v})) AS INTEGER) AS min_length, "
            f"CAST(max(length({v})) AS INTEGER) AS max_length, {counts} FROM {t}")
    return " UNION ALL ".join(parts)


@query("profile_columns", _profile_sql())
def profile_columns(spark: SparkSession, base: str) -> DataFrame:
    longs = [S.melt_columns(D.load(spark, base, t), t) for t in TEXT_TABLES]
    counters: dict[str, Column] = {n: F.count_if(F.col("value").rlike(p)) for n, p in _LEAVES.items()}
    return S.profile_columns(reduce(DataFrame.unionByName, longs), counters)


# ── entities and content ────────────────────────────────────────────────────

_LUHN = """list_sum([CASE WHEN i % 2 = 1 THEN CAST(substr(h, length(h) - i, 1) AS INTEGER) * 2
    - CASE WHEN CAST(substr(h, length(h) - i, 1) AS INTEGER) > 4 THEN 9 ELSE 0 END
    ELSE CAST(substr(h, length(h) - i, 1) AS INTEGER) END for i in range(length(h))]) % 10 = 0"""


def _hits(pattern: str) -> str:
    return f"(SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS h FROM documents)"


@query("detect_entities", f"""
WITH hits AS (
  SELECT doc_id, 'EMAIL' AS entity_type, h AS hit, 95 AS score FROM {_hits(detectors.EMAIL)}
  UNION ALL SELECT doc_id, 'PHONE', h, 80 FROM {_hits(detectors.PHONE)}
    WHERE regexp_matches(h, '{detectors.PHONE_VALID}') AND length(regexp_replace(h, '[^0-9]', '', 'g')) BETWEEN 7 AND 15
  UNION ALL SELECT doc_id, 'CREDIT_DEBIT_NUMBER', h, CASE WHEN {_LUHN} THEN 99 ELSE 20 END
    FROM (SELECT doc_id, replace(replace(h, ' ', ''), '-', '') AS h FROM {_hits(detectors.DIGIT_RUN)}) WHERE length(h) BETWEEN 13 AND 19
  UNION ALL SELECT doc_id, 'SSN', h, 85 FROM {_hits(detectors.SSN)} WHERE regexp_matches(h, '{detectors.SSN_VALID}')
  UNION ALL SELECT doc_id, 'IP_ADDRESS', h, CASE WHEN regexp_matches(h, '{detectors.IP_VALID}') THEN 90 ELSE 10 END
    FROM {_hits(detectors.IP)}
  UNION ALL SELECT doc_id, 'SECRET_TOKEN', h, 90 FROM {_hits(detectors.SECRET)} WHERE length(h) = 40)
SELECT doc_id, lang, entity_type, hit, score FROM hits JOIN documents USING (doc_id) WHERE score >= 20""")
def detect_entities(spark: SparkSession, base: str) -> DataFrame:
    docs = D.load(spark, base, "documents").select("doc_id", "lang", "text")
    return C.detect_entities(docs, "text", minimum_score=0.2)


@query("detect_written_numbers", f"""
WITH t AS (SELECT o_orderkey AS doc_id, lpad(CAST(o_orderkey AS VARCHAR), 12, '4') AS d FROM orders),
h AS (SELECT doc_id, '4111' || d AS h FROM t UNION ALL SELECT doc_id, '4222' || d FROM t UNION ALL SELECT doc_id, '4333' || d FROM t)
SELECT doc_id, 'CREDIT_DEBIT_NUMBER' AS entity_type, h AS hit, CASE WHEN {_LUHN} THEN 99 ELSE 20 END AS score FROM h
UNION ALL SELECT doc_id, 'SSN', '123-45-' || right(d, 4), 85 FROM t""")
def detect_written_numbers(spark: SparkSession, base: str) -> DataFrame:
    """Card numbers with hyphens, with spaces and without; a security number, and one inside longer digits that is none."""
    d = F.lpad(F.col("o_orderkey").cast("string"), 12, "4")
    quads = lambda sep: [F.concat(F.lit(sep), F.substring(d, i, 4)) for i in (1, 5, 9)]
    text = F.concat(F.lit("pay 4111"), *quads("-"), F.lit(" or 4222"), *quads(" "), F.lit(" or 4333"), d,
                    F.lit("; ssn 123-45-"), F.right(d, F.lit(4)), F.lit(", part 9123-45-6789-0."))
    docs = D.load(spark, base, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"))
    found = C.detect_entities(docs, "text", minimum_score=0.2).where("entity_type IN ('CREDIT_DEBIT_NUMBER', 'SSN')")
    return found.select("doc_id", "entity_type", "hit", "score")


@query("content_types", """
SELECT event_id,
  coalesce(left(v, 1) IN ('{', '[') AND json_valid(v), false) AS is_json,
  regexp_matches(v, '^<[?!A-Za-z]') AND v LIKE '%>' AS is_xml,
  left(v, 1) NOT IN ('{', '[', '<') AND c1 >= 1 AND c1 = c2 AS is_csv
FROM (SELECT event_id, v, length(split_part(v, chr(10), 1)) - length(replace(split_part(v, chr(10), 1), ',', '')) AS c1,
        length(split_part(v, chr(10), 2)) - length(replace(split_part(v, chr(10), 2), ',', '')) AS c2
      FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '<e id="' || event_id || '"/>'
              WHEN 2 THEN event_type || ',' || user_id || chr(10) || 'x,' || event_id
              WHEN 3 THEN '{"k": ' ELSE CAST(user_id AS VARCHAR) END AS v FROM events))""")
def content_types(spark: SparkSession, base: str) -> DataFrame:
    e, n = D.load(spark, base, "events"), F.col("event_id")
    value = (
        F.when(n % 5 == 0, F.col("props")).when(n % 5 == 1, F.concat(F.lit('<e id="'), n.cast("string"), F.lit('"/>')))
        .when(n % 5 == 2, D.text(F.col("event_type"), ",", F.col("user_id"), "\nx,", n))
        .when(n % 5 == 3, F.lit('{"k": ')).otherwise(F.col("user_id").cast("string")))
    rows = e.select("event_id", value.alias("v"))
    return rows.select("event_id", *[
        is_format(F.col("v"), f).alias(f"is_{f.lower()}") for f in ("JSON", "XML", "CSV")])


# ── classification jobs ─────────────────────────────────────────────────────

COMPOUND = R.Classifier.of("MAIL_IN_TEXT", {
    "operator": "AND",
    "conditions": [
        {"target": "ROW_DATA", "pattern": detectors.EMAIL_PRESENT, "comparator": "matches", "minimum_threshold": 0.5},
        {"target": "METADATA", "comparator": "contains", "pattern": "TEXT"},
    ],
})
COLLECTION = (
    R.Classifier.of("EMAIL", pattern=detectors.EMAIL_PRESENT, minimum_threshold=1),
    R.Classifier.of("PHONE", pattern=detectors.PHONE_PRESENT, minimum_threshold=0.1),
    R.Classifier.of("SECRET_TOKEN", pattern=r'"[0-9a-f]{40}"', minimum_threshold=0.1),
    R.Classifier.of("NAME_LIKE", pattern=r"^Customer#", minimum_threshold=90),
    COMPOUND,
)
JOB_TABLES = {
    "documents": ("doc_id", "text", "lang", "source", "n_chars"), "pages": ("page_id", "url", "html"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "conversations": ("conv_id", "turn", "role", "text"),
}


def _measured_sql(tables: dict[str, tuple[str, ...]], patterns: dict[str, str]) -> str:
    parts = []
    for t, cols in tables.items():
        for c in cols:
            counts = ", ".join(
                f"count_if(regexp_matches(CAST({c} AS VARCHAR), '{p}')) AS {n}" for n, p in patterns.items())
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS sampled, "
                         f"count({c}) AS non_null, {counts} FROM {t}")
    return " UNION ALL ".join(parts)


_PATTERNS = {"email": detectors.EMAIL_PRESENT, "phone": detectors.PHONE_PRESENT, "secret": r'"[0-9a-f]{40}"', "cust": "^Customer#"}


def _classify_sql(where: str = "true") -> str:
    return f"""
WITH m AS ({_measured_sql(JOB_TABLES, _PATTERNS)}),
p AS (SELECT *, email * CAST(100.0 AS DOUBLE) / non_null AS pe, phone * CAST(100.0 AS DOUBLE) / non_null AS pp,
  secret * CAST(100.0 AS DOUBLE) / non_null AS ps, cust * CAST(100.0 AS DOUBLE) / non_null AS pc FROM m WHERE non_null > 0),
f AS (
  SELECT *, 'EMAIL' AS classifier_name, pe AS score FROM p WHERE pe >= 1
  UNION ALL SELECT *, 'PHONE', pp FROM p WHERE pp >= 0.1
  UNION ALL SELECT *, 'SECRET_TOKEN', ps FROM p WHERE ps >= 0.1
  UNION ALL SELECT *, 'NAME_LIKE', pc FROM p WHERE pc >= 90
  UNION ALL SELECT *, 'MAIL_IN_TEXT', pe FROM p WHERE pe >= 0.5 AND contains(lower(column_name), 'text'))
SELECT 'nightly' AS job_id, 'tpch' AS database_name, 'main' AS schema_name, table_name, column_name,
  classifier_name, score, sampled, non_null FROM f WHERE {where}"""


def _job_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    loaded = load_tables(spark, base, list(JOB_TABLES))
    return {t: loaded[t].select(*c) for t, c in JOB_TABLES.items()}


JOB = C.JobOptions(job_id="nightly", condition_types=("METADATA",))


@query("classify_documents", _classify_sql())
def classify_documents(spark: SparkSession, base: str) -> DataFrame:
    return C.classify(_job_tables(spark, base), COLLECTION, JOB)


@query("classify_default_targets", _classify_sql("classifier_name <> 'MAIL_IN_TEXT'"))
def classify_default_targets(spark: SparkSession, base: str) -> DataFrame:
    """Without METADATA in the job the compound tree is unknown, so it does not fire."""
    return C.classify(_job_tables(spark, base), COLLECTION, C.JobOptions(job_id="nightly"))


@query("classify_incremental", _classify_sql("table_name <> 'pages' AND column_name <> 'text'"))
def classify_incremental(spark: SparkSession, base: str) -> DataFrame:
    """Columns of an earlier job are left out before any data is read."""
    tables = _job_tables(spark, base)
    catalog = frames_catalog(spark, tables)
    seen = catalog.filter("table_name = 'pages' OR column_name = 'text'")
    todo = C.job_scope(catalog, seen, seen, "INCREMENTAL")
    scope: dict[str, list[str]] = {}
    # The catalog is the schema of the tables: one small row per column of the plan.
    for r in todo.select("table_name", "column_name", "ordinal").orderBy("table_name", "ordinal").collect():
        scope.setdefault(r["table_name"], []).append(r["column_name"])
    return C.classify(tables, COLLECTION, JOB, scope)


LEAF_MIX = (
    R.Classifier.of("LONG_TEXT", {"target": "DATA_LENGTH", "comparator": "greater_than", "length": 200,
                                  "trim": True, "minimum_threshold": 60}),
    R.Classifier.of("HTML", {"target": "CONTENT_TYPE", "content_formats": ["XML", "JSON"], "dominance_threshold": 50}),
    R.Classifier.of("CARDS", {"target": "AMAZON_COMPREHEND", "entity_type": "CREDIT_DEBIT_NUMBER", "minimum_score": 0.3}),
    R.Classifier.of("DOC_TABLE", {"operator": "OR", "conditions": [
        {"target": "COLUMN_LOCATION", "table": "documents", "comparator": "equals"},
        {"target": "METADATA", "comparator": "starts_with", "pattern": "URL"}]}),
    R.Classifier.of("NOT_ID", {"operator": "AND", "conditions": [
        {"target": "METADATA", "comparator": "ends_with", "pattern": "_id", "negated": True},
        {"target": "METADATA", "comparator": "matches", "pattern": "^(text|html|role)$"}]}),
    R.Classifier.of("SIZED", {"target": "COLUMN_SIZE", "comparator": "greater_than", "size": 10}),
)
_MIX_COLUMNS = {t: TEXT_TABLES[t] for t in ("documents", "pages", "conversations")}


def _mix_sql() -> str:
    parts = []
    for t, cols in _MIX_COLUMNS.items():
        for c in cols:
            v = f"CAST({c} AS VARCHAR)"
            cards = f"[CASE WHEN {_LUHN} THEN 99 ELSE 20 END for h in [regexp_replace(r, '[ -]', '', 'g') for r in regexp_extract_all({v}, '{detectors.DIGIT_RUN}')] if length(h) <= 19]"
            parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS sampled, count({c}) AS non_null,
  count_if(strlen(trim({v}, ' ')) > 200) AS long, count_if(regexp_matches(trim({v}, ' '), '^<[?!A-Za-z]') AND trim({v}, ' ') LIKE '%>') AS xml,
  CAST(sum(len({cards})) AS BIGINT) AS hits, CAST(sum(coalesce(list_sum({cards}), 0)) AS BIGINT) AS total FROM {t}""")
    return f"""
WITH m AS ({' UNION ALL '.join(parts)}),
f AS (
  SELECT *, 'LONG_TEXT' AS classifier_name, long * CAST(100.0 AS DOUBLE) / non_null AS score FROM m
    WHERE long * 100.0 / non_null >= 60
  UNION ALL SELECT *, 'HTML', xml * CAST(100.0 AS DOUBLE) / non_null FROM m WHERE xml * 100.0 / non_null >= 50
  UNION ALL SELECT *, 'CARDS', total / (hits * CAST(100.0 AS DOUBLE)) * 100.0 FROM m WHERE hits > 0 AND total / (hits * 100.0) >= 0.3
  UNION ALL SELECT *, 'DOC_TABLE', CAST(100.0 AS DOUBLE) FROM m WHERE table_name = 'documents' OR column_name = 'url'
  UNION ALL SELECT *, 'NOT_ID', CAST(100.0 AS DOUBLE) FROM m WHERE column_name IN ('text', 'html', 'role')
  UNION ALL SELECT *, 'SIZED', CAST(100.0 AS DOUBLE) FROM m WHERE table_name = 'documents' AND column_name = 'source')
SELECT 'mix' AS job_id, 'tpch' AS database_name, 'main' AS schema_name, table_name, column_name, classifier_name,
  CAST(score AS DOUBLE) AS score, sampled, non_null FROM f"""


@query("classify_leaf_targets", _mix_sql())
def classify_leaf_targets(spark: SparkSession, base: str) -> DataFrame:
    database = D.register_tables(spark, base, list(_MIX_COLUMNS))
    tables = {t: spark.table(f"{database}.{t}").select(*c) for t, c in _MIX_COLUMNS.items()}
    options = C.JobOptions(job_id="mix", condition_types=(
        "DATA_LENGTH", "CONTENT_TYPE", "AMAZON_COMPREHEND", "COLUMN_LOCATION", "METADATA", "COLUMN_SIZE"))
    return C.classify(tables, LEAF_MIX, options)


@query("ruleset_lineage", f"""
WITH m AS ({_measured_sql(JOB_TABLES, _PATTERNS)}),
leaf AS (SELECT *, email * CAST(100.0 AS DOUBLE) / non_null AS pe, contains(lower(column_name), 'text') AS named FROM m),
n AS (
  SELECT table_name, column_name, '0' AS path, 'AND' AS target, CAST(NULL AS DOUBLE) AS observed, pe >= 0.5 AND named AS r FROM leaf
  UNION ALL SELECT table_name, column_name, '0.0', 'ROW_DATA', pe, pe >= 0.5 FROM leaf
  UNION ALL SELECT table_name, column_name, '0.1', 'METADATA', NULL, named FROM leaf)
SELECT 'nightly' AS job_id, 'tpch' AS database_name, 'main' AS schema_name, table_name, column_name,
  'MAIL_IN_TEXT' AS classifier_name, path, target, observed, CASE WHEN r THEN 'TRUE' ELSE 'FALSE' END AS result FROM n""")
def ruleset_lineage(spark: SparkSession, base: str) -> DataFrame:
    return C.ruleset_lineage(_job_tables(spark, base), COMPOUND, JOB)


@query("job_scope_reclassification", f"""
WITH {D.FINDINGS}
SELECT column_id, column_name FROM inventory i WHERE EXISTS (
  SELECT 1 FROM findings f WHERE f.column_name = i.column_name AND f.score >= 10)""")
def job_scope_reclassification(spark: SparkSession, base: str) -> DataFrame:
    found = D.findings_log(spark, base).filter("score >= 10")
    inventory = D.inventory(spark, base)
    return C.job_scope(inventory, found, found, "RECLASSIFICATION").select("column_id", "column_name")


@query("managed_import_drift", """
WITH installed AS (
  SELECT c_name AS classifier_name, 'old' AS installed_stamp FROM customer
  UNION ALL SELECT unnest(['EMAIL', 'PHONE']), '2024-01-01T00:00:00Z' UNION ALL SELECT 'CARD', 'old'),
available AS (SELECT unnest(['EMAIL', 'PHONE', 'CARD', 'SSN', 'IP', 'SECRET_TOKEN']) AS classifier_name,
  '2024-01-01T00:00:00Z' AS available_stamp)
SELECT classifier_name, installed_stamp, available_stamp FROM installed FULL OUTER JOIN available USING (classifier_name)
WHERE installed_stamp IS DISTINCT FROM available_stamp""")
def managed_import_drift(spark: SparkSession, base: str) -> DataFrame:
    available = C.managed_classifiers(spark)
    custom = D.load(spark, base, "customer").select(F.col("c_name").alias("classifier_name"), F.lit("old").alias("stamp"))
    known = available.filter("classifier_name IN ('EMAIL', 'PHONE')").select("classifier_name", "stamp")
    stale = available.filter("classifier_name = 'CARD'").select("classifier_name", F.lit("old").alias("stamp"))
    return C.managed_drift(custom.unionByName(known).unionByName(stale), available)


@query("managed_import", """
SELECT c_name AS classifier_name, 'old' AS stamp FROM customer
UNION ALL SELECT unnest(['EMAIL', 'PHONE', 'CARD', 'SSN', 'IP', 'SECRET_TOKEN']), '2024-01-01T00:00:00Z'""")
def managed_import(spark: SparkSession, base: str) -> DataFrame:
    available = C.managed_classifiers(spark)
    custom = D.load(spark, base, "customer").select(
        F.col("c_name").alias("classifier_name"), F.lit("mine").alias("description"), F.lit("{}").alias("ruleset"),
        F.lit("old").alias("stamp"))
    stale = available.filter("classifier_name = 'CARD'").withColumn("stamp", F.lit("old"))
    return C.import_managed(custom.unionByName(stale), available).select("classifier_name", "stamp")


# ── findings and review ─────────────────────────────────────────────────────


def _reviewed(spark: SparkSession, base: str) -> DataFrame:
    return C.resolve_status(D.findings_log(spark, base), D.decisions(spark, base), ["decided_at", "decision_id"])


@query("job_summary", f"""
WITH {D.FINDINGS}
SELECT job_id, classifier_name, count(DISTINCT (database_name, schema_name, table_name, column_name)) AS columns
FROM findings GROUP BY ALL""")
def job_summary(spark: SparkSession, base: str) -> DataFrame:
    return C.job_summary(D.findings_log(spark, base))


@query("resolve_status", f"WITH {D.STATUS} SELECT job_id, column_name, classifier_name, score, status FROM reviewed")
def resolve_status(spark: SparkSession, base: str) -> DataFrame:
    return _reviewed(spark, base).select("job_id", "column_name", "classifier_name", "score", "status")


_COUNTS = ", ".join(f"count_if(status = '{s}') AS {s}" for s in ("approved", "rejected", "pending"))


@query("review_status", f"WITH {D.STATUS} SELECT job_id, count(*) AS total, {_COUNTS} FROM reviewed GROUP BY job_id")
def review_status(spark: SparkSession, base: str) -> DataFrame:
    return C.review_status(_reviewed(spark, base))


@query("findings_level_database", f"""
WITH {D.STATUS} SELECT job_id, database_name, count(*) AS findings, max(score) AS max_score, {_COUNTS}
FROM reviewed WHERE classifier_name IN ('EMAIL', 'CARD') GROUP BY ALL""")
def findings_level_database(spark: SparkSession, base: str) -> DataFrame:
    return C.findings_level(_reviewed(spark, base), "database", classifier_name=["EMAIL", "CARD"], with_counts=True)


@query("findings_level_column", f"""
WITH {D.STATUS} SELECT job_id, database_name, schema_name, table_name, column_name, count(*) AS findings,
  max(score) AS max_score
FROM reviewed WHERE database_name = 'db_1' AND status = 'approved' GROUP BY ALL""")
def findings_level_column(spark: SparkSession, base: str) -> DataFrame:
    return C.findings_level(_reviewed(spark, base), "column", {"database_name": "db_1"}, confirmed_status="approved")


@query("findings_rollup", f"""
WITH {D.STATUS}
SELECT job_id, database_name, schema_name, table_name, column_name, classifier_name,
  CAST(5 - bit_count(grouping(job_id, database_name, schema_name, table_name, column_name, classifier_name)) AS INTEGER) AS level,
  count(*) AS findings, max(score) AS max_score, {_COUNTS}
FROM reviewed
GROUP BY ROLLUP (job_id, database_name, schema_name, table_name, column_name, classifier_name)
HAVING job_id IS NOT NULL""")
def findings_rollup(spark: SparkSession, base: str) -> DataFrame:
    return C.findings_rollup(_reviewed(spark, base))


@query("revoke_decisions", f"""
WITH {D.DECISIONS} SELECT decision_id, job_id, confirmed_status FROM decisions
WHERE NOT (job_id = 'job_1' AND coalesce(database_name, '') = 'db_2')""")
def revoke_decisions(spark: SparkSession, base: str) -> DataFrame:
    return C.revoke_decisions(D.decisions(spark, base), "job_1", database_name="db_2").select(
        "decision_id", "job_id", "confirmed_status")


@query("record_decision", f"""
WITH {D.DECISIONS} SELECT decision_id, job_id, column_name, confirmed_status FROM decisions
UNION ALL SELECT o_orderkey + 1000000000, 'job_9', NULL, 'approved' FROM orders WHERE o_orderstatus = 'P'""")
def record_decision(spark: SparkSession, base: str) -> DataFrame:
    fresh = D.load(spark, base, "orders").filter("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") + 1000000000).alias("decision_id"), F.lit("job_9").alias("job_id"),
        *[F.lit(None).cast("string").alias(c) for c in C.SCOPE], F.lit("approved").alias("confirmed_status"),
        F.col("o_orderdate").alias("decided_at"))
    return C.record_decision(D.decisions(spark, base), fresh).select(
        "decision_id", "job_id", "column_name", "confirmed_status")


_TAG_MAP = [("EMAIL", "PII", "PII_EMAIL"), ("PHONE", "PII", "PII_PHONE"), ("CARD", "PCI", "CARD"), ("SSN", "GOV", "SSN")]


@query("propose_tags", f"""
WITH {D.STATUS}, tags AS (SELECT * FROM (VALUES {', '.join(str(t) for t in _TAG_MAP)}) t(classifier_name, tag_name, tag_value))
SELECT database_name, schema_name, table_name, column_name, tag_name, tag_value, max(score) AS score,
  tag_name NOT IN ('PII', 'GOV') AS tag_missing
FROM reviewed JOIN tags USING (classifier_name) WHERE status = 'approved' GROUP BY ALL""")
def propose_tags(spark: SparkSession, base: str) -> DataFrame:
    mapping = spark.createDataFrame(_TAG_MAP, "classifier_name string, tag_name string, tag_value string")
    known = spark.createDataFrame([("PII",), ("GOV",)], "tag_name string")
    return C.propose_tags(_reviewed(spark, base), mapping, known)


_SIZES_SQL = " ".join(f"WHEN table_name = '{t}' AND column_name = '{c}' THEN {n}" for (t, c), n in D.DECLARED.items())


@query("column_catalog", "SELECT *, CASE " + _SIZES_SQL + " END AS column_size FROM (" + " UNION ALL ".join(
    f"SELECT table_name, column_name, CAST(ordinal_position - 1 AS INTEGER) AS ordinal, n AS rows FROM "
    f"(SELECT '{t}' AS table_name, unnest(range(1, 1 + len(cs))) AS ordinal_position, unnest(cs) AS column_name, "
    f"(SELECT count(*) FROM {t}) AS n FROM (SELECT {list(c)} AS cs))"
    for t, c in JOB_TABLES.items()) + ")")
def column_catalog(spark: SparkSession, base: str) -> DataFrame:
    """Catalog of tables registered in the session's metastore, with declared lengths and the number of rows."""
    database = D.register_tables(spark, base, list(JOB_TABLES))
    sizes = reduce(DataFrame.unionByName, [
        spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(t)) for t in JOB_TABLES])
    catalog = read_catalog(spark, [database]).where(F.col("table_name").isin(*JOB_TABLES))
    return catalog.join(sizes, "table_name").select("table_name", "column_name", "ordinal", "rows", "column_size")


@query("classification_report", f"""
WITH {D.FINDINGS} SELECT job_id, database_name, schema_name, table_name, column_name, classifier_name AS classifier, score
FROM findings""")
def classification_report(spark: SparkSession, base: str) -> DataFrame:
    """The report as written to JSON, read back."""
    path = scratch_path(spark, "classification-report")
    write_classification_report(D.findings_log(spark, base), path)
    return spark.read.schema(
        "job_id string, database_name string, schema_name string, table_name string, column_name string, "
        "classifier string, score double").json(path)
