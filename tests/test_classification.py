import pytest
from pyspark.sql import functions as F

from wardlake.functions.content import is_format
from wardlake.operators import findings as C
from wardlake.operators import rulesets as R
from wardlake.operators import sampling as S
from wardlake.sources.tables import column_catalog, frames_catalog

ALL = ("ROW_DATA", "METADATA", "COLUMN_LOCATION", "CONTENT_TYPE", "DATA_LENGTH", "COLUMN_SIZE", "GDLP",
       "SNOWFLAKE_NATIVE", "AMAZON_COMPREHEND")


def fires(spark, values, ruleset, types=ALL, ddl="v string", kind="native"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    found = C.classify({"t": df}, [R.Classifier.of("c", ruleset)], C.JobOptions(job_kind=kind, condition_types=types))
    return found.count() == 1


def leaf(**kw):
    return kw


@pytest.mark.parametrize("values,ruleset,expected", [
    (["123-45-6789", "x"], leaf(target="ROW_DATA", pattern=r"\d{3}-\d{2}-\d{4}", minimum_threshold=50), True),
    (["123-45-6789", "x", "y"], leaf(target="ROW_DATA", pattern=r"\d{3}-\d{2}-\d{4}", minimum_threshold=50), False),
    (["123-45-6789", None, None], leaf(target="ROW_DATA", pattern=r"\d{3}-\d{2}", minimum_threshold=100), True),
    ([None], leaf(target="ROW_DATA", pattern="x", minimum_threshold=0), False),
    (["a"], leaf(target="METADATA", comparator="equals", pattern="V"), True),
    (["a"], leaf(target="METADATA", comparator="matches", pattern="^[u-w]$"), True),
    (["a"], leaf(target="METADATA", comparator="starts_with", pattern="x"), False),
    (["a"], leaf(target="METADATA", comparator="ends_with", pattern="x", negated=True), True),
    (["a"], leaf(target="COLUMN_LOCATION", database="TPCH", table="t"), True),
    (["a"], leaf(target="COLUMN_LOCATION", database="other"), False),
    (["ab ", "abc"], leaf(target="DATA_LENGTH", comparator="less_than", length=3, trim=True), False),
    (["ab ", "a"], leaf(target="DATA_LENGTH", comparator="less_than", length=3, trim=True), True),
    (["é"], leaf(target="DATA_LENGTH", comparator="equals", length=2), True),
    (['{"a":1}', "x"], leaf(target="CONTENT_TYPE", content_format="JSON", dominance_threshold=50), True),
    (['123', '"q"'], leaf(target="CONTENT_TYPE", content_format="JSON", dominance_threshold=1), False),
    (["joe@x.org and 1.2.3.4"], leaf(target="GDLP", info_type="EMAIL_ADDRESS"), True),
    (["4111111111111111"], leaf(target="AMAZON_COMPREHEND", entity_type="CREDIT_DEBIT_NUMBER", minimum_score=0.9), True),
    (["4111111111111112"], leaf(target="AMAZON_COMPREHEND", entity_type="CREDIT_DEBIT_NUMBER"), False),
    (["nothing"], leaf(target="SNOWFLAKE_NATIVE", entity_type="SSN"), False),
])
def test_leaf(spark, values, ruleset, expected):
    assert fires(spark, values, ruleset) is expected


def test_column_size(spark):
    rule = leaf(target="COLUMN_SIZE", comparator="greater_than", size=9)
    df = spark.createDataFrame([("a",)], "v string").select(F.lit(1).cast("decimal(12,2)").alias("v"))
    job = C.JobOptions(condition_types=ALL)
    assert C.classify({"t": df}, [R.Classifier.of("c", rule)], job).count() == 1
    assert not fires(spark, ["a"], rule)


def test_inactive_targets_are_unknown(spark):
    yes, meta = leaf(target="ROW_DATA", pattern="a", minimum_threshold=1), leaf(target="METADATA", comparator="equals", pattern="v")
    assert not fires(spark, ["a"], {"operator": "AND", "conditions": [yes, meta]}, types=None)
    assert fires(spark, ["a"], {"operator": "OR", "conditions": [yes, meta]}, types=None)
    assert not fires(spark, ["a"], {"operator": "AND", "conditions": [yes, {**meta, "negated": True}]}, types=None)
    assert R.active_targets("databricks") == frozenset({"GDLP", "METADATA", "COLUMN_LOCATION", "CONTENT_TYPE"})
    assert "GDLP" not in R.active_targets("native")
    with pytest.raises(ValueError, match="unknown condition types"):
        R.active_targets("native", ["NOPE"])


def test_nested_negated_group(spark):
    a, b = leaf(target="ROW_DATA", pattern="a", minimum_threshold=1), leaf(target="ROW_DATA", pattern="b", minimum_threshold=1)
    assert fires(spark, ["c"], {"operator": "OR", "negated": True, "conditions": [a, b]})
    assert not fires(spark, ["b"], {"operator": "AND", "conditions": [a, {"operator": "OR", "conditions": [a, b]}]})


def test_flat_form_equals_one_leaf():
    assert R.Classifier.of("x", pattern="p", minimum_threshold=70).tree == {
        "target": "ROW_DATA", "pattern": "p", "comparator": "matches", "minimum_threshold": 70}
    with pytest.raises(ValueError):
        R.Classifier.of("x")


def test_metadata_job_reads_no_data(spark, base):
    df = spark.read.parquet(f"{base}/documents.parquet")
    rule = [R.Classifier.of("c", leaf(target="METADATA", comparator="contains", pattern="text"))]
    found = C.classify({"documents": df}, rule, C.JobOptions(condition_types=("METADATA",)))
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["column_name"] for r in found.collect()] == ["text"]


def test_one_scan_and_one_shuffle_for_many_classifiers(spark, base):
    df = spark.read.parquet(f"{base}/documents.parquet").select("text", "lang")
    rules = [R.Classifier.of(f"c{i}", pattern=f"x{i}", minimum_threshold=1) for i in range(20)]
    plan = C.classify({"documents": df}, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("fmt,data", [
    ("PDF", b"%PDF-1.7 x"), ("PNG", b"\x89PNG\r\n\x1a\n..."), ("JPEG", b"\xff\xd8\xff\xe0"), ("GZIP", b"\x1f\x8b\x08"),
    ("PARQUET", b"PAR1...."), ("ZIP", b"PK\x03\x04plain.txt"), ("DOCX", b"PK\x03\x04..word/document.xml"),
    ("XLSX", b"PK\x03\x04..xl/workbook.xml"), ("JSON", b'[1, 2]'), ("XML", b"<a/>"), ("CSV", b"a,b\n1,2"),
])
def test_content_formats_exclude_each_other(spark, fmt, data):
    df = spark.createDataFrame([(bytearray(data),)], "v binary")
    from wardlake.functions.content import FORMATS
    row = df.select(*[F.coalesce(is_format(F.col("v"), f, binary=True), F.lit(False)).alias(f) for f in FORMATS]).first()
    assert [f for f in FORMATS if row[f]] == [fmt]


def test_sampling_strategies(spark):
    df = spark.range(1000)
    a = S.sample_rows(df, "ROWS", 10, ["id"]).collect()
    assert a == S.sample_rows(df.repartition(9), "row_count", 10, ["id"]).collect()
    assert S.sample_rows(df, "METADATA", 10, ["id"]).count() == 0
    assert S.sample_rows(df, "COMBINED", 10, ["id"]).count() == 10
    assert S.sample_rows(df, "ROW_PERCENT", 100, ["id"]).count() == 1000
    assert 50 < S.sample_rows(df, "ROW_PERCENT", 10, ["id"]).count() < 150
    for bad in (("PERCENTILE", 5), ("ROW_PERCENT", 101)):
        with pytest.raises(ValueError):
            S.sample_rows(df, *bad, ["id"])


def test_full_is_incremental_plus_seen(spark, base):
    catalog = frames_catalog(spark, {"documents": spark.read.parquet(f"{base}/documents.parquet")})
    seen = catalog.filter("ordinal < 2")
    todo = C.job_scope(catalog, seen, seen, "INCREMENTAL")
    assert todo.unionByName(seen).count() == C.job_scope(catalog, seen, seen, "FULL").count()
    assert todo.join(seen, ["table_name", "column_name"]).count() == 0
    with pytest.raises(ValueError):
        C.job_scope(catalog, seen, seen, "PARTIAL")


def test_catalog_of_session_tables(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS probe (a VARCHAR(12) COMMENT 'short', b DECIMAL(10, 2)) USING parquet")
    rows = {r["column_name"]: r for r in column_catalog(spark, ["default"]).filter("table_name = 'probe'").collect()}
    assert rows["a"]["column_size"] == 12 and rows["a"]["description"] == "short"
    assert rows["b"]["column_size"] == 10
    spark.sql("DROP TABLE probe")


DECISION_DDL = ("job_id string, database_name string, schema_name string, table_name string, column_name string, "
                "classifier_name string, confirmed_status string, decided_at int")


def decided(spark, decisions):
    f = spark.createDataFrame([("j", "d", "s", "t", c, k, 1.0) for c in "ab" for k in "XY"],
                              "job_id string, database_name string, schema_name string, table_name string, "
                              "column_name string, classifier_name string, score double")
    out = C.resolve_status(f, spark.createDataFrame(decisions, DECISION_DDL))
    return {r["column_name"] + r["classifier_name"]: r["status"] for r in out.collect()}


def test_specific_scope_wins_over_later_broad_one(spark):
    n = None
    assert decided(spark, [
        ("j", "d", "s", "t", "a", n, "approved", 1), ("j", "d", "s", "t", "a", "X", "rejected", 2),
        ("j", n, n, n, n, n, "rejected", 9), ("other", n, n, n, n, n, "approved", 10),
    ]) == {"aX": "rejected", "aY": "approved", "bX": "rejected", "bY": "rejected"}


def test_latest_decision_of_a_scope_wins_and_default_is_pending(spark):
    n = None
    assert decided(spark, [("j", "d", "s", "t", "b", n, "rejected", 2), ("j", "d", "s", "t", "b", n, "approved", 5)]) == {
        "aX": "pending", "aY": "pending", "bX": "approved", "bY": "approved"}


def test_scope_checks(spark):
    empty = spark.createDataFrame([], DECISION_DDL)
    with pytest.raises(ValueError, match="all levels"):
        C.revoke_decisions(empty, "j", table_name="t")
    bad = spark.createDataFrame([("j", None, "s", None, None, None, "approved", 1)], DECISION_DDL)
    with pytest.raises(Exception, match="proper scope"):
        C.record_decision(empty, bad).collect()


def test_managed_set(spark):
    managed = C.managed_classifiers(spark)
    again = C.import_managed(C.import_managed(managed.limit(0), managed), managed)
    assert again.count() == managed.count() == len(C.MANAGED)
    assert C.managed_drift(again, managed).count() == 0


def test_detector_plugin(spark):
    import pandas as pd

    @F.pandas_udf("array<struct<hit:string,score:int>>")
    def badges(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"hit": w, "score": 70} for w in t.split() if w.startswith("B-")])

    df = spark.createDataFrame([(1, "see B-12 and joe@x.org"), (2, "none")], "i int, t string")
    out = C.detect_entities(df, "t", ["EMAIL"], plugins={"BADGE": badges}).collect()
    assert sorted((r["i"], r["entity_type"], r["hit"], r["score"]) for r in out) == [
        (1, "BADGE", "B-12", 70), (1, "EMAIL", "joe@x.org", 95)]


def test_review_scopes_against_brute_force(spark):
    """Both ways, with a hot table, repeated findings, nulls in paths and a finding that carries a map."""
    import random

    rnd = random.Random(5)
    path = lambda: tuple(rnd.choice(x) for x in (("j", "k"), ("d", "e"), ("s", "t"), ("t", "t", "u"), "abc", "XY"))
    findings = [(*path(), i % 40) for i in range(600)] + [("j", "d", None, "t", "a", "X", 1), ("j", None, None, None, None, None, 2), (None, "d", "s", "t", "a", "X", 3)]
    decisions = []
    for i in range(90):
        p, depth = path(), rnd.choice([0, 1, 2, 3, 4, 5])
        decisions.append((*p[:1 + depth], *[None] * (5 - depth), rnd.choice(["approved", "rejected"]), i))
    decisions = rnd.sample(decisions, 40)
    want = []
    for f in findings:
        holding = [d for d in decisions if f[0] is not None and all(a is None or a == b for a, b in zip(d[:6], f[:6]))]
        best = max(holding, key=lambda d: (sum(x is not None for x in d[:6]), d[7]), default=None)
        want.append((f, best[6] if best else "pending"))
    ddl = "job_id string, database_name string, schema_name string, table_name string, column_name string, classifier_name string, n int"
    frame = spark.createDataFrame(findings, ddl).withColumn("extra", F.create_map(F.lit("a"), F.col("n")))
    log = spark.createDataFrame(decisions, DECISION_DDL)
    for limit in (C.DECISION_BYTES, 0):
        got = C.resolve_status(frame, log, broadcast_bytes=limit)
        assert got.columns == [*frame.columns, "status"]
        rows = [(tuple(r)[:7], r["status"]) for r in got.collect()]
        assert sorted(rows, key=str) == sorted(want, key=str)
        none = C.resolve_status(frame, log.limit(0), broadcast_bytes=limit)
        assert {r["status"] for r in none.collect()} == {"pending"}
    assert {s for _, s in want} == {"approved", "rejected", "pending"}


def test_review_reads_findings_once_and_does_not_move_them(spark, base):
    findings = spark.read.parquet(f"{base}/documents.parquet").selectExpr(
        "'j' AS job_id", "lang AS database_name", "source AS schema_name", "'t' AS table_name", "'c' AS column_name", "'X' AS classifier_name")
    log = spark.createDataFrame([("j", "en", None, None, None, None, "approved", 1), ("j", None, None, None, None, None, "rejected", 1)], DECISION_DDL)
    plan = C.resolve_status(findings, log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("documents.parquet") == 1 and "Generate" not in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("text,hits", [
    ("call 555-123-4567.", ["555-123-4567"]), ("+49 30 1234567 or +1 (555) 123-4567", ["+49 30 1234567", "+1 (555) 123-4567"]),
    ("(555) 123-4567, 1-555-123-4567, 555.123.4567", ["(555) 123-4567", "1-555-123-4567", "555.123.4567"]),
    ("4111-1111-1111-1111 and 2024-01-02 and 9123-45-6789-0 and +12", []), ("555-123-4567-8901", []),
])
def test_phone_forms(spark, text, hits):
    df = spark.createDataFrame([(text,)], "t string")
    assert [r["hit"] for r in C.detect_entities(df, "t", ["PHONE"]).collect()] == hits


def test_ip_boundaries(spark):
    df = spark.createDataFrame([("1.2.3.4.5 then 10.0.0.1. or 300.1.1.1",)], "t string")
    assert {r["hit"]: r["score"] for r in C.detect_entities(df, "t", ["IP_ADDRESS"], minimum_score=0).collect()} == {
        "1.2.3.4.5": 10, "10.0.0.1": 90, "300.1.1.1": 10}


# Sketches


def test_column_samples(spark):
    """The least digests of each column, whatever the layout, with hot rows and a sparse column."""
    import hashlib

    rows = [(i, "same" if i % 3 else f"v{i}", i if i % 50 == 0 else None) for i in range(900)] + [(7, "dup", None)] * 500
    df = spark.createDataFrame(rows, "id int, t string, sparse int")
    long, got = S.sample_columns(df, "t", 20, key=["id", "t"])
    again = S.sample_columns(df.repartition(7).select("sparse", "id", "t"), "t", 20, ["id", "t", "sparse"], ["id", "t"])[1]
    assert long.count() == 3 * len(rows)
    for column, of in (("id", 0), ("t", 1), ("sparse", 2)):
        want = sorted((hashlib.md5(f"0|{column}|{r[0]}|{r[1]}".encode()).hexdigest(), str(r[of])) for r in rows if r[of] is not None)[:20]
        for frame in (got, again):
            assert sorted((r["digest"], r["value"]) for r in frame.where(F.col("column_name") == column).collect()) == want
    assert S.sample_columns(df.limit(0), "t", 20)[1].count() == 0
    few = S.sample_columns(spark.createDataFrame([(None, "a")], "n int, t string"), "t", 5)[1].collect()
    assert [(r["column_name"], r["value"]) for r in few] == [("t", "a")]


def test_sampled_job_takes_values_of_each_column(spark):
    df = spark.createDataFrame([(i, "joe@x.org" if i % 40 == 0 else None) for i in range(4000)], "id int, mail string")
    found = C.classify({"t": df}, [R.Classifier.of("EMAIL", pattern="@", minimum_threshold=90)], C.JobOptions(strategy="ROWS", size=30)).collect()
    assert [(r["column_name"], r["sampled"], r["score"]) for r in found] == [("mail", 30, 100.0)]


def test_sketches_merge_and_keep_their_bounds(spark):
    from wardlake.operators import sketches as K

    n = 40_000
    df = spark.range(n).selectExpr("id", "id % 5000 AS group", "repeat('x', CAST(id % 97 AS INT)) AS word",
                                   "CASE WHEN id % 10 = 0 THEN 'a@b.org' ELSE 'none' END AS mail", "CAST(NULL AS STRING) AS empty")
    parts = [df.where(f"id % 4 = {k}") for k in range(4)]
    stored = K.sketch_columns(parts[0], "t", sample=500)
    for part in parts[1:]:
        stored = K.merge_sketches(stored.unionByName(K.sketch_columns(part, "t", sample=500)))
    whole = {r["column_name"]: r.asDict() for r in K.sketch_columns(df, "t", sample=500).collect()}
    merged = {r["column_name"]: r.asDict() for r in stored.collect()}
    assert set(merged) == set(whole) == set(df.columns)
    for name in df.columns:
        assert all(merged[name][c] == whole[name][c] for c in ("rows", "non_null", "min_length", "max_length", "sample")), name
    read = {r["column_name"]: r for r in K.read_sketches(stored, (0.5, 0.9)).collect()}
    for name, distinct in (("id", n), ("group", 5000), ("word", 97), ("mail", 2), ("empty", 0)):
        assert abs(read[name]["distinct_values"] - distinct) <= 0.05 * distinct
    assert abs(read["word"]["length_p50"] - 48) <= 4 and abs(read["word"]["length_p90"] - 87) <= 4
    assert abs(read["id"]["number_p50"] - n / 2) <= 0.04 * n and read["mail"]["number_p50"] is None
    assert read["empty"]["length_p50"] is None and read["empty"]["sampled"] == 0 and read["id"]["sampled"] == 500
    share = {r["column_name"]: r["share"] for r in K.sample_share(stored, F.contains("value", F.lit("@"))).collect()}
    assert share["id"] == 0 and abs(share["mail"] - 0.1) < 0.06


def test_detector_limits_reach_jobs_and_entities(spark):
    token = "0123456789abcdef" * 4
    df = spark.createDataFrame([(f"key {token}",)], "t string")
    assert C.detect_entities(df, "t", ["SECRET_TOKEN"]).count() == 0
    assert [r["hit"] for r in C.detect_entities(df, "t", ["SECRET_TOKEN"], secret_digits=(40, 64)).collect()] == [token]
    leaf_of = lambda **k: leaf(target="AMAZON_COMPREHEND", entity_type="SECRET_TOKEN", minimum_score=0.5, **k)
    assert not fires(spark, [token], leaf_of()) and fires(spark, [token], leaf_of(secret_digits=[40, 64]))


def test_exact_counts_beside_sketches_do_not_move_values_by_column(spark, tmp_path):
    from wardlake.plans import classification_queries as Q

    words = "'w' || (id % 40) AS {}"
    spark.range(300).selectExpr("id AS doc_id", words.format("text"), words.format("lang"), "'web' AS source", "id AS n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(300).selectExpr("id AS c_custkey", words.format("c_name"), "id % 5 AS c_nationkey", words.format("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.merged_sketches(spark, str(tmp_path))
        # of each table only the few rows of its columns are joined by a sort
        assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
        rows = {(r["table_name"], r["column_name"]): r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert len(rows) == 9 and all(r["rows"] == 300 and r["distinct_close"] for r in rows.values())
    assert rows["documents", "text"]["sampled"] == 300


def test_decisions_on_columns_and_classifiers_need_no_sorted_paths(spark):
    path = "job_id string, database_name string, schema_name string, table_name string, column_name string, classifier_name string"
    rows = [("j", f"d{d}", "s", f"t{t}", f"c{c}", k) for d in range(3) for t in range(3) for c in range(4) for k in ("A", "B", None)]
    findings = spark.createDataFrame(rows + rows[:7] + [("j", "d0", None, "t0", "c0", "A"), (None, "d0", "s", "t0", "c0", "A")], path)
    scopes = [("j",) + (None,) * 5, ("j", "d1") + (None,) * 4, ("j", "d1", "s", "t1", None, None), ("j", "d0", "s", "t0", "c0", None),
              ("j", "d0", "s", "t0", "c0", "A"), ("j", "d1", "s", "t1", "c2", "B"), ("j", "d2", "s", "t2", "c3", None), ("j", "d2", "s", None, "c3", "A"),
              ("j", "d0", None, "t0", "c0", None), ("k", "d0", "s", "t0", "c0", "B")]
    decisions = spark.createDataFrame([(*s, ("approved", "rejected")[(i + n) % 2], n) for i, s in enumerate(scopes) for n in (1, 2)],
                                      f"{path}, confirmed_status string, decided_at int")
    seen = lambda df: sorted(map(str, df.collect()))
    sent = C.resolve_status(findings, decisions)
    for limit, sorts in ((450, False), (0, True)):
        got = C.resolve_status(findings, decisions, broadcast_bytes=limit)
        assert ("Window" in got._jdf.queryExecution().executedPlan().toString()) == sorts, limit
        assert seen(got) == seen(sent), limit
