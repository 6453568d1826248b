import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wardlake.operators import audits as A
from wardlake.operators import common as G
from wardlake.operators import access as P
from wardlake.operators.fleet import latest_instances
from wardlake.sources import audit_log as L
from wardlake.sources.policy_rules import explode_rules
from wardlake.sources.sinks import write_report
from wardlake.streaming import live as X

EVENT = {
    "event_id": "evt-1", "event_name": "Query", "event_source": "sidecar", "event_time": "2025-01-15T10:30:00Z",
    "event_time_nano_seconds": 5, "client": {"connection_id": "c", "connection_time": "2025-01-15T10:29:58Z", "host": "10.0.0.1", "port": 5432},
    "repo": {"name": "EMPLOYEES", "type": "Postgres"},
    "user_identity": {"repo_user": "db", "consuming_user": {"username": "alice", "email": "a@x.org", "user_groups": ["g"]}},
    "statement_request": {"statement": "SELECT 1", "statement_type": "SELECT", "applied_policy_result": {"block": False},
                          "scanned_columns": [], "response": {"success": True, "execution_time": "0.023s", "records": 42, "bytes": 1024}},
}


def test_read_nested_events(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps(EVENT) + "\n{broken\n")
    rows = L.flatten_audit_events(L.read_audit_events(spark, str(tmp_path))).filter("event_id IS NOT NULL").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["consuming_user"], r["row_count"], r["execution_seconds"], r["repo_name"]) == ("alice", 42, 0.023, "EMPLOYEES")
    assert r["event_time"] == dt.datetime(2025, 1, 15, 10, 30)


def test_scalar_filter_equals_one_element_list(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps(EVENT))
    events = L.read_audit_events(spark, str(tmp_path))
    for value in ("ALICE", ["alice"], ["x", "Alice"]):
        assert A.search_audits(events, consuming_user=value).count() == 1
    assert A.search_audits(events, consuming_user="bob").count() == 0
    assert A.search_audits(events, query_id="evt-1", statement_text_contains="select").count() == 1
    assert A.search_audits(events, table_name="t").count() == 0


def test_search_checks(spark):
    empty = spark.createDataFrame([], "event_id string, event_time timestamp, category string, query_id string, rows_accessed long")
    now = dt.datetime(2024, 1, 10)
    for call in (lambda: A.search_audits(empty, limit=0), lambda: A.search_audits(empty, sort_by="x"),
                 lambda: A.search_query_audits(empty, limit=-1),
                 lambda: A.search_query_audits(empty, now=now, to_date_time=now + dt.timedelta(1)),
                 lambda: A.search_query_audits(empty, nope="x"),
                 lambda: A.search_system_audits(empty, "Nope"), lambda: A.search_system_audits(empty, "Data", limit=0)):
        with pytest.raises(ValueError):
            call()


def test_search_expires_after_thirty_days(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, i)) for i in range(5)], "event_id int, event_time timestamp")
    root = str(tmp_path / "s")
    A.save_search(df, "a", root, dt.date(2024, 1, 1))
    assert [r["event_id"] for r in A.read_search(spark, root, "a", dt.date(2024, 1, 31), limit=2, token=2).collect()] == [2, 1]
    assert A.read_search(spark, root, "a", dt.date(2024, 2, 1)).count() == 0
    assert A.read_search(spark, root, "b", dt.date(2024, 1, 1)).count() == 0
    A.save_search(df, "b", root, dt.date(2024, 1, 1))
    A.save_search(df, "a", root, dt.date(2024, 1, 1))  # the same search again replaces itself, and nothing else
    assert A.read_search(spark, root, "a", dt.date(2024, 1, 2), limit=1000).count() == 5
    assert A.read_search(spark, root, "b", dt.date(2024, 1, 2), limit=1000).count() == 5


def test_postgres_prefixes(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        "2024-05-01 10:00:00.123 UTC [12] bob@shop 10.1.1.1 LOG:  statement: SELECT * FROM t\n"
        "2024-05-01 10:00:01.000 UTC [12] bob@shop 10.1.1.1 LOG:  execute s1: update t set a = 1\n"
        "2024-05-01 10:00:02.000 UTC [12] bob@shop 10.1.1.1 ERROR:  permission denied for table t\n"
        "2024-05-01 10:00:03.000 UTC [1] bob@shop 10.1.1.1 LOG:  checkpoint starting\n    continued\n")
    out = L.ingest_native_audit_log(spark, str(tmp_path), "postgresql", "log", "%m [%p] %u@%d %h ").orderBy("event_time").collect()
    assert [(r["repo_user"], r["database_name"], r["client_host"], r["statement_type"], r["execution_success"]) for r in out] == [
        ("bob", "shop", "10.1.1.1", "SELECT", True), ("bob", "shop", "10.1.1.1", "UPDATE", True), ("bob", "shop", "10.1.1.1", None, False)]
    later = L.ingest_native_audit_log(spark, str(tmp_path), "postgresql", "log", "%m [%p] %u@%d %h ",
                                      F.lit("2024-05-01 10:00:01").cast("timestamp"))
    assert later.count() == 2
    with pytest.raises(ValueError, match="not supported"):
        L.prefix_pattern("%Z ")
    with pytest.raises(ValueError, match="no native log reader"):
        L.ingest_native_audit_log(spark, str(tmp_path), "mssql", "log")


def test_postgres_csv_and_json(spark, tmp_path):
    csv, js = tmp_path / "c", tmp_path / "j"
    csv.mkdir(), js.mkdir()
    row = ["2024-05-01 10:00:00.5 UTC", "bob", "shop", "1", "10.1.1.1:99", "s", "1", "SELECT", "", "", "", "LOG", "00000",
           '"statement: SELECT ""a"",\n b FROM t"'] + [""] * 8 + ["psql", "client", "", "1"]
    (csv / "a.csv").write_text(",".join(row) + "\n")
    (js / "a.json").write_text(json.dumps({"timestamp": "2024-05-01 10:00:00.5 UTC", "user": "bob", "dbname": "shop",
                                           "remote_host": "10.1.1.1", "error_severity": "ERROR", "message": "denied", "statement": "DELETE FROM t"}))
    a = L.ingest_native_audit_log(spark, str(csv), "postgresql", "csv").first()
    b = L.ingest_native_audit_log(spark, str(js), "postgresql", "json").first()
    assert (a["statement_text"], a["client_host"], a["execution_success"]) == ('SELECT "a",\n b FROM t', "10.1.1.1", True)
    assert (b["statement_text"], b["statement_type"], b["execution_success"]) == ("DELETE FROM t", "DELETE", False)


def test_mysql_lines(spark, tmp_path):
    (tmp_path / "q.log").write_text("2024-05-01T10:00:00.000001Z\t    8 Query\tselect 1\n2024-05-01T10:00:01Z\t 8 Quit\t\nnoise\n")
    out = L.ingest_native_audit_log(spark, str(tmp_path), "mysql", "log").collect()
    assert [(r["statement_text"], r["statement_type"]) for r in out] == [("select 1", "SELECT")]


def test_records_across_blocks(spark, tmp_path):
    """Blocks of a few bytes: most borders lie inside a statement."""
    log = "".join(f"2024-05-01 10:00:{i:02d} UTC [1] u{i}@d LOG:  statement: select {i},\n  'a',\n\n  b{i}\nfrom t\n" for i in range(40))
    (tmp_path / "a.log").write_text(log)
    thread = "2024-05-01T10:00:00Z\t 8 Connect\tbob@host on shop using TCP/IP\n" + "".join(
        f"2024-05-01T10:00:01Z\t 8 Query\tselect {i}\n from t\n" for i in range(30))
    (tmp_path / "q.txt").write_text(thread)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    try:
        pg = L.ingest_native_audit_log(spark, str(tmp_path / "a.log"), "postgresql", "log", "%t [%p] %u@%d ").collect()
        my = L.ingest_native_audit_log(spark, str(tmp_path / "q.txt"), "mysql", "log").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {(r["repo_user"], r["statement_text"]) for r in pg} == {(f"u{i}", f"select {i},\n  'a',\n\n  b{i}\nfrom t") for i in range(40)}
    assert len(pg) == 40
    assert sorted((r["repo_user"], r["client_host"], r["statement_text"]) for r in my) == sorted(
        ("bob", "host", f"select {i}\n from t") for i in range(30))


def test_rules_of_several_pages(spark):
    def rule(level):
        return {"rule_id": "r", "role": "A", "tag_value": "T", "success_rule_json": {"masking_policy": level}}

    pages = spark.createDataFrame([(1, json.dumps({"h1": [rule("10001")], "h2": [rule("10002")]})),
                                   (2, json.dumps({"h1": [rule("10003")], "h3": [rule(None)]}))], "page int, items string")
    out = explode_rules(pages, page=F.col("page")).collect()
    assert sorted((r["rule_key"], r["masking_policy"]) for r in out) == [("h1", 10003), ("h2", 10002)]


def test_keyset_pages_concatenate_to_the_whole_list(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(23)], "a int, b int")
    for order in ("asc", "desc"):
        seen, cursor = [], None
        while True:
            page, cursor = G.keyset_page(df, ["a", "b"], cursor, 5, order)
            seen += [tuple(r) for r in page.collect()]
            if cursor is None:
                break
        assert seen == sorted([(i % 4, i) for i in range(23)], reverse=order == "desc")


def test_patch_needs_a_field(spark):
    df = spark.createDataFrame([(1, "a", 2)], "k int, s string, n int")
    with pytest.raises(ValueError, match="at least one field"):
        G.patch_rows(df, df.select("k"), ["k"])
    patched = G.patch_rows(df, spark.createDataFrame([(1, None, 5)], "k int, s string, n int"), ["k"])
    assert patched.first() == (1, "a", 5)
    with pytest.raises(ValueError):
        G.sort_limit_offset(df, ["k"], "n", "sideways")


def test_lookup_of_unknown_name(spark):
    reg = spark.createDataFrame([("a", 1)], "name string, id int")
    out = G.lookup_by_name(reg, spark.createDataFrame([("a",), ("z",)], "name string"), "name", ["id"]).orderBy("name").collect()
    assert [(r["id"], r["found"]) for r in out] == [(1, True), (None, False)]


def test_report_format(spark):
    with pytest.raises(ValueError):
        write_report(spark.range(1), "/tmp/none", "pdf")


def test_closed_request_does_not_change(spark):
    rows = [("q", 1, "submit"), ("q", 2, "approve"), ("q", 3, "complete_approve"), ("q", 4, "deny"), ("q", 5, "complete_deny"),
            ("p", 1, "submit"), ("p", 2, "deny")]
    df = spark.createDataFrame([(r, t, t, a, "me", f"why {t}") for r, t, a in rows],
                               "request_id string, ts int, event_id int, action string, requester string, justification string")
    out = {r["request_id"]: r for r in P.request_state(df).collect()}
    assert (out["q"]["status"], out["q"]["reviewer_justification"], out["q"]["requester_justification"]) == ("CLOSED_APPROVED", "why 3", "why 1")
    assert out["p"]["status"] == "PENDING_DENIED"


def test_request_states_are_ten():
    assert set(P.ACTION_STATES.values()) == set(P.REQUEST_STATES) and len(P.REQUEST_STATES) == 10


def test_grants_have_no_nested_loop(spark):
    from wardlake.plans.access_queries import grants
    plan = grants(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_running_instances(spark):
    df = spark.createDataFrame([("a", "i", dt.datetime(2024, 1, 1, 0, m)) for m in (0, 5)], "agent_id string, instance_id string, checkin_time timestamp")
    now = F.lit(dt.datetime(2024, 1, 1, 0, 10))
    row = latest_instances(df, "agent_id", now, 300).first()
    assert (row["age_seconds"], row["running"]) == (300, True)
    assert latest_instances(df, "agent_id", now, 299).first()["running"] is False


# ── streams over several files ──────────────────────────────────────────────


def write_batches(spark, path, ddl, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def test_stream_throttle_keeps_state_between_batches(spark, tmp_path):
    """Each part is a micro-batch of its own and a new start from the checkpoint."""
    ddl = "definition_id string, ts timestamp, event_id long"
    t0 = dt.datetime(2024, 1, 1)
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    parts = [
        [("a", 0, 0), ("a", 100, 1), ("b", 50, 2), (None, 60, 13)],
        [("a", 350, 3), ("a", 700, 4), ("a", 340, 14)],  # in the order of time inside a batch
        [("a", 20_000, 5), ("b", 60, 6), ("a", 900, 7)],  # older than the last acceptance, or inside its interval
        [("a", 20_100, 8), ("c", 17_000, 9), ("c", 17_100, 10), ("a", 300, 11), ("c", 16_000, 12)],  # the last two are behind the watermark
        [("b", 20_200, 15), ("a", 20_300, 16)],  # b's state went with its timer
    ]
    for part in parts:
        spark.createDataFrame([(k, t0 + dt.timedelta(seconds=s), e) for k, s, e in part], ddl).coalesce(1).write.mode("append").parquet(src)
        got = X.run_to_files(X.stream_throttle(spark.readStream.schema(ddl).parquet(src)), out, cp)
    verdicts = {r["event_id"]: r["accepted"] for r in got.collect()}
    assert {e for e, ok in verdicts.items() if ok} == {0, 2, 14, 4, 5, 9, 15, 16}
    assert {e for e, ok in verdicts.items() if not ok} >= {1, 3, 6, 7, 8, 10} and got.count() == len(verdicts)
    again = X.run_to_files(X.stream_throttle(spark.readStream.schema(ddl).parquet(src)), out, cp)
    assert {r["event_id"]: r["accepted"] for r in again.collect()} == verdicts


def test_stream_tokenize_reads_a_pair_once(spark, tmp_path):
    """Batches write their own pairs only; reading and compacting give each once, and a compaction counts from its end on."""
    src, root, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    assert X.read_vault(spark, root).count() == 0 and X.compact_vault(spark, root) is None
    for n, values in enumerate((["x", "y"], ["y", "z"], ["z", "x", "w"])):
        spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).write.mode("append").parquet(src)
        X.stream_tokenize(spark.readStream.schema("v string").parquet(src), ["v"], root, cp, secret="k").awaitTermination()
        assert spark.read.parquet(f"{root}/log/batch={n}").count() == len(values)
        if n == 1:
            assert X.compact_vault(spark, root) == X.compact_vault(spark, root) == 1
            assert spark.read.parquet(f"{root}/compacted/upto=1").count() == 3
    assert sorted(r["value"] for r in X.read_vault(spark, root).collect()) == ["w", "x", "y", "z"]
    assert X.compact_vault(spark, root) == 2
    spark.read.parquet(f"{root}/log/batch=2").withColumn("value", F.lit("late")).write.mode("append").partitionBy("bucket").parquet(f"{root}/log/batch=1")
    assert sorted(r["value"] for r in X.read_vault(spark, root).collect()) == ["w", "x", "y", "z"]  # batches of the compaction are not read
    assert spark.read.parquet(f"{root}/rows").count() == 7

@pytest.mark.parametrize("order", ["asc", "desc"])
def test_deep_pages(spark, monkeypatch, order):
    """Pages of every depth, with nulls, equal keys and few different values in front."""
    monkeypatch.setattr(G, "DEEP_OFFSET", 40)
    monkeypatch.setattr(G, "SAMPLED_KEYS", 300)
    rows = [(None if i % 11 == 0 else (7 if i % 3 else i % 97), f"k{i:05d}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "n int, k string, t timestamp_ntz").repartition(5)
    least = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(rows, key=least, reverse=order == "desc")
    for offset in (41, 500, 1999, 3500, 3990, 4000, 9000):
        got = G.sort_limit_offset(df, ["k"], "n", order, 20, offset).collect()
        assert [r["k"] for r in got] == [r[1] for r in want[offset:offset + 20]], offset
    part, before = G.page_range(df, ["t"], False, 3000, 10)
    assert part.count() < 400 and 2600 < before <= 3000


@pytest.mark.parametrize("block", ["300", "2000", "128m"])
def test_streamed_logs_equal_batch_whatever_the_blocks(spark, tmp_path, block):
    """Statements cross block borders, one is longer than several blocks; threads connect in earlier blocks; files come in two batches."""
    long = "\n".join(f"  col_{i}," for i in range(120))
    pg, my = [], []
    for i in range(80):
        body = long if i == 40 else "\n".join(f"  part {k}" for k in range(i % 5))
        pg.append(f"2024-01-01 00:00:{i % 60:02d} UTC [7] u{i}@d LOG:  statement: select {i}\n{body}\n\nfrom t")
        if i < 8:
            my.append(f"2024-01-01T00:00:00.000000Z\t{i} Connect\tuser{i}@h on d using TCP/IP")
        my.append(f"2024-01-01T00:00:{i % 60:02d}.000000Z\t{i % 8} Query\tselect {i}\n{body}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for kind, lines, prefix in (("postgresql", pg, "%t [%p] %u@%d "), ("mysql", my, "")):
            src, out, cp = (tmp_path / f"{kind}-{n}" for n in ("in", "out", "cp"))
            src.mkdir()
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            for n, part in enumerate((lines[:30], lines[30:])):
                if kind == "mysql" and n:
                    part = [x for x in lines if "Connect" in x] + part
                (src / f"log{n}.txt").write_text("\n".join(part) + "\n")
                L.stream_native_log(spark, str(src), kind, "log", str(out), str(cp), prefix).awaitTermination()
            got = [(r["repo_user"], r["statement_text"]) for r in spark.read.parquet(str(out)).collect()]
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
            whole = L.ingest_native_audit_log(spark, str(src), kind, "log", prefix)
            want = [(r["repo_user"], r["statement_text"]) for r in whole.collect()]
            assert sorted(got) == sorted(want) and len(got) >= 80 and all(u for u, _ in got)
            assert any("col_119" in t for _, t in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError, match="stream_native_log"):
        L.ingest_native_audit_log(spark, str(tmp_path), "mysql", "log", stream=True)
