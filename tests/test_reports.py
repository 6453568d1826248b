import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlake.functions.cron import parse_cron
from wardlake.functions.filters import compile_filters
from wardlake.operators import reports as R


def brute_throttle(rows, seconds, last=None):
    out = {}
    state = dict(last or {})
    for key, ts, tie in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        ok = key not in state or (ts - state[key]).total_seconds() >= seconds
        if ok:
            state[key] = ts
        out[(key, tie)] = ok
    return out


@pytest.mark.parametrize("seed,step,seconds", [(1, 40, 300), (2, 290, 300), (3, 5, 300), (4, 1000, 300), (5, 150, 300), (6, 60, 1), (7, 1, 3000)])
def test_throttle_against_brute_force(spark, seed, step, seconds):
    random.seed(seed)
    start, rows, n = dt.datetime(2024, 1, 1), [], 0
    for key in ("hot", "b", "c"):
        t = start
        for _ in range(400 if key == "hot" else 20):
            t += dt.timedelta(microseconds=random.choice([0, 1, random.randint(0, step * 2_000_000)]))
            rows.append((key, t, n))
            n += 1
    df = spark.createDataFrame(rows, "definition_id string, ts timestamp_ntz, event_id long")
    want = brute_throttle(rows, seconds)
    for per_task in (20, 100, 10_000):  # ranges far narrower than the interval, and one range for all
        got = R.throttle_triggers(df, seconds=seconds, rows_per_task=per_task).collect()
        assert {(r["definition_id"], r["event_id"]): r["accepted"] for r in got} == want


def test_throttle_exact_border(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), s) for s in (0, 100, 350, 700, 900, 1001)]
    got = R.throttle_triggers(spark.createDataFrame(rows, "definition_id string, ts timestamp, event_id long"))
    assert sorted(r["event_id"] for r in got.filter("accepted").collect()) == [0, 350, 700, 1001]


def test_throttle_continues_from_earlier_data(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, s), s) for s in (10, 40)]
    df = spark.createDataFrame(rows, "definition_id string, ts timestamp, event_id long")
    state = df.limit(1).select(F.lit("a").alias("key"), F.lit(int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() - 270) * 1_000_000).alias("state"))
    got = R.throttle_triggers(df, last_accepted=state)
    assert [r["event_id"] for r in got.filter("accepted").collect()] == [40]


@pytest.mark.parametrize("expression,field,expected", [
    ("30 8 ? * MON-FRI *", "weekday", (2, 3, 4, 5, 6)), ("0/15 * * * ? *", "minute", (0, 15, 30, 45)),
    ("0 7 ? * TUE,THU *", "weekday", (3, 5)), ("0 0 1 JAN,dec ? *", "month", (1, 12)), ("0 9 ? * MON", "year", None),
    ("0 0 ? * SAT-MON *", "weekday", (1, 2, 7)), ("*/20 * * * ? *", "minute", (0, 20, 40)), ("0 0 1 * ? 2024-2026", "year", (2024, 2025, 2026)),
    ("10-30/10 * * * ? *", "minute", (10, 20, 30)),
])
def test_cron_fields(expression, field, expected):
    assert getattr(parse_cron(expression), field) == expected


@pytest.mark.parametrize("bad", ["* *", "61 * * * ? *", "0 0 ? * ? *", "0 0 1 * ? * *", "0/0 * * * ? *"])
def test_bad_cron(bad):
    with pytest.raises(ValueError):
        parse_cron(bad)


def due(spark, cron, zone, start, end, enabled=True):
    defs = spark.createDataFrame([("d", cron, enabled, zone)], "id string, cron string, enabled boolean, timezone string")
    rows = R.expand_cron(defs, start, end).select(F.date_format("due_at", "MM-dd HH:mm").alias("t")).collect()
    return sorted(r["t"] for r in rows)


def test_weekday_runs_of_a_month(spark):
    assert len(due(spark, "30 8 ? * MON-FRI *", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))) == 23


def test_clock_change_skips_and_repeats(spark):
    spring = due(spark, "30 2 * * ? *", "America/New_York", dt.datetime(2024, 3, 9), dt.datetime(2024, 3, 12))
    assert spring == ["03-09 07:30", "03-11 06:30"]
    autumn = due(spark, "30 1 * * ? *", "America/New_York", dt.datetime(2024, 11, 3), dt.datetime(2024, 11, 4))
    assert autumn == ["11-03 05:30", "11-03 06:30"]


def test_disabled_schedule(spark):
    assert due(spark, "0 * * * ? *", "UTC", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), enabled=False) == []


def test_window_across_clock_change(spark):
    start, end = R.window_bounds(dt.datetime(2024, 3, 11, 12), 2, "America/New_York")
    assert (start, end) == (dt.datetime(2024, 3, 9, 5), dt.datetime(2024, 3, 11, 4))
    t = spark.createDataFrame([(dt.datetime(2024, 3, 11, 12),)], "t timestamp")
    s, e = R.report_window(F.col("t"), F.lit(2), "America/New_York")
    row = t.select(s.cast("string").alias("s"), e.cast("string").alias("e")).first()
    assert (row["s"], row["e"]) == ("2024-03-09 05:00:00", "2024-03-11 04:00:00")


def group(*filters):
    return {"filter_groups": [{"filters": list(filters)}]}


def f(field, mode, *patterns):
    return {"field": field, "mode": mode, "patterns": [{"match_type": m, "value": v} for m, v in patterns]}


@pytest.mark.parametrize("spec,expected", [
    (None, ["a", "b", None]), ({"filter_groups": []}, ["a", "b", None]),
    (group(f("repo_name", "include", ("exact", "a"))), ["a"]),
    (group(f("repo_name", "exclude", ("exact", "a"))), ["b", None]),
    (group(f("repo_name", "include", ("prefix", "a"), ("suffix", "b"))), ["a", "b"]),
    (group(f("repo_name", "include", ("contains", "")), f("row_count", "include", ("exact", "2"))), ["b"]),
])
def test_filters(spark, spec, expected):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "repo_name string, row_count long")
    assert [r["repo_name"] for r in df.filter(compile_filters(spec, "oltp")).orderBy("row_count").collect()] == expected


def test_filter_errors(spark):
    for spec, kind in ((group(f("nope", "include", ("exact", "a"))), "oltp"),
                       (group(f("repo_name", "include", ("exact", "a"))), "snowflake"),
                       (group(f("repo_name", "maybe", ("exact", "a"))), "oltp"),
                       (group(f("repo_name", "include", ("fuzzy", "a"))), "oltp"),
                       (group({"field": "repo_name", "mode": "include", "patterns": []}), "oltp"), (None, "kafka")):
        with pytest.raises(ValueError):
            compile_filters(spec, kind)


def test_report_filter_reaches_the_scan(spark, base):
    from wardlake.plans.derived import audits

    d = R.ReportDefinition("r", filters=group(f("statement_type", "include", ("exact", "VIEW"))), lookback_days=3)
    detail, _ = R.build_report(audits(spark, base), d, dt.datetime(2024, 1, 20))
    plan = detail.select("event_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_worker_functions_do_not_need_the_package(tmp_path):
    """Executors have no copy of the library: its functions must load without it."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from wardlake.functions.cron import parse_cron

    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps((R._fold_steps, R._judge_partition, parse_cron)))
    code = ("import pickle, sys; fs = pickle.load(open(sys.argv[1], 'rb')); "
            "assert fs[2]('0 9 * * ? *').hour == (9,); assert 'wardlake' not in sys.modules")
    subprocess.run([sys.executable, "-c", code, str(blob)], cwd=tmp_path, check=True, timeout=60)


@pytest.mark.parametrize("cron,zone,day,expected", [
    # Troll turns its clock back by two hours: the local times from 01:00 to 03:00 come twice.
    ("30 1,2 ? * * *", "Antarctica/Troll", 27, ["10-26 23:30", "10-27 00:30", "10-27 01:30", "10-27 02:30"]),
    ("0 2 ? * * *", "Europe/Berlin", 27, ["10-27 00:00", "10-27 01:00"]),
    ("15 2 ? * * *", "Australia/Lord_Howe", 6, []),  # half an hour is skipped
])
def test_cron_at_clock_changes(spark, cron, zone, day, expected):
    start = dt.datetime(2024, 10, day) - dt.timedelta(hours=12)
    assert due(spark, cron, zone, start, start + dt.timedelta(days=1)) == expected


def test_throttle_of_one_busy_key_is_near_linear(spark):
    """One hour of one key with very many triggers: time follows the rows, and most share few times."""
    n = 1_000_000
    df = spark.range(n).selectExpr("'d' AS definition_id", "timestamp_micros(1704067200000000 + id * 3600) AS ts", "id AS event_id")
    got = R.throttle_triggers(df).where("accepted")
    assert [r["event_id"] for r in got.orderBy("event_id").collect()] == [83_334 * i for i in range(12)]


def test_throttle_keeps_rows_without_key_or_time(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 1), (None, t, 2), ("a", None, 3), ("a", t, 4)]
    got = R.throttle_triggers(spark.createDataFrame(rows, "definition_id string, ts timestamp, event_id long"))
    assert {r["event_id"]: r["accepted"] for r in got.collect()} == {1: True, 2: None, 3: None, 4: False}


def test_runs_of_one_schedule_are_spread(spark):
    defs = spark.createDataFrame([(f"d{i}", "0 9 ? * MON *", i % 9 > 0, "UTC") for i in range(400)],
                                 "id string, cron string, enabled boolean, timezone string").coalesce(1)
    out = R.expand_cron(defs, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    live = [f"d{i}" for i in range(400) if i % 9]
    assert sorted((r["id"], r["due_at"].day) for r in out.collect()) == sorted((i, d) for i in live for d in (1, 8, 15, 22, 29))
    assert out.groupBy(F.spark_partition_id()).count().count() == 4  # all shuffle partitions of the session
