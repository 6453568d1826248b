import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.functions import masks
from wardlake.operators import masking as M
from wardlake.operators import thresholds as TH


def one(spark, value, level, dtype="string", **options):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return M.project_levels(df, {"v": level}, **options).first()["v"]


@pytest.mark.parametrize("value,level,expected", [
    ("abc", 10000, "abc"), ("abc", 10001, "***"), ("é→x", 10001, "***"), ("", 10001, ""),
    ("joe@x.org", 10002, "****@x.org"), ("a@b@c.org", 10002, "****@c.org"), ("nomail", 10002, "******"),
    ("123-45-6789", 10003, "***-**-6789"), ("1234", 10003, "****"), ("12", 10003, "**"),
    ("abc", 10004, "*"), ("abc", 10005, None), ("abc", 10009, None),
    ("a", 10006, "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"),
    ("a@x.org", 10007, "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb@x.org"),
    ("a1234", 10008, "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb1234"),
    (None, 10001, None), (None, 10004, "*"), (None, 10006, None),
])
def test_level_on_text(spark, value, level, expected):
    assert one(spark, value, level) == expected


def test_levels_on_other_types(spark):
    assert one(spark, 7, 10004, "int") == 1
    assert one(spark, 7, 10001, "int") == "*"
    assert one(spark, 7, 10001, "int", on_nonstring="null") is None
    assert one(spark, True, 10004, "boolean") is None
    assert one(spark, dt.date(2020, 5, 5), 10004, "date") == dt.date(2000, 1, 1)
    assert one(spark, dt.date(2020, 5, 5), 10009, "date") == dt.date(9999, 12, 31)
    assert one(spark, bytearray(b"x"), 10005, "binary") is None


def test_salt_changes_hash(spark):
    assert one(spark, "a", 10006, salt="s") != one(spark, "a", 10006)


def test_type_is_kept_without_rule(spark):
    df = spark.createDataFrame([(1, "x")], "n int, s string")
    out = M.apply_masking(df, {"n": "T"}, [M.MaskRule("A", "T", 10000)], "B")
    assert out.schema["n"].dataType == T.IntegerType()
    assert out.first() == (None, "x")


def test_rule_checks():
    with pytest.raises(ValueError, match="No rules provided"):
        M.mask_rules([])
    with pytest.raises(ValueError, match="10000-10009"):
        M.mask_rules([{"role": "A", "tag_value": "T", "masking_policy": 999}])
    with pytest.raises(ValueError):
        M.mask_rules([{"tag_value": "T", "masking_policy": 10001}])
    with pytest.raises(ValueError):
        masks.mask(None, T.StringType(), 42)


def test_tag_value_is_case_sensitive(spark):
    df = spark.createDataFrame([("x",)], "s string")
    assert M.apply_masking(df, {"s": "pii"}, [M.MaskRule("A", "PII", 10000)], "A").first()["s"] is None


def test_strictest_level_wins(spark):
    rules = [M.MaskRule("A", "T", 10000), M.MaskRule("A", "T", 10003)]
    assert M.levels_for_role({"s": "T"}, rules, "A") == {"s": 10003}


def test_union_and_exploded_views_agree(spark):
    df = spark.createDataFrame([("joe", 1), ("ann", 2)], "s string, n int")
    rules = [M.MaskRule("A", "T", 10001), M.MaskRule("B", "T", 10000)]
    a = M.masked_views(df, {"s": "T"}, rules, ["A", "B", "C"]).select("role", "s", "n").collect()
    b = M.union_roles(df, {"s": "T"}, rules, ["A", "B", "C"]).select("role", "s", "n").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_masking_stays_in_one_projection(spark, base):
    df = spark.read.parquet(f"{base}/customer.parquet")
    plan = M.apply_masking(df, {"c_name": "T"}, [M.MaskRule("A", "T", 10001)], "A") \
        .select("c_name").filter("c_name = '***'")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan
    assert "ReadSchema: struct<c_name:string>" in plan


def test_wrapped_window_belongs_to_named_day(spark):
    ddl = ("rule_id string, time_window_thresholds array<struct<day:array<string>,start_time:struct<hour:int,minute:int>,"
           "end_time:struct<hour:int,minute:int>,timezone:string,action:string>>")
    rules = spark.createDataFrame([("r", [(["MONDAY"], (22, 0), (6, 0), "UTC", "block")])], ddl)
    times = ["2024-01-01 21:59:00", "2024-01-01 22:00:00", "2024-01-02 05:59:00", "2024-01-02 06:00:00", "2024-01-01 03:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.to_timestamp("t").alias("event_time"))
    hits = TH.time_window_breaches(rows, rules, ["UTC"]).select(F.date_format("event_time", "dd HH:mm").alias("x")).collect()
    assert sorted(r["x"] for r in hits) == ["01 22:00", "02 05:59"]


def test_unknown_rate_unit(spark):
    rows = spark.createDataFrame([("u", dt.datetime(2024, 1, 1))], "consuming_user string, event_time timestamp")
    with pytest.raises(ValueError, match="unknown access rate unit"):
        TH.rate_counts(rows, units=("fortnight",))
