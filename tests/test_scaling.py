import random

from pyspark.sql import functions as F

from wardlake.operators.scaling import fan_out_join, number_rows, skew_join


def test_skew_join_equals_plain_join(spark):
    random.seed(3)
    big = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{random.randint(0, 200)}")) for i in range(3000)],
        "i int, k string")
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 200, 2)] + [("k4", 99)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        a = skew_join(big, lookup, ["k"], how, hot_share=0.01, salts=8)
        b = big.join(lookup, ["k"], how)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), how


def test_hot_rows_are_spread(spark):
    big = spark.range(10000).select("id", F.lit("x").alias("k"))
    lookup = spark.createDataFrame([("x", 1)], "k string, v int")
    plan = skew_join(big, lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_row_numbers_are_gap_free(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), "id").repartition(7)
    rows = number_rows(df, [F.asc("v"), F.asc("id")]).orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, 5001))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)


def test_fan_out_join_equals_plain_join(spark):
    big = spark.range(500).select("id", (F.col("id") % 3).cast("string").alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    control = spark.createDataFrame([("0", 1), ("0", 2), ("1", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = fan_out_join(big, control, ["k"], how).drop("m")
        b = big.drop("m").join(control, ["k"], how)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), how


def test_a_key_with_a_third_of_the_rows_does_not_land_in_one_task(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        big = spark.range(90000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        lookup = big.select("k").distinct().withColumn("v", F.lit(1))

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return max(r["count"] for r in sizes)

        assert largest(big.join(lookup, "k")) > 30000
        assert largest(skew_join(big, lookup, ["k"], "inner")) < 15000
        few = big.select("id", (F.col("id") % 2).alias("k"))
        control = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
        assert largest(fan_out_join(few, control, ["k"])) < 30000
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_a_small_control_table_does_not_move_the_data(spark, monkeypatch):
    from wardlake.operators import scaling

    big = spark.range(10_000).selectExpr("id % 3 AS k", "id AS v")
    control = spark.createDataFrame([(0, "a"), (1, "b")], "k long, m string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = fan_out_join(big, control, ["k"])
        assert "hashpartitioning" not in joined._jdf.queryExecution().toString()
        monkeypatch.setattr(scaling, "BROADCAST_ROWS", 1)
        salted = fan_out_join(big, control, ["k"])
        assert "hashpartitioning" in salted._jdf.queryExecution().toString()
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, salted.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_large_control_table_is_cut_by_pairs_and_never_broadcast(spark, monkeypatch):
    from wardlake.operators import scaling

    monkeypatch.setattr(scaling, "BROADCAST_ROWS", 10)
    key = lambda i: "hot" if i % 2 else (None if i % 10 == 0 else f"k{i % 40}")
    big = spark.createDataFrame([(i, key(i)) for i in range(600)], "i int, k string")
    for n in (90, 1500):  # the control table has fewer rows of the hot key than big, then more
        control = spark.createDataFrame([(i, key(i + i // 60)) for i in range(n)], "v int, k string")
        for how in ("inner", "left", "left_semi", "left_anti"):
            cut, plain = fan_out_join(big, control, ["k"], how), big.join(control, ["k"], how)
            assert "SortMergeJoin" in cut._jdf.queryExecution().executedPlan().toString(), how
            assert sorted(map(str, cut.select(*plain.columns).collect())) == sorted(map(str, plain.collect())), (n, how)
        at = scaling._pieces(big, control, ["k"], "inner", 16).where("k = 'hot'").first()
        assert (at["_bigs"] > 1, at["_controls"] > 1) == (n == 90, n == 1500)
    unique = spark.range(3000).select("id", F.col("id").cast("string").alias("k"))
    assert scaling._pieces(unique, unique, ["k"], "inner", 16).count() == 0


def test_a_tiled_product_equals_the_plain_join(spark, monkeypatch):
    from wardlake.operators import scaling

    key = lambda i: None if i % 11 == 0 else f"k{i % 3}" if i % 5 else f"k{i}"
    big = spark.createDataFrame([(key(i), None if i % 7 == 0 else f"o{i // 2}", i % 4) for i in range(300)], "k string, o string, n int")
    control = spark.createDataFrame([(key(i), None if i % 13 == 0 else f"u{i // 2}") for i in range(120)], "k string, u string")
    want = sorted(map(str, big.join(control, ["k"]).select("k", "o", "n", "u").collect()))
    for rows, size, tile in ((20_000, 8 << 20, (256, 256)), (20_000, 8 << 20, (3, 4)), (5, 8 << 20, (256, 4)), (20_000, 100, (3, 256))):
        monkeypatch.setattr(scaling, "BROADCAST_ROWS", rows)
        monkeypatch.setattr(scaling, "TILED_BYTES", size)
        monkeypatch.setattr(scaling, "TILE", tile)
        got = scaling.tiled_product(big, control, ["k"])
        sent = rows == 20_000 and size > 100
        assert ("SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()) != sent
        assert got.columns == ["k", "o", "n", "u"] and sorted(map(str, got.collect())) == want
    assert scaling.tiled_product(big, control.limit(0), ["k"]).count() == scaling.tiled_product(big.limit(0), control, ["k"]).count() == 0
    assert scaling._arrays(control.where("k = 'k1'"), ["k"], 4, "_right").selectExpr("max(size(_right))").first()[0] == 4
