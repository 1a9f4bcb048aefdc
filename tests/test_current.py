from datetime import datetime

from pyspark.sql import functions as F

from turnmill.operators.current import current_rows


def test_latest_ties_nulls_and_clashing_columns(spark):
    t = [datetime(2025, 1, i) for i in (1, 2)]
    rows = [(1, 0, "old", t[0], 5), (1, 0, "new", t[1], 6), (1, 0, "new", t[1], 6), (1, 1, None, None, 7), (None, 1, "x", t[0], 8)]
    df = spark.createDataFrame(rows, "id long, i int, v string, at timestamp, rank int")
    got = sorted((tuple(r) for r in current_rows(df, ["id", "i"], "at", [F.col("v")]).select("id", "i", "v", "rank").collect()), key=str)
    assert got == [(1, 0, "new", 6), (1, 1, None, 7)]
    assert current_rows(df.limit(0), ["id"], "at").count() == 0


def test_previous_in_blocks(spark):
    import random

    from turnmill.operators.current import previous

    rng = random.Random(4)
    rows = [(k, i, rng.choice([None, 1, 2, 3]), "x") for k in (None, 1, 2) for i in rng.sample(range(-30, 60), 25)]
    df = spark.createDataFrame(rows, "k int, i int, v int, block string")
    want, last = {}, {}
    for k, i, v, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        want[(k, i)] = last.get(k)
        last[k] = v
    for size in (1, 7, 1000):
        got = previous(df, ["k"], F.floor(F.col("i") / size), ["i"], "v", "p")
        assert {(r.k, r.i): r.p for r in got.collect()} == want and got.columns == ["k", "i", "v", "block", "p"]
    assert previous(df.limit(0), ["k"], F.col("i"), ["i"], "v", "p").count() == 0


def test_beside_keeps_rows_with_null_keys(spark):
    from turnmill.operators.current import beside

    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, on_0 int")
    got = beside(df, df.groupBy("k").agg(F.max("on_0").alias("m")), ["k"])
    assert sorted(tuple(r) for r in got.select("on_0", "m").collect()) == [(1, 2), (2, 2), (3, 3)]


def test_spread_scan(spark, data):
    from turnmill.session import spread_scan, table

    df = table(spark, data, "documents")
    assert spread_scan(df).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and spread_scan(df).count() == df.count()
