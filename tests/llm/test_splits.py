import random

import pytest
from pyspark.sql import functions as F

from turnmill.llm import splits as S


def brute(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {(v, root(v)) for v in parent if root(v) != v}


@pytest.mark.parametrize("seed,limit", [(1, 10_000), (2, 60), (3, 25)])
def test_united(spark, seed, limit):
    rng = random.Random(seed)
    pairs = [(rng.randrange(150), rng.randrange(150)) for _ in range(100)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(80)]
    df = spark.createDataFrame(pairs + [(None, 3), (4, None), pairs[0]], "v long, p long")
    assert {tuple(r) for r in S.united(df, limit).collect()} == brute([p for p in pairs if p[0] != p[1]])


def test_groups_by_keys(spark):
    rows = [(3, "a"), (1, "a"), (3, "b"), (9, "b"), (9, "b"), (5, "c"), (None, "a"), (6, None), (7, "d")]
    got = {tuple(r) for r in S.related_groups(spark.createDataFrame(rows, "id long, key string")).collect()}
    assert got == {(3, 1), (9, 1)}
    assert S.related_groups(spark.createDataFrame([], "id long, key string")).count() == 0


def test_one_key_of_a_third(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"))
    got = S.related_groups(rows, links_per_task=100)
    assert got.count() == 999 and got.where("group_id <> 0").count() == 0


@pytest.mark.parametrize("a,b,same", [("No. 93-104", "93-104", True), ("#11-113", "11 - 113", True), ("16-0104", "16-104", True), ("NO 8", "8.", True), ("87‑105", "87–105", True), ("93-104", "93-140", False)])
def test_dockets(spark, a, b, same):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(S.docket_key(F.col("a")).alias("x"), S.docket_key(F.col("b")).alias("y")).first()
    assert (r.x == r.y) is same
    n = spark.createDataFrame([(None,), ("",), (" ",)], "a string").select(S.docket_key(F.col("a")).alias("x")).collect()
    assert [x.x for x in n] == [None] * 3


def test_deal_follows_one_by_one():
    rng = random.Random(5)
    for _ in range(30):
        classes = [(s, rng.randint(1, 40)) for s in rng.sample(range(1, 60), 6)]
        shares = [0.8, 0.1, 0.1]
        total = sum(s * n for s, n in classes)
        got = S.deal(classes, shares)
        assert sum(s * sum(g) for s, g in got) == total and all(sum(g) == dict(classes)[s] for s, g in got)
        filled = [sum(s * g[i] for s, g in got) for i in range(3)]
        room = [total * x for x in shares]
        for size, n in sorted(classes, reverse=True):
            for _ in range(n):
                i = max(range(3), key=lambda k: (room[k], -k))
                room[i] -= size
        assert all(abs(f - (total * x - r)) <= max(s for s, _ in classes) for f, x, r in zip(filled, shares, room))
    assert S.deal([], [0.5, 0.5]) == []


def test_splits_hold_groups_together(spark):
    ids = spark.range(400)
    groups = ids.where("id % 4 <> 0").select("id", (F.col("id") - F.col("id") % 4).alias("group_id"))
    out = S.assign_splits(ids, groups, [("train", 0.8), ("validation", 0.1), ("test", 0.1)])
    assert out.count() == 400 and out.groupBy("group_id").agg(F.count_distinct("split_name").alias("n")).where("n > 1").count() == 0
    assert {r.split_name: r["count"] for r in out.groupBy("split_name").count().collect()} == {"train": 320, "validation": 40, "test": 40}
    assert S.assign_splits(ids.limit(0), groups.limit(0), [("train", 1.0)]).count() == 0
