from datetime import datetime

from pyspark.sql import functions as F

from turnmill.operators.snapshots import canonical_url, last_seen_hash, snapshot_changes

T = datetime(2025, 1, 1)
U = datetime(2025, 1, 2)


def changes(spark, rows):
    df = spark.createDataFrame(rows, "n int, url string, f timestamp, c string, change string")
    return sorted(tuple(r) for r in snapshot_changes(df, "n", "url", "f", "c").collect())


def test_added_removed_changed_and_back(spark):
    rows = [(1, "a", T, "x", ""), (2, "a", T, "y", ""), (4, "a", T, "y", ""), (1, "b", T, None, ""), (2, "b", T, "z", ""), (4, "b", T, "z", ""), (2, "c", T, "q", ""), (7, "a", T, "y", "")]
    got = changes(spark, rows)
    assert got == [(2, "a", "changed"), (2, "b", "changed"), (2, "c", "added"), (4, "c", "removed"), (7, "b", "removed")]


def test_gap_is_removal_and_addition(spark):
    rows = [(1, "a", T, "x", ""), (2, "b", T, "x", ""), (3, "a", T, "x", ""), (3, "b", T, "x", ""), (1, "b", T, "x", "")]
    assert changes(spark, rows) == [(2, "a", "removed"), (3, "a", "added")]


def test_latest_counts_and_nulls_are_left_out(spark):
    rows = [(1, "a", T, "x", ""), (2, "a", U, "x", ""), (2, "a", T, "old", ""), (2, "a", U, "x", ""), (2, None, T, "x", ""), (None, "a", T, "x", "")]
    assert changes(spark, rows) == []
    assert changes(spark, []) == []


def test_url_and_hash(spark):
    df = spark.createDataFrame([("HTTPS://A.b/c/", [("AB", U, "p"), ("cd", T, "p"), (None, U, "p")]), (None, []), ("x", None)],
                               "u string, v array<struct<content_hash:string,last_seen:timestamp,raw_path:string>>")
    assert [tuple(r) for r in df.select(canonical_url(F.col("u")), last_seen_hash(F.col("v"))).collect()] == [("https://a.b/c", "ab"), (None, None), ("x", None)]
