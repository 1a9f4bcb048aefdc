from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from turnmill.operators.intervals import periods_and_gaps

SCHEMA = "k long, a long, b long, extra string, _t long"


def brute(rows):
    out = []
    for k in {r[0] for r in rows if r[0] is not None}:
        spans = sorted((a, b) for kk, a, b, *_ in rows if kk == k and a is not None and b is not None and a < b)
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(k, "period", a, b) for a, b in merged] + [(k, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])]
    return sorted(out)


def run(spark, rows, bucket=8):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in periods_and_gaps(df, ["k"], "a", "b", bucket).collect())


def test_touching_nested_gapped(spark):
    rows = [(1, 0, 5, "", 0), (1, 5, 9, "", 0), (1, 2, 3, "", 0), (1, 40, 41, "", 0), (1, 40, 41, "", 0), (2, -9, -3, None, 1)]
    assert run(spark, rows) == [(1, "gap", 9, 40), (1, "period", 0, 9), (1, "period", 40, 41), (2, "period", -9, -3)]


def test_nulls_empty_and_reversed(spark):
    rows = [(None, 0, 5, "", 0), (1, None, 5, "", 0), (1, 5, None, "", 0), (1, 5, 5, "", 0), (1, 9, 2, "", 0)]
    assert run(spark, rows) == []
    assert run(spark, []) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(-40, 60), st.integers(-40, 60), st.just("x"), st.just(0)), max_size=60))
def test_against_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_one_key_with_most_rows(spark):
    rows = [(1, i * 3, i * 3 + (2 if i % 10 else 5), "", 0) for i in range(3000)] + [(2, 0, 1, "", 0)]
    assert run(spark, rows, 64) == brute(rows)
