import random

import pytest

from turnmill.llm import chunking as C
from turnmill.llm import sentences as S
from turnmill.llm.queries import turn_pieces

L = C.Limits(100, 10, 30, 2)


def pieces(spark, rows, limits=L):
    df = spark.createDataFrame(rows, "id long, text string, start double, stop double, duration double, cut string")
    sized = C.oversized(df, "text", "start", "stop", "duration", limits).withColumn("long_text", df["text"])
    laid = S.lay_out_all(sized, ["id", "over", "span_us", "size", "timed", "long_text"], "text", silent=True)
    m = S.train(laid)
    out = {}
    for r in C.split_oversized(laid.where("over"), ["id"], m, limits).orderBy("id", "piece_no").collect():
        out.setdefault(r.id, []).append(r)
    return out


def test_pieces_cover_overlap_and_fit(spark):
    rng = random.Random(1)
    rows = []
    for i in range(30):
        t = " ".join("The court met at noon" + " again" * rng.randint(0, 8) + "." for _ in range(rng.randint(1, 12)))
        rows.append((i, t, 0.0, float(rng.choice([5, 40, 300])), None, ""))
    rows += [(100, "word " * 80, None, None, None, ""), (101, "x" * 350, None, None, 1.0, ""), (102, None, 0.0, 95.0, None, ""), (103, "", None, None, 61.0, ""), (104, "Short.", 0.0, 3.0, None, ""),
             (105, "Hi.", 0.0, 90.0, 1.0, ""), (106, None, None, None, None, ""), (107, "a. " * 50, float("nan"), 1.0, None, "")]
    got = pieces(spark, rows)
    for i, t, a, b, d, _ in rows:
        sec = b - a if a is not None and b is not None else d
        size = len(t or "")
        if size <= 100 and not (sec and sec > 30):
            assert i not in got
            continue
        p = got[i]
        assert p[0].start_char == 0 and p[-1].end_char == size
        for x in p:
            assert x.end_char - x.start_char <= 100
            if sec and sec > 30 and size:
                assert (x.end_char - x.start_char) * sec / size <= 30 + 2 * sec / size
        for x, y in zip(p, p[1:]):
            assert y.start_char <= x.end_char and (y.end_m > x.end_m)
            assert y.start_m >= x.end_m - (2_000_000 if sec and sec > 30 and size * 30 < 100 * sec or not size else 10)
    assert {x.cut for x in got[100]} == {0, 2} and {x.cut for x in got[101]} == {0, 2}
    assert len(got[102]) >= 3 and {x.cut for x in got[102]} == {0}


def test_greedy_is_the_same_as_one_by_one(spark):
    text = " ".join(f"The {w} met at noon there." for w in ("court", "jury", "board", "panel", "union") * 6)
    got = pieces(spark, [(1, text, None, None, None, "")])[1]
    ends = [i + 1 for i, c in enumerate(text) if c == "."]
    at, want = 0, []
    while at < len(text):
        start = max(at - 10, 0)
        fit = [e for e in ends if at < e <= (start + 100 if at else 100)]
        at = fit[-1]
        want.append(at)
    assert [p.end_char for p in got] == want


def test_empty_table(spark):
    assert pieces(spark, []) == {}


def test_over_the_test_table(spark, data):
    df = turn_pieces(spark, data)
    assert df.where("end_char - start_char > 1000").count() == 0 and df.count() > 0


@pytest.mark.parametrize("text,kinds", [("One. Two.", {0}), ("w " * 100, {0, 2}), ("z" * 300, {0, 2})])
def test_kinds(text, kinds):
    pts = C.cut_points(text, [len(text)], None, False, L)
    assert {k for _, _, k in pts} == kinds and pts[-1][1] == len(text)
    assert all(a[0] < b[0] for a, b in zip(pts, pts[1:]))


def test_sentences_before_words(spark):
    """No piece ends inside a sentence where one of its reach ends with a sentence."""
    rng = random.Random(9)
    rows = [(i, " ".join("The court" + " met" * rng.choice([2, 3, 9, 18, 21, 22, 30]) + "." for _ in range(rng.randint(3, 9))), None, None, None, "") for i in range(60)]
    got = pieces(spark, rows)
    for i, t, *_ in rows:
        ends = [k + 1 for k, c in enumerate(t) if c == "."]
        at = 0
        for p in got.get(i, []):
            if p.cut != C.NATURAL:
                assert not [e for e in ends if at < e <= at + 100]
            at = p.end_char


def test_turns_without_marks_are_cut_by_all_current_turns(spark, tmp_path):
    """Ends in an oversized turn without marks are learned from all current turns, long ones too and none twice, and from no old ones."""
    said = ["the court met at noon", "it rose today", "we agree again"]
    bare = " ".join(said * 40)
    marked = " ".join(s.capitalize() + "." for s in said * 60)
    odd = " ".join(["The court met at. Noon it rose. Today we agree. Again the court met at. Noon it rose. Today we agree."] * 9)
    rows = [(1, 0, bare, 2), (1, 1, marked, 2), (1, 1, marked, 2)] + [(1, i, odd, 1) for i in range(2, 80)] + [(1, i, "Nobody spoke.", 2) for i in range(2, 80)]
    df = spark.createDataFrame(rows, "transcript_id long, turn_index int, text string, v int")
    df = df.selectExpr("transcript_id", "turn_index", "text", "cast(null as double) start", "cast(null as double) stop", "cast(null as double) duration", "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, v) loaded_at")
    df.write.parquet(f"{tmp_path}/turns.parquet")
    spark.createDataFrame([("turn", "chars", 1000, 100), ("turn", "seconds", 30, 2)], "item string, unit string, limit_value int, overlap_value int").write.parquet(f"{tmp_path}/size_limits.parquet")
    got = [p for p in turn_pieces(spark, str(tmp_path)).where("turn_index = 0").orderBy("piece_no").collect()]
    ends, at = [], -1
    for s in said * 40:
        at += 1 + len(s)
        ends.append(at)
    assert len(got) > 1 and {p.cut for p in got} == {C.NATURAL} and {p.end_char for p in got} <= set(ends)
