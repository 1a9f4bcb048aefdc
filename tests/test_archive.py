import json
import random

import pytest
from pyspark.sql import functions as F

from turnmill import schemas
from turnmill.operators import cases as C
from turnmill.operators import quality as Q
from turnmill.operators import speakers as S
from turnmill.operators import transcripts as T
from turnmill.sources import landing, tiers
from turnmill.streaming import incremental


def raw(spark, docs):
    return spark.read.schema(schemas.RAW_TRANSCRIPT).json(spark.sparkContext.parallelize([json.dumps(d) for d in docs]))


def turn(a, b, words, sid=1):
    return {"start": a, "stop": b, "speaker": {"ID": sid, "name": f"s{sid}"} if sid else None, "text_blocks": [{"text": " ".join(["w"] * words)}, {"text": "  "}, None]}


def test_turns_of_raw_documents(spark):
    docs = [{"id": 1, "transcript": {"sections": [{"turns": [turn(0, 15, 1), None]}, None, {"turns": [turn(10, 20, 1, None)]}]}}, {"id": 2, "transcript": None}]
    t = T.with_validity(T.with_overlap(T.flatten_turns(raw(spark, docs)), "id", "index"), "id")
    got = [(r["index"], r.section_index, r.is_overlapping, r.problem, r.word_count, r.text_block_count) for r in t.orderBy("index").collect()]
    assert got == [(0, 0, False, "wpm_too_low", 1, 3), (1, 2, True, "overlap", 1, 3)]
    m = T.metadata(t, "id").first()
    assert (m.turn_count, m.overlap_count, m.invalid_turn_count, m.has_null_speakers) == (2, 1, 2, True)


def test_ratio_only_hits_valid_turns(spark):
    t = T.with_validity(T.with_overlap(T.flatten_turns(raw(spark, [{"id": 1, "transcript": {"sections": [{"turns": [turn(0, 60, 70), turn(60, 80, 30)]}]}}])), "id", "index"), "id")
    assert [r.problem for r in t.orderBy("index").collect()] == ["too_long_ratio", None]


def test_speaker_lists(spark):
    t = T.flatten_turns(raw(spark, [{"id": 1, "transcript": {"sections": [{"turns": [turn(0, 5, 1, 2), turn(5, 6, 1, 1), turn(6, 7, 1, 1), turn(7, 8, 1, None)]}]}}]))
    assert [(r.speaker_id, r.turn_count, r["rank"]) for r in T.speaker_lists(t, "id").orderBy("rank").collect()] == [(1, 2, 1), (2, 1, 2)]


def quality(spark, rows):
    df = spark.createDataFrame([("r", i, float(a), float(b), float(b - a), w) for i, (a, b, w) in enumerate(rows)], "k string, i int, start double, stop double, duration double, word_count long")
    return [r.reason for r in Q.flag_utterances(df, ["k"]).orderBy("i").collect()]


def test_quality(spark):
    assert quality(spark, [(10, 5, 20), (-1, 0, 20), (20, 30, 20), (50, 100, 100)]) == ["invalid_timestamps"] * 2 + ["passed"] * 2
    assert quality(spark, [(0, 20, 5), (25, 45, 50)]) == ["abnormal_wpm", "passed"]
    assert quality(spark, [(0, 5, 1), (50, 100, 100)]) == ["passed", "passed"]
    assert quality(spark, [(0, 20, 40), (10, 30, 40)]) == ["overlapping"] * 2
    assert quality(spark, [(0, 10, 20), (8, 18, 20), (50, 100, 100)]) == ["passed"] * 3
    assert quality(spark, [(0, 100, 200)]) == ["too_long_ratio"]
    assert quality(spark, [(0, 40, 80), (50, 100, 100)]) == ["passed", "passed"]


@pytest.mark.parametrize("stretch", [5.0, 17.0, 600.0])
def test_overlaps_against_pairs(spark, stretch):
    rng = random.Random(int(stretch))
    rows = [(r, i, *(lambda a: (float(a), float(a + rng.randint(-2, 12))))(rng.randint(0, 60))) for r in range(20) for i in range(25)]
    rows += [(None, 0, 0.0, 9.0), (None, 1, 2.0, 9.0), (0, 90, None, 9.0), (0, 91, 5.0, None), (0, 92, float("nan"), 9.0)]
    df = spark.createDataFrame(rows, "k int, i int, a double, b double")
    out = Q.flag_overlaps(df, ["k"], "a", "b", "o", stretch=stretch)
    assert out.count() == len(rows)
    got = {(r.k, r.i) for r in out.where("o").collect()}
    fine = [r for r in rows if r[2] is not None and r[3] is not None and r[2] == r[2]]
    want = {(k, i) for k, i, a, b in fine for kk, j, c, d in fine if k == kk and i != j and min(b, d) - max(a, c) > 3}
    assert got == want


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_overlap_with_the_turn_before(spark, block):
    rng = random.Random(9)
    rows = [(r, i, float(rng.randint(0, 50)), rng.choice([None, float(rng.randint(0, 60))])) for r in range(3) for i in rng.sample(range(40), 20)]
    want, prev = {}, {}
    for r, i, a, b in sorted(rows, key=lambda x: x[:2]):
        p = prev.get(r)
        want[(r, i)] = max(0.0, p - a) if p is not None else 0.0
        prev[r] = b
    out = T.with_overlap(spark.createDataFrame(rows, "r int, i int, start double, stop double"), "r", "i", block=block)
    assert {(x.r, x.i): x.overlap_seconds for x in out.collect()} == want


def seen(spark):
    rows = [(7, "2020", "1-1", 10, 100.0, 500, "A B"), (7, "2021", "1-2", 20, 200.0, 1000, "A B")]
    return spark.createDataFrame(rows, "speaker_id long, term string, docket string, turns long, duration_seconds double, word_count long, name string")


def test_speakers(spark):
    t = S.totals(seen(spark)).first()
    assert (t.recordings, t.cases, t.turns, t.duration_seconds, t.word_count, t.avg_words_per_turn) == (2, 2, 30, 300.0, 1500, 50.0)
    p = S.profiles(seen(spark))
    assert p.first().by_term["2020"].turns == 10 and p.first().name_slug == "a_b"
    sub = S.of_terms(p, ["2021"]).first()
    assert (sub.recordings, sub.turns, sub.first_appearance) == (1, 20, "2021") and S.of_terms(p, ["1900"]).count() == 0
    assert S.roles(seen(spark)).first().role == "other"
    assert S.roles(seen(spark), seen(spark)).first().role == "justice"
    assert S.totals(seen(spark).limit(0)).count() == 0


def test_cases(spark):
    doc = {"ID": 1, "name": "n", "timeline": [{"event": "Argued", "dates": [1670198400]}, None, {"dates": []}], "decisions": [{"decision_type": "d"}, {"decision_type": "e"}],
           "oral_argument_audio": None, "opinion_announcement": [{"id": 5, "title": "Dissenting Opinion - X - y"}, None]}
    c = C.details(spark.read.schema(schemas.RAW_CASE).json(spark.sparkContext.parallelize([json.dumps(doc)]))).first()
    assert [tuple(t) for t in c.timeline] == [("Argued", "2022-12-05"), ("", None)] and c.decision.type == "d" and c.oral_arguments == []
    assert (c.opinion_announcements[0].type, c.opinion_announcements[0].speaker, c.opinion_announcements[0].unavailable) == ("dissent", "X", False)


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_interruptions(spark, block):
    rows = [(1, 0, 1, "we hold --"), (1, 1, 2, "why?"), (1, 2, 1, "-- that it ends."), (1, 3, 2, "fine —"), (1, 4, 1, None), (1, 5, 2, "— yes"), (2, 0, 1, "so --"), (2, 1, None, "x"), (2, 2, 1, "-- no"),
            (3, 0, 1, "a --"), (3, 1, 2, "b"), (3, 2, 1, "-- c --"), (3, 3, 2, "d"), (3, 4, 1, "-- e"), (4, 0, 1, "a --"), (4, 1, 2, "long " * 40), (4, 2, 1, "-- b")]
    out = T.merge_interruptions(spark.createDataFrame(rows, "id int, i int, speaker_id long, text string"), "id", "i", block=block).orderBy("id", "i").collect()
    assert [(r.i, r.text, r.merged) for r in out if r.id == 1] == [(0, "we hold that it ends.", True), (1, "why?", False), (3, "fine —", False), (4, None, False), (5, "— yes", False)]
    assert [r.merged for r in out if r.id == 2] == [False] * 3 and [r.merged for r in out if r.id == 4] == [False] * 3
    assert [(r.i, r.text) for r in out if r.id == 3] == [(0, "a c --"), (1, "b"), (3, "d"), (4, "-- e")]


def test_landing_and_pages(spark, tmp_path):
    d = tmp_path / "cases"
    d.mkdir()
    (d / "page-0.json").write_text(json.dumps([{"ID": 1, "name": "a"}, {"ID": 2, "name": "b"}]))
    (d / "page-1.json").write_text("[]")
    (d / "page-2.json").write_text("{broken")
    assert {r.ID for r in landing.read_case_pages(spark, str(d)).collect()} == {1, 2}
    spark.dataSource.register(landing.CasePages)
    assert spark.read.format("case_pages").load(str(d)).count() == 2
    media = tmp_path / "x" / "case_data" / "2020" / "21-1"
    media.mkdir(parents=True)
    (media / "r.delivery.mp3").write_bytes(b"12")
    f = landing.list_media(spark, str(tmp_path / "x")).first()
    assert (f.recording_id, f.term, f.docket, f.format, f.length) == ("r", "2020", "21-1", "mp3", 2)


def test_tiers_round_trip_and_state(spark, tmp_path):
    root = str(tmp_path / "flex")
    u = spark.createDataFrame([("2020", "1-1", "oral_argument", 0, 0.0, 2.5, 2.5, 5, "A", True, "hi", 1, True, None), ("2020", "1-1", None, 1, 5.0, 4.0, 1.0, None, None, False, "x", 1, False, "bad")], schemas.UTTERANCES)
    assert tiers.write_tier(spark, root, {"utterances": u}, ["2020"])
    assert not tiers.write_tier(spark, root, {"utterances": u}, ["2020"]) and tiers.write_tier(spark, root, {"utterances": u}, ["2021"])
    rec, utt = landing.load_flex(spark, root)
    assert rec.count() == 0 and utt.count() == 2
    s = tiers.simple_rows(utt)
    assert [(r.id, r.duration) for r in s.collect()] == [("2020_1-1_oral_argument_0.00", 2.5)]
    tiers.write_simple(spark, str(tmp_path / "simple"), s)
    assert [r._split for r in landing.load_simple(spark, str(tmp_path / "simple")).collect()] == ["lt1m"]


def test_streams(spark, tmp_path):
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    rows = spark.range(20).select(F.timestamp_seconds(F.col("id") * 600).alias("ts"), (F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    rows.write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    out = incremental.run_once(incremental.windowed_counts(stream, "ts", "k", "v", "1 hour", "10 minutes"), "wc", ck + "1", "complete")
    assert out.agg(F.sum("n")).first()[0] == 20
    totals = incremental.run_once(incremental.running_totals(stream, "k", "v"), "rt", ck + "2", "update")
    assert {(r.k, r.n, r.total) for r in totals.collect()} == {(0, 10, 90.0), (1, 10, 100.0)}
    done = []
    for _ in range(2):
        incremental.process_new_files(spark, src, "ts timestamp, k bigint, v double", ck + "3", lambda df, n: done.append(df.count()))
    assert done == [20]
