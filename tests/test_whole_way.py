import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.archive import Archive
from turnmill.operators import audio as AU
from turnmill.sources import fetching


def test_wav_round_trip_and_segments(spark):
    x = np.sin(np.arange(1600) / 9).astype(np.float32) * 0.5
    content = AU.encode(x, 800)
    y, rate, bits = AU.decode(content)
    assert rate == 800 and bits == 16 and np.abs(y[0] - x).max() < 1e-4
    files = spark.createDataFrame([("a", bytearray(content)), ("bad", bytearray(b"xyz")), ("none", None)], "path string, content binary")
    info = {r.path: r for r in AU.probe(files).collect()}
    assert info["a"].frames == 1600 and info["a"].duration == 2.0 and info["bad"].error and info["none"].error
    seg = spark.createDataFrame([("s1", "a", 0.5, 1.0), ("s2", "a", 1.0, 1.0), ("s3", "a", 0.0, 9.0), ("s4", "bad", 0.0, 1.0), ("s5", "gone", 0.0, 1.0), ("s6", "a", None, 1.0)], "segment_id string, path string, start_sec double, end_sec double")
    got = {r.segment_id: r for r in AU.cut_segments(seg, files).collect()}
    assert np.array_equal(AU.decode(bytes(got["s1"].bytes))[0], y[:, 400:800]) and set(got) == {"s1", "s2", "s3", "s4", "s6"}
    assert all(got[k].error for k in ("s2", "s3", "s4", "s6"))


def test_fetching_and_versions(spark):
    def get(url):
        if "boom" in url:
            raise OSError("no route")
        return fetching.Response(404 if "gone" in url else 200, "application/json", b"{}" if "a" in url else b"[]")

    req = spark.createDataFrame([("http://x/a",), ("http://x/a",), ("http://x/gone",), ("http://x/boom",), (None,), ("http://x/old",)], "url string")
    cache = fetching.with_request_keys(spark.createDataFrame([("http://x/old",)], "url string"))
    got = fetching.fetch(req, cache, get, "2025-01-02 00:00:00", 2).cache()
    assert {r["class"]: r.n for r in fetching.summary(req, cache, got).collect()} == {"cached": 1, "new": 1, "skipped": 1, "transient": 1}
    history, log = fetching.add_versions(None, got)
    assert history.count() == 1 and log.count() == 0
    again = got.withColumn("content", F.encode(F.lit("other"), "UTF-8")).withColumn("fetched_at", F.lit("2025-01-03").cast("timestamp"))
    history2, log2 = fetching.add_versions(history, again.where("status_code = 200"))
    assert history2.count() == 2 and log2.count() == 1
    same, none = fetching.add_versions(history2, again.where("status_code = 200"))
    assert same.count() == 2 and none.count() == 0
    assert fetching.without_expired(history2, "2025-01-05 00:00:00", 2).count() == 1


@pytest.fixture()
def root(tmp_path):
    turns = lambda: [{"start": 0.0, "stop": 4.0, "speaker": {"ID": 1, "name": "Ada Harrowby"}, "text_blocks": [{"text": "We will hear it."}]},
                     {"start": 4.0, "stop": 9.0, "speaker": {"ID": 2, "name": "Bo Selwyn"}, "text_blocks": [{"text": "Thank you."}]}, {"start": 9.0, "stop": 9.0, "speaker": None, "text_blocks": []}]
    (tmp_path / "landing/cases").mkdir(parents=True)
    (tmp_path / "landing/transcripts").mkdir(parents=True)
    a = tmp_path / "landing/audio/case_data/2021/21-1"
    a.mkdir(parents=True)
    (tmp_path / "landing/cases/1.json").write_text(json.dumps({"ID": 1, "name": "A v. B", "term": "2021", "docket_number": "21-1", "oral_argument_audio": [{"id": 7, "title": "Oral Argument - December 05, 2021", "href": "h"}]}))
    doc = {"id": 7, "title": "Oral Argument - December 05, 2021", "media_file": [{"mime": "audio/mpeg", "href": "http://x/21-1_20211205-argument.mp3"}], "transcript": {"duration": 12.0, "sections": [{"turns": turns()}]}}
    (tmp_path / "landing/transcripts/7.json").write_text(json.dumps(doc))
    (tmp_path / "landing/transcripts/8.json").write_text(json.dumps({**doc, "id": 8}))
    (tmp_path / "landing/transcripts/x.json").write_text("[1, 2")
    rng = np.random.default_rng(1)
    loud = np.where(np.arange(9600) // 800 % 2, 0.5, 0.01) * rng.standard_normal(9600)
    (a / "21-1_20211205-argument.wav").write_bytes(AU.encode(loud.astype(np.float32), 800))
    return str(tmp_path)


def test_from_landing_to_tiers(spark, root):
    a = Archive(spark, root)
    assert a.run(skip=("raw",)) == ["cases", "transcripts", "audio", "speakers", "flex", "simple"]
    assert not a.write_flex()
    rec, utt = a.load_flex()
    r = rec.first()
    assert (r.term, r.docket, r.transcript_type, r.total_speakers, r.source_era, r.other_speakers) == ("2021", "21-1", "oral_argument", 2, "digital", [1, 2])
    assert [(u.turn_index, u.valid, u.invalid_reason) for u in utt.orderBy("turn_index").collect()] == [(0, True, None), (1, False, "too_long_ratio"), (2, False, "invalid_duration")]
    s = a.load_simple().collect()
    assert [(x.sentence, x._split) for x in s] == [("We will hear it.", "lt1m")] and AU.decode(bytes(s[0].audio.bytes))[0].shape[1] == 3200
    assert a.stats_cases().first().with_arguments == 1 and a.stats_transcripts().first().turns == 3 and a.stats_audio().first().anomalies == 0
    assert a.stats_speakers().count() == 1
    assert Archive(spark, root, "98-00").stats_cases().first().cases == 0
