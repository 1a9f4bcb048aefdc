import random

import pytest
from pyspark.sql import functions as F

from turnmill.llm import turns as T
from turnmill.llm.scan import scan


@pytest.mark.parametrize("name,want", [
    ("Maren A. Harrowby", ("maren", "harrowby")), ("Harrowby, Maren A.", ("maren", "harrowby")), ("JUSTICE HARROWBY:", ("", "harrowby")), ("Harrowby, J.", ("", "harrowby")), ("J. Harrowby", ("", "harrowby")),
    ("mrs Penrelle", ("", "penrelle")), ("Ulvone (for petitioner)", ("", "ulvone")), ("Varnbrook, Esq.", ("", "varnbrook")), ("Mr. Chief Justice", ("", T.CHIEF)), ("The Chief Justice:", ("", T.CHIEF)),
    ("  Petra Farthingay\xa0", ("petra", "farthingay")), ("Mr. Justice Ockendale", ("", "ockendale")), ("Unknown Speaker", None), ("?", None), ("", None), (None, None), ("Voice", None), ("UNIDENTIFIED", None)])
def test_name_parts(name, want):
    assert T.name_parts(name) == want


@pytest.mark.parametrize("text,want", [
    ("JUSTICE X: Uh, the [Laughter] court met.", "the court met."), ("You know, it was, um, late.", "it was, late."), ("Uh -- Well, no.", "Well, no."), ("(Laughter)", ""), ("plain text.", "plain text.")])
def test_clean(text, want):
    assert T.clean(text, scan(text)) == want


def settle(spark, rows, people=(), present=(), chiefs=()):
    df = spark.createDataFrame(rows, "r long, i int, speaker_id long, speaker_name string, text string, kind string")
    m = T.mark(df, ["r", "i"], "text", "speaker_id", "speaker_name")
    out = T.settle_speakers(m, ["r", "i"], "r", spark.createDataFrame(list(people), "speaker_id long, name string"), spark.createDataFrame(list(present), "r long, speaker_id long"),
                            spark.createDataFrame(list(chiefs), "r long, speaker_id long"))
    return {(x.r, x.i): (x.person, x.said) for x in out.collect()}


def test_speakers_settled(spark):
    people = [(1, "Ada Q. Harrowby"), (2, "Bo Selwyn"), (3, "Cy Selwyn"), (4, "Di Marlow"), (5, "Ed Marlow"), (6, None), (None, "No One")]
    rows = [(1, 0, 1, None, "Yes.", ""), (1, 1, None, "Harrwoby", "No.", ""), (1, 2, None, None, "MR. HARROWBY: Go on.", ""), (1, 3, None, "Cy Selwyn", "I see.", ""), (1, 4, None, "Selwyn", "I see.", ""),
            (1, 5, None, "Ed Marlow", "x", ""), (1, 6, None, "Marlow", "x", ""), (1, 7, None, "Chief Justice", "x", ""), (1, 8, None, None, None, ""), (1, 9, None, "?", "", ""), (2, 0, None, "Harrwoby", "x", ""),
            (1, 10, None, "Nobody Known", "uh", "")]
    got = settle(spark, rows, people, [(1, 1), (1, 2), (None, 4)], [(1, 4)])
    assert {k[1]: v[0] for k, v in got.items() if k[0] == 1} == {0: 1, 1: 1, 2: 1, 3: 3, 4: 2, 5: 5, 6: -1, 7: 4, 8: -1, 9: -1, 10: -1}
    assert got[(2, 0)][0] == -1
    assert not got[(1, 8)][1] and not got[(1, 9)][1] and not got[(1, 10)][1] and got[(1, 2)][1]
    assert settle(spark, []) == {}


@pytest.mark.parametrize("block", [1, 3, 8, 4096])
def test_runs_in_blocks(spark, block):
    rng = random.Random(block)
    rows = [(r, i, rng.choice([1, 1, 1, 2, -1])) for r in range(4) for i in rng.sample(range(60), 40)]
    want = []
    for r in range(4):
        cur = None
        for _, i, p in sorted(x for x in rows if x[0] == r):
            if cur and cur[3] == p != -1:
                cur[2], cur[4] = i, cur[4] + 1
            else:
                cur = [r, i, i, p, 1]
                want.append(cur)
    df = spark.createDataFrame(rows + [(None, 1, 1), (1, None, 1)], "r long, i int, p long")
    assert sorted(tuple(x) for x in T.runs_of_one_person(df, "r", "i", "p", block).collect()) == sorted(map(tuple, want))


def test_items(spark):
    df = spark.createDataFrame([(1, 0, None, None, "[0:03] X, J.: uh (noise)", "")], "r long, i int, speaker_id long, speaker_name string, text string, item string")
    m = T.mark(df, ["r", "i"], "text", "speaker_id", "speaker_name")
    assert [(x.item, x.start_char, x.end_char) for x in T.item_rows(m, ["r", "i"]).orderBy("start_char").collect()] == [("timestamp", 0, 6), ("label", 7, 13), ("filler", 14, 16), ("annotation", 17, 24)]
    assert m.select(F.col("said")).first()[0] is False
