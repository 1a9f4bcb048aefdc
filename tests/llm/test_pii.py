import pytest
from pyspark.sql import functions as F

from turnmill.llm import pii as P


@pytest.mark.parametrize("text,want", [
    ("write to a.b+c@mail.x.example.", [("a.b+c@mail.x.example", "email")]), ("mail Q_W [at] post [dot] x [dot] test now", [("Q_W [at] post [dot] x [dot] test", "email")]),
    ("a(at)b.example", [("a(at)b.example", "email")]), ("it is ivo dot mond at north dash fork dot example.", [("ivo dot mond at north dash fork dot example", "email")]), ("The handle @clerk is none.", []),
    ("call tel:+1-411-555-0118 or (604) 555-0183.", [("tel:+1-411-555-0118", "phone"), ("(604) 555-0183", "phone")]), ("+1 (253) 555-0158 ext. 12", [("+1 (253) 555-0158 ext. 12", "phone")]),
    ("+44 759 7946 0129 and +49 370 5550157, 0699/5550176", [("+44 759 7946 0129", "phone"), ("+49 370 5550157", "phone"), ("0699/5550176", "phone")]), ("366–555–0103", [("366–555–0103", "phone")]),
    ("was five five five, oh one seven four.", [("five five five, oh one seven four", "phone")]),
    ("counter 0455-0102, ratio 303.555.11, no. 7781 0042 19, item 0-000-11111-2, Exhibit 12-34-5678", []),
    ("at 6986 Beacon Hill Blvd., Apt. 27B, Lakeport?", [("6986 Beacon Hill Blvd., Apt. 27B, Lakeport", "address")]), ("at Unit 20, 4819 Herring Wharf, Lakeport.", [("Unit 20, 4819 Herring Wharf, Lakeport", "address")]),
    ("2585 County Road 9\nMt. Carrow, QX 00509 last", [("2585 County Road 9\nMt. Carrow, QX 00509", "address")]), ("P.O. Box 907, Mt. Carrow, QX, tel.", [("P.O. Box 907, Mt. Carrow, QX", "address")]),
    ("vive en Calle del Olmo 12, 5.º B, 12532 Villasol.", [("Calle del Olmo 12, 5.º B, 12532 Villasol", "address")]), ("in Lindenhofstraße 59a, 17854 Neuwerda.", [("Lindenhofstraße 59a, 17854 Neuwerda", "address")]),
    ("habite 26 bis, rue du Vieux Lavoir, 46319 Montrésine.", [("26 bis, rue du Vieux Lavoir, 46319 Montrésine", "address")]), ("Old Mill Road was closed in 1987. They met at Quarry Street and Foundry Ave.", [])])
def test_structured(text, want):
    assert [(text[a:b], k) for a, b, k in P.structured(text)] == want


@pytest.fixture(scope="module")
def learned(spark):
    names = [f"{f} {s}" for f in ("Maren", "Tobias", "Junia", "Petra") for s in ("Harrowby", "Selwyn", "Dunwyn")]
    people = spark.createDataFrame([(n,) for n in names] + [(None,), ("Single",)], "name string")
    rows = []
    for i, n in enumerate(names * 3):
        rows += [f"The lease names {n} as tenant.", f"In {n.split()[1]} v. Harmon County the panel split.", f"The {n.split()[1]} River floods.", f"Passport {100 + i}-45-{6000 + i} was issued to {n}.",
                 f"Tell {n.split()[0]} I said so."]
    rows += ["The lease names Will Orbury as tenant.", "The lease names 남궁해솔 as tenant.", "Passport X3617357 was issued to Petra Selwyn.", "Tell Art I said so.", None, ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, kind string")
    bits = P.name_filter(people)
    scanned = P.scan_documents(df, "doc_id", "text", bits, keep_text=True).cache()
    return df, bits, scanned, *P.learn(scanned)


def found(learned, text):
    _, bits, _, patterns, shapes = learned
    return [(text[a:b], k) for a, b, k in P.find(text, P.NameFilter(bits), patterns, shapes)]


@pytest.mark.parametrize("text,want", [
    ("The lease names Will Orbury as tenant.", [("Will Orbury", "name")]), ("The lease names 남궁해솔 as tenant.", [("남궁해솔", "name")]), ("Passport X3617357 was issued to Petra Selwyn.", [("X3617357", "id_number"), ("Petra Selwyn", "name")]),
    ("Tell Art I said so.", [("Art", "name")]), ("In Selwyn v. Harmon County the panel split.", []), ("The Dunwyn River floods.", []), ("Mr. Selwyn left with Dr. A. B. Dunwyn.", [("Selwyn", "name"), ("A. B. Dunwyn", "name")]),
    ("Form W-204-55-1 was never filed. Docket No. 80-1481 stands.", []), ("", []), (None, [])])
def test_patterns_find_what_seeds_don_t(learned, text, want):
    assert (found(learned, text) if text is not None else P.find(None, P.NameFilter(learned[1]), {}, {})) == want


def test_redaction_keeps_the_rest(spark, learned):
    df, _, scanned, patterns, shapes = learned
    out = {r.doc_id: r.text for r in P.find_all(scanned, "doc_id", patterns, shapes, redact=True).collect()}
    items = {}
    for r in P.find_all(scanned, "doc_id", patterns, shapes).collect():
        items.setdefault(r.doc_id, []).append((r.start_char, r.end_char, r.kind))
    for r in df.collect():
        assert out[r.doc_id] == P.redacted(r.text, sorted(items.get(r.doc_id, [])))
    assert out[0] == "The lease names [NAME] as tenant."
    assert P.find_all(scanned.limit(0), "doc_id", patterns, shapes).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    bits = P.name_filter(spark.createDataFrame([], "name string"))
    scanned = P.scan_documents(df, "doc_id", "text", bits)
    assert P.learn(scanned) == ({}, {}) and P.find_all(scanned, "doc_id", {}, {}).agg(F.count("*")).first()[0] == 0


def test_long_text(learned):
    t = "The court met at noon. " * 20000 + "Mail x@y.example."
    assert found(learned, t) == [("x@y.example", "email")]


def test_all_confident_patterns_count(spark):
    n = 50_100  # the patterns of fewest instances come last in any order by number
    rows = spark.range(3 * n + 1).select("id", (F.col("id") % n).alias("p"), (F.col("id") == 3 * n).alias("open"))
    rows = rows.withColumn("p", F.when(F.col("open"), n - 1).otherwise(F.col("p")))
    c = F.struct(F.lit(0).alias("a"), F.lit(4).alias("b"), F.lit("name").alias("kind"), F.concat(F.lit("x y"), "id").alias("inst"), F.when(F.col("open"), 0.2).otherwise(1.0).alias("prior"),
                 (~F.col("open")).alias("sure"), *(F.concat(F.lit(f"name\t{k}\t"), F.lpad(F.col("p").cast("string"), 9, "0")).alias(x) for k, x in (("L", "left"), ("M", "around"), ("R", "right"))))
    scanned = rows.select(F.col("id").alias("doc_id"), F.expr("cast(array() as array<struct<a:int,b:int,kind:string>>)").alias("found"), F.array(c).alias("candidates"))
    patterns, shapes = P.learn(scanned, rounds=1)
    assert len(patterns) == 3 * n and not shapes
    last = scanned.where(f"doc_id = {3 * n}")
    assert [tuple(r) for r in P.find_all(last, "doc_id", P.learn_table(scanned, rounds=1)).collect()] == [(3 * n, 0, 4, "name")]


def test_names_without_capitals_outside_of_frames(spark):
    people = spark.createDataFrame([(f"{f} {s}",) for f in ("Maren", "Tobias", "Junia") for s in ("Harrowby", "Selwyn", "Dunwyn")], "name string")
    known = ("欧阳砚秋", "司徒云岫", "闻人子墨", "上官若兰")
    rows = [f"Please ask {f} {s} about the lease." for f in ("Maren", "Tobias", "Junia") for s in ("Harrowby", "Selwyn", "Dunwyn")] + ["please ask junia selwyn about it.", "please ask junia penrgate about it.", "The court may grant rent about it."]
    rows += [f"原告{n}的邮箱很旧。" for n in known] + [f"昨天律师{n}出庭了。" for n in known] + ["昨天律师慕容听雪出庭了。", "法院审查了合同。", "费用包括合同。"]
    hindi = ("अनन्या मेहरोत्रा", "विवेक चतुर्वेदी", "कविता श्रीवास्तव", "रोहन भट्टाचार्य")
    rows += [f"गवाह {n} ने कहा।" for n in hindi] + [f"आज वकील {n} आए थे।" for n in hindi] + ["आज वकील नंदिनी अग्निहोत्री आए थे।"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    scanned = P.scan_documents(df, "doc_id", "text", P.name_filter(people)).cache()
    got = {}
    for r in P.find_all(scanned, "doc_id", P.learn_table(scanned)).collect():
        got.setdefault(rows[r.doc_id], []).append(rows[r.doc_id][r.start_char:r.end_char])
    assert got.get("please ask junia selwyn about it.") == ["junia selwyn"] and got.get("please ask junia penrgate about it.") == ["junia penrgate"]
    assert got.get("昨天律师慕容听雪出庭了。") == ["慕容听雪"] and got.get("昨天律师上官若兰出庭了。") == ["上官若兰"]
    assert got.get("आज वकील नंदिनी अग्निहोत्री आए थे।") == ["नंदिनी अग्निहोत्री"]
    assert not {"法院审查了合同。", "费用包括合同。", "The court may grant rent about it."} & set(got)


@pytest.mark.parametrize("mail", ["a ( at ) b.example", "a [ at ] b.example", "a[ at ]b.example", "a ( at) b.example", "a [\nat\n] b [dot] example"])
def test_every_form_of_the_mark_is_searched_for(mail):
    assert [(a, b, k) for a, b, k in P.structured(f"Mail {mail} now.")] == [(5, 5 + len(mail), "email")]


def test_rounds_settle(learned):
    """More rounds than it takes change no confidence by more than what the damping leaves to come."""
    scanned = learned[2]
    settled = {r["key"]: r["c"] for r in P.learn_table(scanned).collect()}
    longer = {r["key"]: r["c"] for r in P.learn_table(scanned, rounds=30).collect()}
    left = P.SETTLED * P.DAMPING / (1 - P.DAMPING)
    assert settled and all(abs(longer.get(k, P.CONFIDENCE) - c) <= left for k, c in settled.items()) and all(c - P.CONFIDENCE <= left for k, c in longer.items() if k not in settled and not k.startswith(P.SHAPE))


def test_name_filter_grows_with_its_words(spark):
    few, many = (P.name_filter(spark.range(n).selectExpr("concat('a', id, ' b', id) as name")) for n in (10, 200_000))
    assert len(few) * 8 == P.LEAST_BITS and len(many) * 8 >= P.WORD_BITS * 400_000
    names = P.NameFilter(many)
    assert all(names.first(f"a{i}") for i in range(1000)) and sum(names.first(f"zz{i}") for i in range(5000)) < 30
