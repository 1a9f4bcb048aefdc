import numpy as np
import pyarrow.parquet as pq
import pytest

from turnmill.llm import sentences as S

TEXT = [
    "The court met. It rose at noon. Mr. Dunwyn left with Ms. Orford. The bill of Copperfield Mills Inc. was paid. Mr. Selwyn saw No. 12-34 there. We agree!",
    "They asked, \"Is it so?\" The order says, \"It is.\" It was good. (It was late.) Why? He wrote, 'Is it?' and left. Dr. Halvick read it. Dr. Orford did not.",
    "Der 2. Senat tagte. Wer kam? Niemand kam! El Dr. y la Dra. leyeron. ¿Quién vino? Το άρθρ. 5 ισχύει. Ποιος ήρθε; Κανείς δεν ήρθε!",
    "法院审查了合同。谁签署了？证人说：“没有。”法院审查了笔录。", "証人は「見ていない。」と述べました。誰が来ましたか？証人は来ました。", "डॉ. साहब ने पढ़ा। किसने पढ़ा? डॉ. साहब ने पढ़ा।",
    "ไม่มีใครคัดค้าน ศาลพิจารณา ใครลงนาม", "Ծախսը կազմեց 19.8 դրամ։ Ո՞վ եկավ։"]


@pytest.fixture(scope="module")
def model(data):
    """The model of the smallest test table, whose texts are in all these languages."""
    counts = {}
    for t in pq.read_table(f"{data}/turns.parquet", columns=["text"])["text"].to_pylist() + TEXT:
        laid = S.lay_out(t) if t else None
        for _, key, _ in laid[1] if laid else []:
            counts[key] = counts.get(key, 0) + 1
    m = None
    for _ in range(S.ROUNDS + 1):
        m = S.Model(*S.expected(counts.items(), m), None)
    m.step = S.step_factors(np.ones((3, 2, 2))).tolist()
    return m


def cut(t, m):
    out, p = [], 0
    for e in S.sentence_ends(t, m):
        out.append(t[p:e].strip())
        p = e
    return out


@pytest.mark.parametrize("text,want", [
    ("Mr. Orford left. It was late.", ["Mr. Orford left.", "It was late."]),
    ("He wrote, 'Is it?' and left. Why?", ["He wrote, 'Is it?' and left.", "Why?"]),
    ("It cost 3.5 and 1,000.25 there. We agree!", ["It cost 3.5 and 1,000.25 there.", "We agree!"]),
    ("法院审查了合同。证人说：“没有。”谁签署了？", ["法院审查了合同。", "证人说：“没有。”", "谁签署了？"]),
    ("証人は「見ていない。」と述べました。誰が来ましたか？", ["証人は「見ていない。」と述べました。", "誰が来ましたか？"]),
    ("डॉ. साहब ने पढ़ा। किसने पढ़ा?", ["डॉ. साहब ने पढ़ा।", "किसने पढ़ा?"]),
    ("ไม่มีใครคัดค้าน ศาลพิจารณา", ["ไม่มีใครคัดค้าน", "ศาลพิจารณา"]),
    ("It was good. We agree --", ["It was good.", "We agree --"]),
    ("JUSTICE X: It was good. (Laughter.) We agree! [Applause] 00:01:02", ["JUSTICE X: It was good.", "(Laughter.) We agree!"]),
    ("Er, um.", ["Er, um."]), ("Uhh...", ["Uhh..."]), ("Uh -- We agree!", ["Uh -- We agree!"]), ("We agree! uh", ["We agree! uh"]),
    ("(Laughter)", []), ("JUSTICE X:", []), ("", []), (None, []), (" \n ", [])])
def test_sentences(text, want, model):
    assert cut(text, model) == want if text is not None else S.sentence_ends(text, model) == want


def test_posteriors_match_enumeration(model):
    keys = [k for _, k, _ in S.lay_out(TEXT[1])[1]][:6]
    codes = [0, 2, 4, 0, 2, 4][: len(keys)]
    n = len(keys)
    total, mass = 0.0, [0.0] * n
    for state in range(1 << n):
        e = [(state >> i) & 1 for i in range(n)]
        p = 1.0
        for i in range(n):
            p *= np.exp(model.odds(keys[i])) if e[i] else 1.0
            if i:
                p *= model.step[codes[i] >> 1][e[i - 1]][e[i]]
        total += p
        for i in range(n):
            mass[i] += p * e[i]
    assert np.allclose(model.posteriors(keys, codes), [m / total for m in mass])


def test_in_spark_same_as_alone(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*TEXT, None, "", "(Laughter)"])]
    df = spark.createDataFrame(rows, "id long, text string, end_char string")
    laid = S.lay_out_all(df, ["id"], "text")
    m = S.train(laid)
    got = {}
    for r in S.sentences(laid, ["id"], m).collect():
        got.setdefault(r.id, []).append(r.end_char)
    for i, t, _ in rows:
        assert sorted(got.get(i, [])) == S.sentence_ends(t, m)
    assert S.sentences(S.lay_out_all(df.limit(0), ["id"], "text"), ["id"], m).count() == 0
    empty = S.train(S.lay_out_all(df.limit(0), ["id"], "text"))
    assert S.sentence_ends("It rose at noon. The court met.", empty) == [16, 31]


def test_texts_without_marks():
    """Between all words, where no mark is written: the passes use both sides and the words since the boundary before."""
    from turnmill.llm.unmarked import Unmarked

    rng = __import__("random").Random(5)
    who, did, when = ["the court", "it", "we", "they", "the jury"], ["met", "rose", "left", "agree", "heard us"], ["at noon", "today", "in april", "again"]
    one = lambda: f"{rng.choice(who)} {rng.choice(did)} {rng.choice(when)}".split()
    zh = [list(x) for x in ("法院审查了合同", "谁签署了合同", "证人来了", "法院审查了笔录", "证人说没有", "谁来了")]
    u = Unmarked().fit([[one() for _ in range(4)] for _ in range(400)] + [[rng.choice(zh) for _ in range(3)] for _ in range(300)])
    m = S.Model(np.zeros((2, 64)), np.zeros((2, 64)), np.ones((3, 2, 2)).tolist(), u)
    assert cut("the court met at noon it rose today we agree again they left in april", m) == ["the court met at noon", "it rose today", "we agree again", "they left in april"]
    assert cut("(Laughter) the court met at noon uh it rose today", m) == ["(Laughter) the court met at noon", "uh it rose today"]
    assert cut("法院审查了合同谁签署了合同证人来了", m) == ["法院审查了合同", "谁签署了合同", "证人来了"]
    assert cut("法院审查了合同 谁签署了 证人来了", m) == ["法院审查了合同", "谁签署了", "证人来了"]
    assert cut("the court met, it rose", m) == ["the court met, it rose"] and cut("it rose and", m) == ["it rose and"] and cut("it rose --", m) == ["it rose --"]
    # brute force over all placings of boundaries
    words = "it rose today we agree".split()
    forms, mass, total = words, [0.0] * 4, 0.0
    for state in range(16):
        at = [(state >> i) & 1 for i in range(4)]
        stream, p = ["\x02"], 1.0
        for i, w in enumerate(forms):
            stream += [w] + (["\x02"] if i == 4 or at[i] else [])
        for i in range(1, len(stream)):
            p *= u.chance(*stream[max(0, i - 2):i + 1])
        total += p
        mass = [a + p * b for a, b in zip(mass, at)]
    assert np.allclose(u.posteriors(words), [x / total for x in mass])


def test_steps_are_learned(spark):
    """Gaps that are plain alone and answer each other: the step factors come from the counts as they are."""
    steps = np.ones((3, 2, 2))
    steps[2] = [[90.0, 10.0], [10.0, 90.0]]
    f = S.step_factors(steps)
    assert np.allclose(f[2], [[1.8, 0.2], [0.2, 1.8]]) and np.allclose(f[0], 1.0)
    m = S.Model(np.zeros((2, 64)), np.zeros((2, 64)), f.tolist())
    keys = ["word\t.\tThe", "No\t.\tSelwyn", "word\t.\tThe"]
    alone = S.Model(np.zeros((2, 64)), np.zeros((2, 64)), np.ones((3, 2, 2)).tolist()).posteriors(keys, [4, 4, 4])
    assert m.posteriors(keys, [4, 4, 4])[1] > alone[1]


def test_spark_finds_texts_without_marks(spark):
    rows = [(i, f"The {w} met at noon. It rose today. We agree again.") for i, w in enumerate(("court", "jury", "board", "panel") * 8)] + [(99, "the court met at noon it rose today we agree again")]
    df = spark.createDataFrame(rows, "id long, text string")
    laid = S.lay_out_all(df, ["id"], "text")
    m = S.train(laid, df)
    assert [r.end_char for r in S.sentences(laid, ["id"], m).where("id = 99").orderBy("end_char").collect()] == [21, 35, 50]
    assert S.train(laid).unmarked is None


def test_texts_without_marks_learn_from_all_texts(spark):
    """No text is left out of the counts, however many and however long they are."""
    long = " ".join(["The court met at noon. It rose today. We agree again."] * 60)
    rows = [(i, f"Word{i} came late. Nobody saw it.") for i in range(20_500)] + [(30_000, long), (30_001, "the court met at noon it rose today we agree again")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    laid = S.lay_out_all(df, ["id"], "text")
    m = S.train(laid, df)
    assert [r.end_char for r in S.sentences(laid, ["id"], m).where("id = 30001").orderBy("end_char").collect()] == [21, 35, 50]
    from turnmill.llm.unmarked import BOUNDARY, GRAM, Unmarked

    whole = Unmarked().fit(S.sentence_words(t, m) for _, t in rows)
    grams = [("the", "court", "met"), ("it", "rose", "today"), (BOUNDARY, "it", "rose"), ("saw", "it", BOUNDARY), ("it", BOUNDARY, "we"), ("came", "late", BOUNDARY), ("never", "seen", "it"), ("nobody", "saw", "never")]
    got = {tuple(r[g] for g in GRAM): r["p"] for r in m.unmarked.chances(spark.createDataFrame(grams, GRAM)).collect()}
    assert got == {g: pytest.approx(whole.chance(*g), rel=1e-12) for g in grams}
    assert m.unmarked.after == whole.after[()] and m.unmarked.kinds == whole.kinds[()] and m.unmarked.capital == whole.capital
