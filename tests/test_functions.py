import pytest
from pyspark.sql import functions as F

from turnmill.functions import artifacts as A
from turnmill.functions import ids
from turnmill.functions import measures as M
from turnmill.functions import terms


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("rid,kind,date", [
    ("21-86_20221107-argument", "oral_argument", (2022, 11, 7)), ("21-476_20230630-opinion-dissent", "dissent", (2023, 6, 30)), ("20000418a_99-224", "oral_argument", (2000, 4, 18)),
    ("19990303o_96-1793", "opinion", (1999, 3, 3)), ("19990303r_96-1793", "oral_argument", (1999, 3, 3)), ("95-7452_19961104a", "unknown", None), ("", "unknown", None),
    ("1_20220231-opinion-concur", "concurrence", (2022, 2, 31)), ("1_20221301-argument", "oral_argument", None)])
def test_recording_ids(spark, rid, kind, date):
    assert one(spark, rid, "string", ids.recording_type) == kind
    got = one(spark, rid, "string", ids.recording_date)
    assert (tuple(got) if got else None) == date


@pytest.mark.parametrize("title,date", [("Oral Argument - December 05, 2022", "2022-12-05"), ("Oral Argument, March 23, 2015 (Part 1)", "2015-03-23"), ("Life - of the Law", None), ("Oral Argument - May 32, 2000", None),
                                        ("X - Foo 12, 2000", None), (None, None)])
def test_title_dates(spark, title, date):
    assert one(spark, title, "string", lambda c: ids.iso_date(ids.title_date(c))) == date


def test_titles(spark):
    o = lambda t: tuple(one(spark, t, "string", ids.opinion_title))
    t = lambda x: tuple(one(spark, x, "string", ids.transcript_title))
    assert o("Dissenting Opinion - Ettlesham - June 1, 2020") == ("dissent", "Ettlesham")
    assert o("Opinion Announcement - May 1, 1990 (Dissent by Lathbury)") == ("dissent", "Lathbury")
    assert o("Concurring Opinion - Jellicote - x") == ("concurrence", "Jellicote")
    assert o("Opinion Announcement (Part 1)") == ("majority", None)
    assert t("Oral Argument - Part 2") == ("oral_argument", None) and t("Opinion Announcement") == ("opinion", None) and t("Session") == ("unknown", None)
    assert t("Opinion Announcement (Dissent by Lathbury)") == ("opinion", None)


def test_small_functions(spark):
    assert one(spark, 1670198400, "long", ids.epoch_date) == "2022-12-05"
    assert one(spark, -86401, "long", ids.epoch_date) == "1969-12-30"
    assert one(spark, None, "long", ids.epoch_date) is None
    assert one(spark, "John G. O'Neil, Jr.", "string", ids.slug) == "john_g_oneil_jr"
    assert one(spark, None, "string", ids.slug) == ""
    assert [one(spark, t, "string", ids.era) for t in ("2006", "2005", "x", None)] == ["digital", "analog", "unknown", "unknown"]
    assert one(spark, "a/case_data/2020/21-1/x.mp3", "string", ids.term_and_docket) == ("2020", "21-1")
    assert one(spark, "https://b.s3.amazonaws.com/k/x.mp3", "string", ids.bucket_and_key) == ("b", "k/x.mp3")
    assert one(spark, "application/vnd.api+json; charset=x", "string", ids.extension) == ".json"
    assert one(spark, "https://u@h.x:80/p?q", "string", ids.url_host) == "u@h.x:80"
    media = [("audio/mpeg", "a"), None, ("audio/mpeg", "b"), ("x/y", "c")]
    df = spark.createDataFrame([(media,)], "m array<struct<mime:string,href:string>>")
    assert df.select(ids.audio_urls(F.col("m")).alias("u")).first()["u"] == {"mp3": "b"}


@pytest.mark.parametrize("n,b", [(0, "3-5"), (1, "1"), (2, "2"), (3, "3-5"), (5, "3-5"), (6, "6-10"), (10, "6-10"), (11, "11+")])
def test_recordings_buckets(spark, n, b):
    assert one(spark, n, "long", M.recordings_bucket) == b


def test_spoken_buckets_and_splits(spark):
    got = [one(spark, m * 60.0, "double", M.spoken_bucket) for m in (0.5, 1, 5, 15, 30, 60, 120, 300, 600, 3000, 6000)]
    assert got == ["<1m", "1-5m", "5-15m", "15-30m", "30-60m", "1-2h", "2-5h", "5-10h", "10-50h", "50-100h", "100h+"]
    assert [one(spark, x, "double", M.duration_split) for x in (59.9, 60.0, 300.0, 1800.0, None)] == ["lt1m", "lt5m", "lt30m", None, "lt1m"]


def test_formats(spark):
    assert one(spark, 1536, "long", M.human_size) == "1.5 KB" and one(spark, 0, "long", M.human_size) == "0.0 B"
    assert one(spark, 5400.0, "double", M.hours) == "1.5" and one(spark, 3725, "long", M.hms) == "1h 2m 5s"


def test_turn_problems(spark):
    rows = [(-1.0, "a", 1, 0.0), (0.0, "a", 1, 0.0), (5.0, " ", 0, 0.0), (15.0, "a", 1, 0.0), (10.0, "a", 1, 5.0), (12.0, "a", 200, 0.0), (20.0, "a", 20, 3.0), (None, "a", 1, 0.0)]
    df = spark.createDataFrame(rows, "d double, t string, w int, o double")
    p = M.turn_problem(F.col("d"), F.col("t"), F.col("w"), F.col("o"))
    got = df.select(p.alias("p"), M.turn_problem_text(p, F.col("d"), F.col("w"), F.col("o")).alias("x")).collect()
    assert [r.p for r in got] == ["invalid_duration", "invalid_duration", "empty_text", "wpm_too_low", "overlap", "wpm_too_high", None, "invalid_duration"]
    assert got[3].x == "wpm_too_low:4.0" and got[4].x == "overlap:5.0s"


def test_audio(spark):
    silent, flat, bursts = [0.0] * 64, [0.3] * 64, [0.5, -0.5, 0.5, -0.5, 0.0, 0.0, 0.0, 0.0] * 8
    f = lambda v, n=8: spark.createDataFrame([(v,)], "s array<float>").select(M.audio_problem(F.col("s"), M.frame_energies(F.col("s"), n)).alias("p")).first()["p"]
    assert f(silent) == "silent" and f(flat) == "constant_noise" and f(bursts, 4) is None and f([]) == "silent"
    df = spark.createDataFrame([([float(i) for i in range(16)],)], "s array<float>")
    seg = lambda a, b: df.select(M.segment(F.col("s"), F.lit(8), F.lit(a), F.lit(b)).alias("x")).first()["x"]
    assert seg(0.25, 0.5) == [2.0, 3.0] and seg(1.0, 9.0) == [8.0 + i for i in range(8)] and seg(0.5, 0.5) is None


@pytest.mark.parametrize("text,years", [("98-00,22", ["1998", "1999", "2000", "2022"]), ("2020-22", ["2020", "2021", "2022"]), ("50", ["2050"]), ("51", ["1951"]), ("99-01, 1999", ["1999", "2000", "2001"])])
def test_terms(text, years):
    assert terms.parse_terms(text) == years


@pytest.mark.parametrize("text", ["", " , ", "abc", "1", "1849", "2010-05x", "1950-2060"])
def test_bad_terms(text):
    with pytest.raises(ValueError):
        terms.parse_terms(text)
    assert terms.parse_terms(None) is None and terms.parse_term_lists([]) is None


@pytest.mark.parametrize("text,want", [
    ("We rely on the EPA. It cost $40,000 in 1215.", {("acronyms", "EPA"), ("currency", "$40000"), ("historical_years", "1215")}),
    ("No. I disagree. In No. 96-511 we held", {("no_dot_context", "I"), ("no_dot_citation", "No. 96-511"), ("case_ids", "96-511")}),
    ("The vote was 9-0 in 21-1164", {("vote_tally", "9-0"), ("case_ids", "21-1164")}),
    ("50% or 25 percent in the 1980s", {("percentages", "50%"), ("percentages", "25%"), ("decades", "1980s")}),
    ("(Inaudible) [Laughter] {b} 1) .66 6-8 ...", {("non_speech_brackets", "(Inaudible)"), ("non_speech_brackets", "[Laughter]"), ("awareness_brackets_curly", "{b}"), ("numbered_list_marker", "1)"),
                                                    ("leading_decimal", ".66"), ("dash_range", "6-8"), ("ellipsis", "...")}),
    ("Smith v. Jones, et al. é", {("versus", "v."), ("abbreviations", "et al."), ("awareness_non_ascii", "U+00E9")})])
def test_artifacts(spark, text, want):
    got = {(r.category, r.token) for r in spark.createDataFrame([(text,)], "t string").select(F.explode(A.artifact_entries(F.col("t"))).alias("e")).select("e.*").collect()}
    assert want <= got


def test_artifacts_of_nothing(spark):
    df = spark.createDataFrame([(None,), ("",)], "t string")
    assert A.artifact_counts(df, "t").count() == 0
    need = A.rules_wanting_examples(A.artifact_counts(df, "t"), spark.createDataFrame([], "category string, path string"), 1)
    assert need.count() == 18


def test_fetch_classes_of_errors(spark):
    """Codes count as codes: digits and words in a text that only look like one don't."""
    from turnmill.functions import ids

    rows = [(500, "timeout on host 4041", "failed"), (None, "port 4030 refused", "transient"), (None, "Unrecognized S3 URL format: http://x", "skipped"), (None, "An error occurred (NoSuchKey)", "skipped"),
            (None, "AccessDenied", "skipped"), (404, None, "skipped"), (403, "", "skipped"), (200, None, "new"), (503, "x", "transient"), (400, "x", "failed"), (None, None, "transient")]
    df = spark.createDataFrame(rows, "status int, error string, want string")
    got = df.select(ids.fetch_class(df.status, df.error, F.lit(False)).alias("c"), "want").collect()
    assert [r.c for r in got] == [r.want for r in got]


def test_artifacts_see_blanks_and_digits_of_all_scripts(spark):
    from turnmill.functions import artifacts as A

    got = {(r.category, r.token) for r in A.artifact_counts(spark.createDataFrame([("John F. Doe, No. 12-34",)], "t string"), "t").collect()}
    assert any(c == "likely_initials" for c, _ in got) and any("12-34" in t for _, t in got)


def test_shared_folder_is_asked_for_on_clusters():
    import pytest
    from turnmill.session import shared_dir

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError):
        shared_dir(Session)
