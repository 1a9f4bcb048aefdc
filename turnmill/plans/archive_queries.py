"""Queries over cases, transcripts, turns, speakers and fetched documents, with the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import artifacts as A
from turnmill.functions import ids
from turnmill.functions import measures as M
from turnmill.functions.spoken import normalize
from turnmill.functions.terms import parse_terms
from turnmill.operators import linking as L
from turnmill.operators import quality as Q
from turnmill.operators import speakers as S
from turnmill.operators import transcripts as T
from turnmill.operators import versions as V
from turnmill.operators.current import current_rows
from turnmill.operators.nested import emit_raw
from turnmill.session import durable, shared_dir, table
from turnmill.sources.landing import load_flex
from turnmill.sources.tiers import write_tier
from turnmill.streaming.incremental import run_once, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Views that the checking SQL begins with.
CTES = {
    "cur": "select * from turns where transcript_id is not null and turn_index is not null qualify row_number() over (partition by transcript_id, turn_index order by loaded_at desc nulls last) = 1",
    "tr": "select * from transcripts where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1",
    "ca": "select * from cases where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1",
    "people": "select speaker_id, min(name) as name, min(role) as role from speakers where speaker_id is not null group by 1",
    "lagged": "select *, greatest(0.0, coalesce(lag(stop) over (partition by transcript_id order by turn_index) - start, 0.0)) as ov from cur",
    "valid": (
        "select *, case when coalesce(duration, 0) <= 0 then 'invalid_duration' when trim(coalesce(text, '')) = '' then 'empty_text' "
        "when duration > 10 and word_count / (duration / 60.0) < 30 then 'wpm_too_low' when duration > 10 and word_count / (duration / 60.0) > 600 then 'wpm_too_high' "
        "when ov > 3 then 'overlap' when duration / nullif(greatest(max(stop) over (partition by transcript_id), 0), 0) > 0.5 then 'too_long_ratio' end as problem from lagged"),
    "seen": (
        "select v.transcript_id, v.speaker_id, tr.term, tr.case_docket as docket, count(*) as turns, sum(coalesce(v.duration, 0)) as duration_seconds, sum(coalesce(v.word_count, 0)) as word_count "
        "from valid v join tr on tr.id = v.transcript_id where v.problem is null and v.speaker_id is not null group by 1, 2, 3, 4"),
    "refs": (
        "select a.id as audio_id, ca.term, ca.docket_number as docket, ca.id as case_id, a.pos from ca, "
        "lateral (select unnest(list_concat(coalesce(oral_arguments, []), coalesce(opinion_announcements, []))) as x, generate_subscripts(list_concat(coalesce(oral_arguments, []), coalesce(opinion_announcements, [])), 1) as pos) q, "
        "lateral (select q.x.id as id, q.pos as pos) a where a.id is not null"),
    "cmap": "select audio_id, term, docket from refs qualify row_number() over (partition by audio_id order by case_id desc, pos desc) = 1",
}
_NEEDS = {"lagged": ["cur"], "valid": ["cur", "lagged"], "seen": ["cur", "lagged", "valid", "tr"], "refs": ["ca"], "cmap": ["ca", "refs"]}


def sql(body: str, *views: str) -> str:
    names: list[str] = []
    for v in views:
        for n in [*_NEEDS.get(v, []), v]:
            if n not in names:
                names.append(n)
    return ("with " + ", ".join(f"{n} as ({CTES[n]})" for n in names) + " " if names else "") + body


def query(oracle: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def _turns(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    want = dict.fromkeys(["transcript_id", "turn_index", *cols, "loaded_at"])
    return current_rows(table(spark, d, "turns").select(*want), ["transcript_id", "turn_index"], "loaded_at").drop("loaded_at")


def _transcripts(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return current_rows(table(spark, d, "transcripts").select("id", *cols, "loaded_at"), ["id"], "loaded_at").drop("loaded_at")


def _cases(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return current_rows(table(spark, d, "cases").select("id", *cols, "loaded_at"), ["id"], "loaded_at").drop("loaded_at")


def _people(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "speakers").where("speaker_id is not null").groupBy("speaker_id").agg(F.min("name").alias("name"), F.min("role").alias("role"))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    t = _turns(spark, d, "section_index", "start", "stop", "duration", "speaker_id", "speaker_name", "text_block_count", "word_count", "text")
    return T.with_validity(T.with_overlap(t, "transcript_id", "turn_index"), "transcript_id")


def _seen(spark: SparkSession, d: str) -> DataFrame:
    where = _transcripts(spark, d, "term", "case_docket").select(F.col("id").alias("transcript_id"), "term", F.col("case_docket").alias("docket"))
    return S.appearances(_judged(spark, d).join(where, "transcript_id"), ["transcript_id", "term", "docket"])


# --- turns ----------------------------------------------------------------------------------------------------------
@query(sql("select transcript_id, turn_index, round(ov, 3) as overlap_seconds, ov > 0 as is_overlapping from lagged", "lagged"))
def turn_overlap_lag(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of every turn with the one before."""
    t = T.with_overlap(_turns(spark, d, "start", "stop"), "transcript_id", "turn_index")
    return t.select("transcript_id", "turn_index", F.round("overlap_seconds", 3).alias("overlap_seconds"), "is_overlapping")


@query(sql("select transcript_id, turn_index, problem from valid", "valid"))
def turn_validation(spark: SparkSession, d: str) -> DataFrame:
    """First problem of every turn."""
    return _judged(spark, d).select("transcript_id", "turn_index", "problem")


@query(sql(
    "select transcript_id, count(*) as turn_count, count(distinct section_index) as section_count, cast(sum(text_block_count) as bigint) as text_block_count, "
    "count(*) filter (where ov > 0) as overlap_count, count(*) filter (where problem is not null) as invalid_turn_count, bool_or(speaker_id is null) as has_null_speakers, "
    "round(coalesce(sum(duration) filter (where problem is null and duration > 0), 0), 3) as total_spoken_seconds from valid group by 1", "valid"))
def transcript_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Counts and spoken time of every recording."""
    m = T.metadata(_judged(spark, d), "transcript_id", digits=3)
    return m.drop("last_stop", "spoken_percentage")


@query(sql(
    "select transcript_id, speaker_id, turn_count, name, cast(row_number() over (partition by transcript_id order by turn_count desc, f) as integer) as rank from "
    "(select transcript_id, speaker_id, count(*) as turn_count, min(turn_index) as f, arg_max(speaker_name, turn_index) as name from cur where speaker_id is not null group by 1, 2)", "cur"))
def transcript_speaker_list(spark: SparkSession, d: str) -> DataFrame:
    """Speakers of every recording by number of turns."""
    return T.speaker_lists(_turns(spark, d, "speaker_id", "speaker_name").withColumnRenamed("turn_index", "index"), "transcript_id")


_FLAGS = """, u as (select transcript_id, turn_index, start s, stop e, duration d, word_count w, max(stop) over (partition by transcript_id) m from cur),
o as (select distinct a.transcript_id, a.turn_index from u a join u b on a.transcript_id = b.transcript_id and a.turn_index <> b.turn_index and least(a.e, b.e) - greatest(a.s, b.s) > 3
      where a.s is not null and a.e is not null and b.s is not null and b.e is not null),
r as (select u.transcript_id, u.turn_index, case when coalesce(s < 0 or e < 0 or e < s or abs(d - (e - s)) > 1, true) then 'invalid_timestamps'
  when coalesce(d >= 10 and (w / (d / 60.0) > 600 or w / (d / 60.0) < 30), false) then 'abnormal_wpm' when o.turn_index is not null then 'overlapping'
  when coalesce(d / nullif(greatest(m, 0), 0) > 0.5, false) then 'too_long_ratio' else 'passed' end as reason
  from u left join o on u.transcript_id = o.transcript_id and u.turn_index = o.turn_index) """


@query(sql("", "cur").rstrip() + _FLAGS + "select transcript_id, turn_index, reason from r")
def utterance_quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """Why each utterance can't be used, 'passed' where it can; checked against a self join."""
    t = _turns(spark, d, "start", "stop", "duration", "word_count")
    return Q.flag_utterances(t, ["transcript_id"]).select("transcript_id", "turn_index", "reason")


@query(sql("", "cur").rstrip() + _FLAGS + "select reason, count(*) as n from r group by 1")
def utterance_quality_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Utterances by reason."""
    return utterance_quality_flags(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(sql("select transcript_id, max(stop) as max_end, count(*) filter (where duration / nullif(greatest(m, 0), 0) > 0.5) as long_turns from "
           "(select *, max(stop) over (partition by transcript_id) m from cur) group by 1", "cur"))
def recording_max_end_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Last end of every recording and the turns that fill more than half of it."""
    t = Q.with_group_max(_turns(spark, d, "stop", "duration"), ["transcript_id"], "stop", "m")
    return t.groupBy("transcript_id").agg(F.max("stop").alias("max_end"), F.count_if(F.when(F.col("m") > 0, F.col("duration") / F.col("m")) > M.LARGEST_SHARE).alias("long_turns"))


@query(sql("select split_part(coalesce(nullif(invalid_reason, ''), 'unknown'), ':', 1) as reason, count(*) as n from cur where not coalesce(is_valid, false) group by 1", "cur"))
def invalid_reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Reasons written into invalid turns."""
    t = _turns(spark, d, "is_valid", "invalid_reason").where(~F.coalesce("is_valid", F.lit(False)))
    return Q.reason_histogram(t)


@query(sql("select transcript_id, count(*) as n from cur where is_valid group by 1", "cur"))
def validity_filter(spark: SparkSession, d: str) -> DataFrame:
    """Valid turns of every recording."""
    return Q.keep_valid(_turns(spark, d, "is_valid"), "is_valid").groupBy("transcript_id").agg(F.count(F.lit(1)).alias("n"))


@query(sql("select case when x < 60 then 'lt1m' when x < 300 then 'lt5m' when x < 1800 then 'lt30m' end as split, count(*) as n from (select stop - start as x from cur where start < stop) group by 1", "cur"))
def duration_split_counts(spark: SparkSession, d: str) -> DataFrame:
    """Usable turns by split of duration."""
    t = Q.usable_ranges(_turns(spark, d, "start", "stop"), "start", "stop")
    return t.groupBy(M.duration_split(F.col("duration_sec")).alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query(sql("select transcript_id, turn_index, word_count, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\x{A0}]+'), lambda w: w <> '')) as counted, length(coalesce(text, '')) as chars from cur", "cur"))
def turn_word_counts(spark: SparkSession, d: str) -> DataFrame:
    """Words and characters of every turn, beside what was delivered."""
    return _turns(spark, d, "text", "word_count").select("transcript_id", "turn_index", "word_count", M.word_count(F.col("text")).cast("long").alias("counted"),
                                                        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))


@query()
def interruption_merge(spark: SparkSession, d: str) -> DataFrame:
    """Turns that were broken off and resumed, joined."""
    t = _turns(spark, d, "speaker_id", "text")
    return T.merge_interruptions(t, "transcript_id", "turn_index").where("merged").select("transcript_id", "turn_index", "speaker_id", "text")


#: Turns that are broken off and resumed, in all forms that matter (the test tables hold none), with the text after joining; '' where the turn is gone.
BROKEN = (
    (1, 0, 10, "We say that --", "We say that it is so."), (1, 1, 20, "Is it?", "Is it?"), (1, 2, 10, "-- it is so.", ""),
    (2, 0, 10, "We say –", "We say –"), (2, 1, 20, "word " * 40, "word " * 40), (2, 2, 10, "– no.", "– no."),
    (3, 0, 10, "One —", "One two."), (3, 1, 20, "Yes.", "Yes."), (3, 2, 10, "— two.", ""), (3, 3, 20, "Three.", "Three."),
    (4, 0, 10, "One --", "One --"), (4, 1, 10, "Same.", "Same."), (4, 2, 10, "-- two.", "-- two."),
    (5, 0, None, "One --", "One --"), (5, 1, 20, None, None), (5, 2, 10, "-- two.", "-- two."))


def _literal(v: object) -> str:
    return "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query("select * from (values " + ", ".join(f"({r}, {i}, {_literal(s)}, {_literal(after)})" for r, i, s, _, after in BROKEN if after != "") + ") v(transcript_id, turn_index, speaker_id, text)")
def interruption_forms(spark: SparkSession, d: str) -> DataFrame:
    """Broken-off turns in all forms, joined where one resumes another after a short turn."""
    t = spark.createDataFrame([r[:4] for r in BROKEN], "transcript_id int, turn_index int, speaker_id int, text string")
    return T.merge_interruptions(t, "transcript_id", "turn_index").select("transcript_id", "turn_index", "speaker_id", "text")


# --- speakers -------------------------------------------------------------------------------------------------------
@query(sql("select transcript_id, term, docket, speaker_id, turns, round(duration_seconds, 3) as duration_seconds, cast(word_count as bigint) as word_count from seen", "seen"))
def speaker_appearances(spark: SparkSession, d: str) -> DataFrame:
    """Valid turns, time and words of each speaker in each recording."""
    return _seen(spark, d).drop("name").withColumn("duration_seconds", F.round("duration_seconds", 3))


@query(sql("select speaker_id, count(*) as recordings, count(distinct concat_ws('/', term, docket)) as cases, cast(sum(turns) as bigint) as turns, round(sum(duration_seconds), 3) as duration_seconds, "
           "cast(sum(word_count) as bigint) as word_count, round(coalesce(sum(word_count) / nullif(sum(turns), 0), 0), 4) as avg_words_per_turn from seen group by 1", "seen"))
def speaker_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of every speaker."""
    t = S.totals(_seen(spark, d), digits=3)
    return t.withColumn("avg_words_per_turn", F.round(F.coalesce(F.try_divide("word_count", "turns"), F.lit(0.0)), 4))


@query(sql("select speaker_id, term, count(*) as recordings, cast(sum(turns) as bigint) as turns, round(sum(duration_seconds), 3) as duration_seconds, cast(sum(word_count) as bigint) as word_count from seen group by 1, 2", "seen"))
def speaker_by_term(spark: SparkSession, d: str) -> DataFrame:
    """Totals of every speaker and term."""
    return S.by_term(_seen(spark, d), digits=3)


@query(sql("select speaker_id, term, count(*) as recordings, cast(sum(turns) as bigint) as turns, cast(grouping(term) as integer) as is_total from seen group by grouping sets ((speaker_id, term), (speaker_id))", "seen"))
def speaker_term_and_total(spark: SparkSession, d: str) -> DataFrame:
    """Speaker totals with and without the term, over one scan."""
    seen = _seen(spark, d)
    return seen.groupingSets([["speaker_id", "term"], ["speaker_id"]], "speaker_id", "term").agg(
        F.count(F.lit(1)).alias("recordings"), F.sum("turns").alias("turns"), F.grouping("term").cast("int").alias("is_total"))


@query(sql("select speaker_id, count(distinct concat_ws('/', term, docket)) as cases, count(distinct term) as terms, "
           "case when count(distinct concat_ws('/', term, docket)) >= 4 and count(distinct term) >= 2 or speaker_id in (select speaker_id from bench) then 'justice' else 'other' end as role from seen group by 1", "seen"))
def speaker_role(spark: SparkSession, d: str) -> DataFrame:
    """Role of every speaker by cases and terms, kept where it was known before."""
    return S.roles(_seen(spark, d), table(spark, d, "bench"), cases=4, terms=2)


@query(sql("select speaker_id, min(nullif(t.title_date, '')) as first_appearance, max(nullif(t.title_date, '')) as last_appearance from seen s join tr t on t.id = s.transcript_id group by 1", "seen"))
def speaker_first_last(spark: SparkSession, d: str) -> DataFrame:
    """First and last dated appearance of every speaker."""
    dates = _transcripts(spark, d, "title_date").select(F.col("id").alias("transcript_id"), "title_date")
    return S.first_and_last(_seen(spark, d).join(dates, "transcript_id"), "title_date")


@query(sql("select speaker_id, count(*) as recordings, cast(sum(turns) as bigint) as turns, cast(sum(word_count) as bigint) as word_count, min(term) as first_appearance, max(term) as last_appearance "
           "from seen where cast(term as integer) between 1998 and 2005 group by 1", "seen"))
def speaker_term_subset(spark: SparkSession, d: str) -> DataFrame:
    """Speakers aggregated anew over the terms 1998 to 2005."""
    return S.of_terms(S.profiles(_seen(spark, d)), parse_terms("98-05")).select("speaker_id", "recordings", "turns", "word_count", "first_appearance", "last_appearance")


@query(sql("select speaker_id, string_agg(term || ':' || r, ',' order by term) as terms from (select speaker_id, term, count(*) as r from seen group by 1, 2) group by 1", "seen"))
def speakers_by_term_list(spark: SparkSession, d: str) -> DataFrame:
    """Terms of every speaker as an ordered list."""
    rows = S.term_rows(S.profiles(_seen(spark, d)))
    return rows.select("speaker_id", F.array_join(F.transform("by_term", lambda t: F.concat(t["term"], F.lit(":"), t["recordings"].cast("string"))), ",").alias("terms"))


@query(sql("select case when b.speaker_id is not null then 'justice' else 'other' end as role, round(sum(duration_seconds), 3) as seconds, "
           "round(sum(duration_seconds) / sum(sum(duration_seconds)) over (), 6) as share from seen left join bench b using (speaker_id) group by 1", "seen"))
def role_hours_share(spark: SparkSession, d: str) -> DataFrame:
    """Time spoken by the bench and by others."""
    flagged = L.flag_members(_seen(spark, d), table(spark, d, "bench"), "speaker_id", "is_justice")
    return S.hours_by_role(flagged.withColumn("role", F.when(F.col("is_justice"), "justice").otherwise("other")), digits=3)


_BUCKETS = ("case when recordings = 1 then '1' when recordings = 2 then '2' when recordings <= 5 then '3-5' when recordings <= 10 then '6-10' else '11+' end",
            "case when s < 60 then '<1m' when s < 300 then '1-5m' when s < 900 then '5-15m' when s < 1800 then '15-30m' when s < 3600 then '30-60m' when s < 7200 then '1-2h' when s < 18000 then '2-5h' "
            "when s < 36000 then '5-10h' when s < 180000 then '10-50h' when s < 360000 then '50-100h' else '100h+' end")


@query(sql(f", tt as (select speaker_id, count(*) as recordings, sum(duration_seconds) as s from seen group by 1) select 'recordings' as kind, {_BUCKETS[0]} as bucket, count(*) as n from tt group by 1, 2 "
           f"union all select 'time', {_BUCKETS[1]}, count(*) from tt group by 1, 2", "seen").replace(") , tt", "), tt"))
def speaker_histograms(spark: SparkSession, d: str) -> DataFrame:
    """Speakers by number of recordings and by time spoken."""
    return S.histograms(S.totals(_seen(spark, d), digits=3))


@query(sql("select speaker_id, turns, cast(row_number() over (order by turns desc, speaker_id) as integer) as rank from (select speaker_id, cast(sum(turns) as bigint) as turns from seen group by 1) qualify rank <= 20", "seen"))
def top_speakers_by_turns(spark: SparkSession, d: str) -> DataFrame:
    """The twenty speakers with most turns."""
    return L.rank_rows(S.totals(_seen(spark, d)).select("speaker_id", "turns"), "turns", "speaker_id", 20)


@query(sql("select transcript_id, speakers, cast(row_number() over (order by speakers desc, transcript_id) as integer) as rank from (select transcript_id, count(distinct speaker_id) as speakers from cur group by 1) qualify rank <= 20", "cur"))
def top_recordings_by_speakers(spark: SparkSession, d: str) -> DataFrame:
    """The twenty recordings with most speakers."""
    n = _turns(spark, d, "speaker_id").groupBy("transcript_id").agg(F.count_distinct("speaker_id").alias("speakers"))
    return L.rank_rows(n, "speakers", "transcript_id", 20)


@query(sql("select is_justice, speaker_id, recordings, cast(row_number() over (partition by is_justice order by recordings desc, speaker_id) as integer) as rank from "
           "(select speaker_id, count(*) as recordings, speaker_id in (select speaker_id from bench) as is_justice from seen group by 1) qualify rank <= 10", "seen"))
def topk_per_role(spark: SparkSession, d: str) -> DataFrame:
    """The ten speakers with most recordings on the bench and off it."""
    t = L.flag_members(S.totals(_seen(spark, d)).select("speaker_id", "recordings"), table(spark, d, "bench"), "speaker_id", "is_justice")
    return S.top_of_each(t, "is_justice", "recordings", 10, "speaker_id").select("is_justice", "speaker_id", "recordings", "rank")


@query(sql("select speaker_id, name_slug, trim(both '_' from regexp_replace(regexp_replace(lower(trim(name)), '[^\\w\\s]', '', 'g'), '\\s+', '_', 'g')) as slug from (select distinct speaker_id, name, name_slug from speakers where name is not null)"))
def slugify(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of speakers' names, beside those delivered."""
    return table(spark, d, "speakers").select("speaker_id", "name", "name_slug").where("name is not null").distinct().select("speaker_id", "name_slug", ids.slug(F.col("name")).alias("slug"))


@query(sql("select transcript_id, turn_index, speaker_id in (select speaker_id from bench) as is_justice from cur where speaker_id is not null", "cur"))
def justice_flag(spark: SparkSession, d: str) -> DataFrame:
    """Whether each turn's speaker sits on the bench."""
    t = _turns(spark, d, "speaker_id").where("speaker_id is not null")
    return L.flag_members(t, table(spark, d, "bench"), "speaker_id", "is_justice").select("transcript_id", "turn_index", "is_justice")


# --- transcripts, cases, recordings ---------------------------------------------------------------------------------
@query(sql("select t.id, m.term, m.docket from tr t join cmap m on m.audio_id = t.id", "tr", "cmap"))
def case_map_inner_join(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with the case that names their recording."""
    return L.link_transcripts(_transcripts(spark, d), _cases(spark, d, "term", "docket_number", "oral_arguments", "opinion_announcements"))


@query(sql("select id from tr where id not in (select audio_id from cmap)", "tr", "cmap"))
def unmatched_transcripts_anti(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts that no case names."""
    return L.unlinked_transcripts(_transcripts(spark, d), _cases(spark, d, "term", "docket_number", "oral_arguments", "opinion_announcements"))


@query(sql("select t.term, t.case_docket as docket, t.id, coalesce(c.name, 'Unknown Case') as case_name from tr t left join (select term, docket_number, max(name) as name from ca where docket_number is not null group by 1, 2) c "
           "on c.term = t.term and c.docket_number = t.case_docket", "tr", "ca"))
def case_name_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Names of the transcripts' cases, as their dockets are written."""
    t = _transcripts(spark, d, "term", "case_docket").withColumnRenamed("case_docket", "docket")
    return L.with_case_names(t, _cases(spark, d, "term", "docket_number", "name"))


@query(sql("select count(*) as cases, count(*) filter (where len(oral_arguments) > 0) as with_arguments, count(*) filter (where len(opinion_announcements) > 0) as with_opinions, min(term) as first_term, max(term) as last_term from ca", "ca"))
def case_stats(spark: SparkSession, d: str) -> DataFrame:
    """Number of cases, those with arguments and opinions, range of terms."""
    some = lambda c: F.count_if(F.coalesce(F.size(c) > 0, F.lit(False)))
    return _cases(spark, d, "term", "oral_arguments", "opinion_announcements").agg(
        F.count(F.lit(1)).alias("cases"), some("oral_arguments").alias("with_arguments"), some("opinion_announcements").alias("with_opinions"), F.min("term").alias("first_term"), F.max("term").alias("last_term"))


@query(sql("select term, count(*) as cases from ca group by 1 order by term desc limit 5", "ca"))
def recent_terms_top5(spark: SparkSession, d: str) -> DataFrame:
    """Cases of the five latest terms."""
    return _cases(spark, d, "term").groupBy("term").agg(F.count(F.lit(1)).alias("cases")).orderBy(F.desc("term")).limit(5)


@query(sql("select transcript_type, count(distinct t.id) as transcripts, count(v.turn_index) as turns, count(v.turn_index) filter (where v.problem is null) as valid_turns, cast(coalesce(sum(v.word_count), 0) as bigint) as words "
           "from tr t left join valid v on v.transcript_id = t.id group by 1", "tr", "valid"))
def transcript_stats(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts, turns, valid turns and words by type."""
    per = _judged(spark, d).groupBy("transcript_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("v"), F.sum("word_count").alias("w"))
    t = _transcripts(spark, d, "transcript_type").withColumnRenamed("id", "transcript_id")
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return t.join(per, "transcript_id", "left").groupBy("transcript_type").agg(F.count(F.lit(1)).alias("transcripts"), z("n").alias("turns"), z("v").alias("valid_turns"), z("w").alias("words"))


@query(sql("select case when n = 1 then '1' when n = 2 then '2' when n <= 5 then '3-5' when n <= 10 then '6-10' else '11+' end as bucket, count(*) as recordings from (select transcript_id, count(distinct speaker_id) as n from cur group by 1) group by 1", "cur"))
def speakers_per_recording_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Recordings by number of speakers."""
    n = _turns(spark, d, "speaker_id").groupBy("transcript_id").agg(F.count_distinct("speaker_id").alias("n"))
    return n.groupBy(M.recordings_bucket(F.col("n")).alias("bucket")).agg(F.count(F.lit(1)).alias("recordings"))


@query(sql("select id, term from tr where term in ('1998', '1999', '2000', '2022')", "tr"))
def term_filter(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts of the terms 98-00 and 22."""
    return _transcripts(spark, d, "term").where(F.col("term").isin(parse_terms("98-00,22")))


@query(sql("select id, term, case_docket, transcript_type from tr qualify row_number() over (partition by lower(coalesce(term, '')), lower(coalesce(case_docket, '')), lower(coalesce(transcript_type, '')), lower(coalesce(speaker, '')) order by id) = 1", "tr"))
def dedupe_output_key(spark: SparkSession, d: str) -> DataFrame:
    """One transcript per term, docket, type and speaker."""
    t = _transcripts(spark, d, "term", "case_docket", "transcript_type", "speaker")
    return T.one_per_output(t, ["term", "case_docket", "transcript_type", "speaker"], "id").drop("speaker")


@query(sql("select id, case when title like 'Oral Argument%' then 'oral_argument' when regexp_matches(title, '^Dissenting Opinion - \\w+ - ') then 'dissent' when regexp_matches(title, '^Concurring Opinion - \\w+ - ') then 'concurrence' "
           "when title like 'Opinion Announcement%' then 'opinion' when title is not null then 'unknown' end as type, "
           "nullif(regexp_extract(title, '^(Dissenting|Concurring) Opinion - (\\w+) - ', 2), '') as speaker from tr", "tr"))
def transcript_title(spark: SparkSession, d: str) -> DataFrame:
    """Type and speaker that titles of transcripts tell."""
    return _transcripts(spark, d, "title").select("id", ids.transcript_title(F.col("title")).alias("x")).select("id", "x.type", "x.speaker")


@query(sql("select ca.id, a.x.id as audio_id, case when regexp_matches(a.x.title, '^Dissenting Opinion - \\w+ - ') then 'dissent' when regexp_matches(a.x.title, '^Concurring Opinion - \\w+ - ') then 'concurrence' "
           "when regexp_matches(a.x.title, '\\(Dissent by \\w+\\)') then 'dissent' when a.x.title is not null then 'majority' end as type, "
           "coalesce(nullif(regexp_extract(a.x.title, '^(Dissenting|Concurring) Opinion - (\\w+) - ', 2), ''), nullif(regexp_extract(a.x.title, '\\(Dissent by (\\w+)\\)', 1), '')) as speaker "
           "from ca, lateral (select unnest(opinion_announcements) as x) a where a.x is not null", "ca"))
def opinion_title(spark: SparkSession, d: str) -> DataFrame:
    """Type and speaker that titles of opinions tell."""
    o = _cases(spark, d, "opinion_announcements").select("id", F.explode("opinion_announcements").alias("o")).where("o is not null")
    return o.select("id", F.col("o.id").alias("audio_id"), ids.opinion_title(F.col("o.title")).alias("x")).select("id", "audio_id", "x.type", "x.speaker")


_MON = "list_position(['january','february','march','april','may','june','july','august','september','october','november','december'], lower(regexp_extract(title, '[-,] ([A-Za-z]+) (\\d{1,2}), (\\d{4})(\\s|$|[(\\s])', 1)))"
_U = "split_part(split_part(metadata.audio_urls['mp3'], '/', -1), '.', 1)"


@query(sql(
    f", x as (select id, regexp_extract(title, '[-,] ([A-Za-z]+) (\\d{{1,2}}), (\\d{{4}})(\\s|$|[(\\s])', ['m','d','y','z']) as p, {_MON} as m, "
    f"coalesce(nullif(regexp_extract({_U}, '^(\\d{{8}})[a-z]_', 1), ''), nullif(regexp_extract({_U}, '_(\\d{{8}})-', 1), '')) as u from tr), "
    "y as (select id, case when m > 0 and cast(nullif(p.d, '') as int) between 1 and 31 and cast(nullif(p.y, '') as int) >= 1900 then printf('%d-%02d-%02d', cast(p.y as int), m, cast(p.d as int)) end as title_date, "
    "case when cast(u[5:6] as int) between 1 and 12 and cast(u[7:8] as int) between 1 and 31 then printf('%d-%02d-%02d', cast(u[1:4] as int), cast(u[5:6] as int), cast(u[7:8] as int)) end as url_date from x) "
    "select id, title_date, url_date, coalesce(title_date <> url_date, false) as date_mismatch from y", "tr").replace(") , x", "), x"))
def date_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Dates in titles and addresses of transcripts, and whether they differ."""
    t = T.enrich_dates(_transcripts(spark, d, "title", "metadata"))
    return t.select("id", "title_date", "url_date", "date_mismatch")


@query(sql(
    f", u as (select id, {_U} as r from tr) select id, nullif(r, '') as recording_id, case when r like '%-opinion-dissent%' then 'dissent' when r like '%-opinion-concur%' then 'concurrence' when r like '%-opinion%' then 'opinion' "
    "when r like '%-argument%' then 'oral_argument' when regexp_matches(r, '^\\d{8}[ar]_') then 'oral_argument' when regexp_matches(r, '^\\d{8}o_') then 'opinion' when nullif(r, '') is not null then 'unknown' end as type from u", "tr").replace(") , u", "), u"))
def recording_id_type(spark: SparkSession, d: str) -> DataFrame:
    """Recording ids of transcripts and the type they tell."""
    r = _transcripts(spark, d, "metadata").select("id", ids.recording_id_of_url(F.col("metadata.audio_urls")["mp3"]).alias("recording_id"))
    return r.withColumn("type", ids.recording_type(F.col("recording_id")))


@query(sql("select id, case when try_cast(term as int) >= 2006 then 'digital' when try_cast(term as int) < 2006 then 'analog' else 'unknown' end as era, case when try_cast(term as int) < 2006 then 'ogg,mp3' else 'mp3,ogg' end as formats from tr", "tr"))
def era_and_format(spark: SparkSession, d: str) -> DataFrame:
    """Era and order of formats of every transcript's recording."""
    return _transcripts(spark, d, "term").select("id", ids.era(F.col("term")).alias("era"), F.array_join(ids.format_order(F.col("term")), ",").alias("formats"))


_FILES = "select tr.id, tr.term, case when try_cast(tr.term as int) >= 2006 then 'digital' else 'analog' end as era, e.k as format, e.v as url from tr, lateral (select unnest(map_keys(metadata.audio_urls)) as k, unnest(map_values(metadata.audio_urls)) as v) e"


def _files(spark: SparkSession, d: str) -> DataFrame:
    return _transcripts(spark, d, "term", "metadata").select("id", "term", ids.era(F.col("term")).alias("era"), F.explode("metadata.audio_urls").alias("format", "url"))


@query(sql(f", f as ({_FILES}) select era, format, term, count(*) as n from f group by grouping sets ((era), (format), (term), ())", "tr").replace(") , f", "), f"))
def audio_stats_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """Audio files by era, by format, by term and in all, over one scan."""
    return _files(spark, d).groupingSets([["era"], ["format"], ["term"], []], "era", "format", "term").agg(F.count(F.lit(1)).alias("n"))


@query(sql(f", f as ({_FILES}) select distinct url from f where url <> ''", "tr").replace(") , f", "), f"))
def audio_urls_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses of audio."""
    return L.distinct_audio_urls(_transcripts(spark, d, "metadata"))


@query(sql("select distinct x.href as href from (select unnest(list_concat(coalesce(oral_arguments, []), coalesce(opinion_announcements, []))) as x from ca) where x is not null and coalesce(x.href, '') <> '' and not coalesce(x.unavailable, false)", "ca"))
def case_hrefs_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct addresses of available recordings in cases."""
    return L.distinct_hrefs(_cases(spark, d, "oral_arguments", "opinion_announcements"))


@query(sql(f", f as (select *, regexp_replace(regexp_replace(split_part(url, '/', -1), '\\.[^.]*$', ''), '\\.delivery$', '') as recording_id from ({_FILES})) select recording_id, min(url) filter (where url like '%.mp3') as mp3, "
           "min(url) filter (where url like '%.ogg') as ogg, coalesce(min(url) filter (where url like '%.mp3'), min(url) filter (where url like '%.ogg')) as path from f group by 1 having coalesce(mp3, ogg) is not null", "tr").replace(") , f", "), f"))
def mp3_ogg_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """Both formats of every recording side by side."""
    return L.pair_formats(_files(spark, d).select(F.col("url").alias("path")))


@query(sql(
    f", f as ({_FILES.replace('select tr.id, tr.term', 'select tr.id, tr.case_docket, tr.term')}), g as (select split_part(split_part(url, '/', -1), '.', 1) as recording_id, term, case_docket as docket, url as path from f where format = 'mp3'), "
    "m as (select split_part(split_part(url, '/', -1), '.', 1) as recording_id, max(f.id) as transcript_id from f where url <> '' group by 1), c as (select term, docket_number as docket, max(name) as case_name from ca group by 1, 2) "
    "select g.recording_id, g.term, g.docket, g.path, m.transcript_id, tr.title, c.case_name from g left join m using (recording_id) left join tr on tr.id = m.transcript_id left join c on c.term = g.term and c.docket = g.docket", "tr", "ca").replace(") , f", "), f"))
def raw_items_two_left_joins(spark: SparkSession, d: str) -> DataFrame:
    """Recordings with their transcript and case."""
    t = _transcripts(spark, d, "term", "case_docket", "title", "metadata.audio_urls")
    files = t.where("audio_urls['mp3'] is not null").select(ids.recording_id_of_url(F.col("audio_urls")["mp3"]).alias("recording_id"), "term", F.col("case_docket").alias("docket"), F.col("audio_urls")["mp3"].alias("path"))
    media = t.select("id", "title", F.transform(F.map_values("audio_urls"), lambda u: F.struct(u.alias("href"))).alias("media_file"))
    return L.raw_items(files, media, _cases(spark, d, "term", "docket_number", "name"))


@query(sql("select id, term, case_docket from tr where exists (select 1 from cur where cur.transcript_id = tr.id)", "tr", "cur"))
def semi_join_has_recording(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with flat turns."""
    return L.with_recording(_transcripts(spark, d, "term", "case_docket"), _turns(spark, d).select(F.col("transcript_id").alias("id")), ["id"])


@query(sql("select id, term, case_docket from tr where not exists (select 1 from cur where cur.transcript_id = tr.id)", "tr", "cur"))
def anti_join_missing(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts without flat turns."""
    return L.with_recording(_transcripts(spark, d, "term", "case_docket"), _turns(spark, d).select(F.col("transcript_id").alias("id")), ["id"], missing=True)


@query(sql("select t.id, t.term, f.first_turn, f.text from tr t join (select transcript_id, min(turn_index) as first_turn, arg_min(text, turn_index) as text from cur where text is not null group by 1) f on f.transcript_id = t.id", "tr", "cur"))
def first_match_join(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with their first turn that has a text."""
    first = _turns(spark, d, "text").where("text is not null").select(F.col("transcript_id").alias("id"), F.col("turn_index").alias("first_turn"), "text")
    return L.first_recording(_transcripts(spark, d, "term"), first.withColumn("_o", F.col("first_turn")), ["id"], "_o").drop("_o")


@query(sql("select transcript_id, coalesce(array_to_string(list_sort(list(distinct speaker_id) filter (where b)), ','), '') as justices, coalesce(array_to_string(list_sort(list(distinct speaker_id) filter (where not b)), ','), '') as others, "
           "count(distinct speaker_id) as total_speakers from (select transcript_id, speaker_id, speaker_id in (select speaker_id from bench) as b from cur where speaker_id is not null) group by 1", "cur"))
def recording_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Bench and other speakers of every recording."""
    t = L.flag_members(_turns(spark, d, "speaker_id").where("speaker_id is not null"), table(spark, d, "bench"), "speaker_id", "is_justice")
    r = L.speakers_of_recording(t, ["transcript_id"])
    return r.select("transcript_id", F.array_join("justice_speakers", ",").alias("justices"), F.array_join("other_speakers", ",").alias("others"), "total_speakers")


@query(sql("select ca.id, t.pos - 1 as position, t.x.event as event, t.x.date as date from ca, lateral (select unnest(timeline) as x, generate_subscripts(timeline, 1) as pos) t where t.x is not null", "ca"))
def timeline_explode(spark: SparkSession, d: str) -> DataFrame:
    """Events of cases, one per row."""
    t = _cases(spark, d, "timeline").select("id", F.posexplode("timeline").alias("position", "t")).where("t is not null")
    return t.select("id", F.col("position").cast("long").alias("position"), "t.event", "t.date")


# --- fetched documents ----------------------------------------------------------------------------------------------
_HASHED = "select url, fetched_at, lower(list_extract(list_reverse_sort([{'s': v.last_seen, 'h': v.content_hash} for v in coalesce(versions, []) if v is not null]), 1).h) as h from cache_snapshots"


def _fetches(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "cache_snapshots").select("url", "fetched_at", "versions")
    last = F.array_max(F.transform(F.filter(F.coalesce("versions", F.array()), lambda v: v.isNotNull()), lambda v: F.struct(v["last_seen"].alias("s"), v["content_hash"].alias("h"))))
    return s.select("url", "fetched_at", F.lower(last["h"]).alias("h"))


@query(sql(f"select url, h, min(fetched_at) as first_seen, max(fetched_at) as last_seen, count(*) as times from ({_HASHED}) where h is not null and url is not null group by 1, 2"))
def version_history(spark: SparkSession, d: str) -> DataFrame:
    """Contents of every url with first and last sight."""
    return V.version_history(_fetches(spark, d), "url", "h", "fetched_at")


@query(sql(f"select url, fetched_at as at, o as old_hash, h as new_hash from (select *, lag(h) over (partition by url order by fetched_at, h) as o from ({_HASHED}) where h is not null and url is not null) where o <> h"))
def change_log(spark: SparkSession, d: str) -> DataFrame:
    """When a url's content became another."""
    return V.change_log(_fetches(spark, d), "url", "h", "fetched_at")


@query(sql(f"select url, h, first_seen, last_seen, times from (select url, h, min(fetched_at) as first_seen, max(fetched_at) as last_seen, count(*) as times from ({_HASHED}) where h is not null and url is not null group by 1, 2) "
           "qualify row_number() over (partition by url order by last_seen desc, first_seen, h desc) = 1"))
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    """The content last seen of every url."""
    return V.latest_version(version_history(spark, d), "url")


@query(sql("select distinct url, sha256('GET:' || url)[1:16] as request_key, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') as host from cache_snapshots"))
def request_key(spark: SparkSession, d: str) -> DataFrame:
    """Cache keys and hosts of all urls."""
    return table(spark, d, "cache_snapshots").select("url").distinct().select("url", ids.request_key(F.lit("GET"), F.col("url")).alias("request_key"), ids.url_host(F.col("url")).alias("host"))


@query(sql("select distinct record_id, sha256(payload)[1:16] as content_hash from raw_records where payload is not null"))
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of raw documents."""
    return table(spark, d, "raw_records").where("payload is not null").select("record_id", ids.content_hash(F.encode("payload", "UTF-8")).alias("content_hash")).distinct()


@query(sql("select content_type, case when lower(content_type) like '%json%' then '.json' when lower(content_type) like '%html%' then '.html' when lower(content_type) like '%xml%' then '.xml' when lower(content_type) like 'text/plain%' then '.txt' "
           "when lower(content_type) like 'audio/mpeg%' then '.mp3' else '.bin' end as extension, count(*) as n from cache_snapshots group by 1, 2"))
def content_extensions(spark: SparkSession, d: str) -> DataFrame:
    """File extensions of content types."""
    return table(spark, d, "cache_snapshots").groupBy("content_type", ids.extension(F.col("content_type")).alias("extension")).agg(F.count(F.lit(1)).alias("n"))


@query(sql("select snapshot_no, url, fetched_at from cache_snapshots where timestamp '2025-06-01 00:00:00' > expires_at"))
def expired_entries(spark: SparkSession, d: str) -> DataFrame:
    """Cache entries that had expired on 1 June 2025."""
    return V.expired(table(spark, d, "cache_snapshots"), "2025-06-01 00:00:00").select("snapshot_no", "url", "fetched_at")


@query(sql("select case when status_code between 200 and 299 then 'new' when status_code in (403, 404) then 'skipped' when status_code is null or status_code in (429, 502, 503, 504) then 'transient' else 'failed' end as class, count(*) as n from cache_snapshots group by 1"))
def fetch_classes(spark: SparkSession, d: str) -> DataFrame:
    """Fetches by how they went."""
    c = ids.fetch_class(F.col("status_code"), F.lit(None).cast("string"), F.lit(False))
    return table(spark, d, "cache_snapshots").groupBy(c.alias("class")).agg(F.count(F.lit(1)).alias("n"))


# --- text and audio -------------------------------------------------------------------------------------------------
@query()
def artifact_counts(spark: SparkSession, d: str) -> DataFrame:
    """Written forms in all turns by category and token."""
    return A.artifact_counts(_turns(spark, d, "text"), "text")


_RE2 = [("years", r"\b(19\d{2}|20\d{2})\b", 1), ("ordinals", r"(?i)\b(\d+)(st|nd|rd|th)\b", 0), ("historical_years", r"\b(1[0-8]\d{2})\b", 1), ("decades", r"\b(19|20)\d{2}s\b", 0),
        ("no_dot_citation", r"(?i)\bNo\.\s+(\d+-\d+)", 0), ("dash_range", "\\d+[–—-]\\d+", 0), ("structural_bracket", r"\(([a-zA-Z])\)", 0), ("ordinals_word",
         r"(?i)\b(First|Second|Third|Fourth|Fifth|Sixth|Seventh|Eighth|Ninth|Tenth|Eleventh|Twelfth)\b", 1)]


@query(sql("select category, trim(replace(token, '  ', ' ')) as token, count(*) as n from (" + " union all ".join(
    f"select '{c}' as category, unnest(regexp_extract_all(text, '{p}', {g})) as token from cur" for c, p, g in _RE2) + ") group by 1, 2", "cur"))
def artifact_counts_checked(spark: SparkSession, d: str) -> DataFrame:
    """The categories of written forms that SQL can express too, without those that share a category."""
    return artifact_counts(spark, d).where(F.col("category").isin([c for c, _, _ in _RE2])).where("category <> 'structural_bracket' or token rlike '[a-zA-Z]'")


@query()
def rules_needing_examples(spark: SparkSession, d: str) -> DataFrame:
    """Rules with fewer than 500 examples in all turns, with places."""
    t = _turns(spark, d, "text").withColumn("path", F.concat_ws("/", "transcript_id", "turn_index"))
    places = durable(A.artifacts_by_place(t, "text", "path"))
    return A.rules_wanting_examples(places, places, 500).withColumn("examples", F.array_join("examples", ","))


@query(sql(
    "select vec_id, len(f) as frames, round(list_sum(f) / len(f), 6) as mean_rms, round(sqrt(list_sum([(x - list_sum(f) / len(f)) * (x - list_sum(f) / len(f)) for x in f]) / len(f)) / (list_sum(f) / len(f)), 6) as energy_cv from "
    "(select vec_id, [sqrt(list_sum([cast(y as double) * y for y in embedding[i * 8 + 1 : i * 8 + 8]]) / 8) for i in range(len(embedding) // 8)] as f from embeddings)"))
def frame_energy_cv(spark: SparkSession, d: str) -> DataFrame:
    """Energy of frames of eight samples and its variation."""
    e = table(spark, d, "embeddings").select("vec_id", M.frame_energies(F.col("embedding"), 8).alias("f"))
    return e.select("vec_id", F.size("f").cast("long").alias("frames"), F.round(M.mean_of(F.col("f")), 6).alias("mean_rms"), F.round(M.variation(F.col("f")), 6).alias("energy_cv"))


@query(sql(
    "select vec_id, case when len(embedding) is null or len(embedding) = 0 or sqrt(list_sum([cast(y as double) * y for y in embedding]) / len(embedding)) < 1e-6 then 'silent' "
    "when case when m < 1e-6 then 0 else sqrt(list_sum([(x - m) * (x - m) for x in f]) / len(f)) / m end < 0.25 then 'constant_noise' end as problem from (select *, list_sum(f) / len(f) as m from "
    "(select vec_id, embedding, [sqrt(list_sum([cast(y as double) * y for y in embedding[i * 8 + 1 : i * 8 + 8]]) / 8) for i in range(len(embedding) // 8)] as f from embeddings))"))
def audio_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Signals that are silent or of constant noise."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding", M.frame_energies(F.col("embedding"), 8).alias("f"))
    return e.select("vec_id", M.audio_problem(F.col("embedding"), F.col("f")).alias("problem"))


@query(sql("select vec_id, len(embedding[3:10]) as n, round(list_sum([cast(x as double) for x in embedding[3:10]]), 6) as total from embeddings"))
def segment_slice(spark: SparkSession, d: str) -> DataFrame:
    """Samples from 0.25 to 1.25 seconds at eight a second."""
    s = M.segment(F.col("embedding"), F.lit(8), F.lit(0.25), F.lit(1.25))
    return table(spark, d, "embeddings").select("vec_id", s.alias("s")).select(
        "vec_id", F.size("s").cast("long").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"))


@query(sql("select transcript_id, case when b is null then null when b < 1024 then printf('%.1f B', b) when b < 1024 * 1024 then printf('%.1f KB', b / 1024.0) else printf('%.1f MB', b / 1048576.0) end as size, "
           "format('{:,.1f}', s / 3600.0) as hours, cast(floor(floor(s) / 3600) as bigint) || 'h ' || cast(floor(floor(s) % 3600 / 60) as bigint) || 'm ' || (cast(floor(s) as bigint) % 60) || 's' as hms "
           "from (select transcript_id, sum(duration) as s, cast(sum(char_count) as double) as b from cur group by 1)", "cur"))
def hours_and_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and times as people read them."""
    t = _turns(spark, d, "duration", "char_count").groupBy("transcript_id").agg(F.sum("duration").alias("s"), F.sum("char_count").alias("b"))
    return t.select("transcript_id", M.human_size(F.col("b")).alias("size"), M.hours(F.col("s")).alias("hours"), M.hms(F.col("s")).alias("hms"))


@query("select unnest(['1998', '1999', '2000', '2001', '2022']) as term")
def term_range_expand(spark: SparkSession, d: str) -> DataFrame:
    """Terms of a list with ranges."""
    return spark.createDataFrame([(t,) for t in parse_terms("98-01,22, 1999")], "term string")


@query("select event_type, time_bucket(interval '1 hour', ts) as window_start, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hour."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(
        "event_type", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")


@query(ORACLES["event_windows"])
def stream_event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hour, read as a stream of files to its end."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    name = f"stream_{uuid.uuid4().hex}"
    out = run_once(windowed_counts(stream, "ts", "event_type", "value", "1 hour", "10 minutes"), name, f"{shared_dir(spark)}/{name}", "complete")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))


@query()
def spoken_turns(spark: SparkSession, d: str) -> DataFrame:
    """Turns as they are spoken, with the number of written forms in them."""
    return normalize(_turns(spark, d, "text"), ["transcript_id", "turn_index"], "text").select("transcript_id", "turn_index", "spoken", F.size("forms").alias("forms"))


@query(sql("select tr.term, count(*) as utterances, count(*) filter (where v.problem is null) as valid, cast(coalesce(sum(v.word_count), 0) as bigint) as words from valid v join tr on tr.id = v.transcript_id group by 1", "tr", "valid"))
def flex_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Utterances written as a tier and read back, by term."""
    t = _transcripts(spark, d, "term", "case_docket", "transcript_type").withColumnsRenamed({"id": "transcript_id", "case_docket": "docket"})
    judged = L.flag_members(_judged(spark, d), table(spark, d, "bench"), "speaker_id", "is_justice").join(t, "transcript_id")
    rows = judged.select("term", "docket", "transcript_type", "turn_index", F.col("start").alias("start_sec"), F.col("stop").alias("end_sec"), F.col("duration").alias("duration_sec"), "speaker_id", "speaker_name",
                         "is_justice", "text", "word_count", F.col("is_valid").alias("valid"), F.col("problem").alias("invalid_reason"))
    root = f"{shared_dir(spark)}/flex-{uuid.uuid4().hex}"
    write_tier(spark, root, {"utterances": rows})
    back = load_flex(spark, root)[1]
    return back.groupBy("term").agg(F.count(F.lit(1)).alias("utterances"), F.count_if("valid").alias("valid"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"))


@query()
def raw_document_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sections, turns and text blocks of raw documents in any form, with their times and texts."""
    raw = current_rows(table(spark, d, "raw_records").select("record_id", "payload", "fetched_at"), ["record_id"], "fetched_at", [F.col("payload")])
    flat = emit_raw(raw)
    v = F.from_json("payload", "start double, stop double, text string, mime string")
    return flat.select("child", v.alias("v")).groupBy("child").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v.stop") <= F.col("v.start")).alias("without_length"), F.round(F.sum(F.col("v.stop") - F.col("v.start")), 3).alias("seconds"),
        F.sum(M.word_count(F.col("v.text"))).alias("words"), F.count_distinct("v.mime").alias("kinds"))
