"""Joins between cases, transcripts and recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import ids


def audio_references(cases: DataFrame) -> DataFrame:
    """(audio_id, term, docket, position): recordings that cases name, arguments before opinions; null elements and ids are passed over."""
    both = F.concat(F.coalesce("oral_arguments", F.array()), F.coalesce("opinion_announcements", F.array()))
    return cases.select("id", "term", "docket_number", F.posexplode(both).alias("position", "a")).where("a.id is not null").select(
        F.col("a.id").alias("audio_id"), "term", F.col("docket_number").alias("docket"), "position", F.col("id").alias("case_id"))


def case_of_recording(cases: DataFrame) -> DataFrame:
    """One (term, docket) per recording; where several cases name one, the last in order of case and position counts."""
    refs = audio_references(cases)
    return refs.groupBy("audio_id").agg(F.max_by(F.struct("term", "docket"), F.struct("case_id", "position")).alias("c")).select("audio_id", "c.term", "c.docket")


def link_transcripts(transcripts: DataFrame, cases: DataFrame, id_column: str = "id") -> DataFrame:
    """Transcripts whose recording a case names, with ``term`` and ``docket`` of that case."""
    return transcripts.join(case_of_recording(cases).withColumnRenamed("audio_id", id_column), id_column)


def unlinked_transcripts(transcripts: DataFrame, cases: DataFrame, id_column: str = "id") -> DataFrame:
    """Transcripts that no case names."""
    return transcripts.join(case_of_recording(cases).withColumnRenamed("audio_id", id_column), id_column, "left_anti")


def with_case_names(rows: DataFrame, cases: DataFrame) -> DataFrame:
    """``case_name`` by term and docket, 'Unknown Case' where there is none."""
    names = cases.where("docket_number is not null").groupBy("term", F.col("docket_number").alias("docket")).agg(F.max("name").alias("case_name"))
    return rows.join(names, ["term", "docket"], "left").withColumn("case_name", F.coalesce("case_name", F.lit("Unknown Case")))


def flag_members(rows: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """A boolean whether the key is among ``members``."""
    known = members.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_m", F.lit(True))
    return rows.join(known, key, "left").withColumn(flag, F.coalesce("_m", F.lit(False))).drop("_m")


def with_recording(rows: DataFrame, recordings: DataFrame, keys: list[str], missing: bool = False) -> DataFrame:
    """Rows that have a recording, or with ``missing`` those that have none."""
    return rows.join(recordings.select(*keys).distinct(), keys, "left_anti" if missing else "left_semi")


def first_recording(rows: DataFrame, recordings: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows with the first recording of their keys."""
    rest = [c for c in recordings.columns if c not in keys]
    first = recordings.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_f")).select(*keys, "_f.*")
    return rows.join(first, keys)


def pair_formats(files: DataFrame) -> DataFrame:
    """(recording_id, mp3, ogg, path): files of either format by recording, the mp3 preferred; the smallest path of each counts."""
    f = files.withColumn("recording_id", ids.recording_id_of_path(F.col("path"))).withColumn("format", F.lower(F.element_at(F.split("path", r"\."), -1)))
    return (f.groupBy("recording_id").agg(F.min(F.when(F.col("format") == "mp3", F.col("path"))).alias("mp3"), F.min(F.when(F.col("format") == "ogg", F.col("path"))).alias("ogg"))
            .withColumn("path", F.coalesce("mp3", "ogg")).where("path is not null"))


def speakers_of_recording(turns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, justice_speakers, other_speakers, total_speakers): sorted distinct speakers of each recording."""
    who = turns.where("speaker_id is not null").select(*keys, "speaker_id", "is_justice").distinct()
    return who.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("is_justice"), F.col("speaker_id")))).alias("justice_speakers"),
        F.array_sort(F.collect_list(F.when(~F.col("is_justice"), F.col("speaker_id")))).alias("other_speakers"), F.count(F.lit(1)).alias("total_speakers"))


def raw_items(files: DataFrame, transcripts: DataFrame, cases: DataFrame) -> DataFrame:
    """Recordings with the transcript and the case that belong to them, nulls where there are none.

    files: recording_id, term, docket, path; transcripts: id, title, media (array of struct of href); cases: term, docket_number, name.
    """
    media = transcripts.select("id", "title", F.explode_outer("media_file").alias("m")).where("m.href <> ''").select(
        ids.recording_id_of_url(F.col("m.href")).alias("recording_id"), F.col("id").alias("transcript_id"), "title")
    media = media.groupBy("recording_id").agg(F.max(F.struct("transcript_id", "title")).alias("t")).select("recording_id", "t.transcript_id", "t.title")
    return files.join(media, "recording_id", "left").join(
        cases.groupBy("term", F.col("docket_number").alias("docket")).agg(F.max("name").alias("case_name")), ["term", "docket"], "left")


def split_by_presence(requests: DataFrame, cached: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests that are cached, and those that are not."""
    c = cached.select(key).distinct()
    return requests.join(c, key, "left_semi"), requests.join(c, key, "left_anti")


def distinct_audio_urls(transcripts: DataFrame) -> DataFrame:
    """Distinct addresses in the maps of all transcripts."""
    return transcripts.select(F.explode(F.map_values("metadata.audio_urls")).alias("url")).where("url <> ''").distinct()


def distinct_hrefs(cases: DataFrame) -> DataFrame:
    """Distinct addresses of recordings that are available."""
    both = F.concat(F.coalesce("oral_arguments", F.array()), F.coalesce("opinion_announcements", F.array()))
    kept = F.filter(both, lambda a: a.isNotNull() & (F.coalesce(a["href"], F.lit("")) != "") & ~F.coalesce(a["unavailable"], F.lit(False)))
    return cases.select(F.explode(kept).alias("a")).select(F.col("a.href").alias("href")).distinct()


def rank_rows(rows: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows with the greatest values, ranked from 1; only these come together in one task."""
    top = rows.orderBy(F.desc(by), tie).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), tie)))
