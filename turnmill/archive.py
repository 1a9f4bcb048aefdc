"""One object for the whole way from landing folders to tiers and statistics.

Folders below the root: landing/cases, landing/transcripts, landing/audio (JSON documents, media), processed (tables),
raw, flex and simple (tiers). Steps follow from what they need, so a first run needs no repetition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill import schemas
from turnmill.functions import ids, measures as M
from turnmill.functions.terms import parse_terms
from turnmill.operators import audio as AU
from turnmill.operators import cases as C
from turnmill.operators import linking as L
from turnmill.operators import speakers as S
from turnmill.operators import transcripts as T
from turnmill.sources import landing, tiers

STEPS = ("cases", "transcripts", "audio", "speakers", "raw", "flex", "simple")


class Archive:
    """An archive below one root. ``terms`` as users write them ('98-00,22') limit every step; None takes all."""

    def __init__(self, spark: SparkSession, root: str, terms: str | None = None):
        self.spark, self.root, self.terms = spark, root.rstrip("/"), parse_terms(terms)

    def _of_terms(self, df: DataFrame, column: str = "term") -> DataFrame:
        return df.where(F.col(column).isin(self.terms)) if self.terms else df

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/processed/{name}")

    def _save(self, df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        (w.partitionBy(*by) if by else w).parquet(f"{self.root}/processed/{name}")
        return self._table(name)

    # --- building -----------------------------------------------------------------------------------------------
    def build_cases(self) -> DataFrame:
        """Case records of detail documents, one folder per term."""
        raw = landing.read_documents(self.spark, f"{self.root}/landing/cases", schemas.RAW_CASE, "ID")
        return self._save(self._of_terms(C.details(raw)), "cases", ["term"])

    def build_case_index(self) -> DataFrame:
        """Case summaries of list pages."""
        return self._save(C.summaries(landing.read_case_pages(self.spark, f"{self.root}/landing/pages")), "case_index")

    def build_transcripts(self) -> DataFrame:
        """Transcripts of recordings that cases name, with judged turns; one per output key."""
        raw = landing.read_documents(self.spark, f"{self.root}/landing/transcripts", schemas.RAW_TRANSCRIPT, "id").drop("source_path")
        linked = L.link_transcripts(raw, self._table("cases").withColumn("term", F.col("term").cast("string")))
        kind = ids.transcript_title(F.coalesce("title", F.lit("")))
        heads = linked.select("id", "term", "docket", "title", kind["type"].alias("transcript_type"), kind["speaker"].alias("speaker"), ids.audio_urls(F.col("media_file")).alias("urls"),
                              F.col("transcript.duration").alias("duration_seconds"))
        heads = T.one_per_output(heads, ["term", "docket", "transcript_type", "speaker"], "id")
        dated = T.enrich_dates(heads.withColumn("metadata", F.struct(F.col("urls").alias("audio_urls")))).drop("metadata")
        self._save(self._of_terms(dated), "transcripts", ["term"])
        turns = T.with_validity(T.with_overlap(T.flatten_turns(linked), "id", "index"), "id")
        turns = turns.withColumn("invalid_reason", M.turn_problem_text(F.col("problem"), F.col("duration"), F.col("word_count"), F.col("overlap_seconds")))
        self._save(turns.join(self._table("transcripts").select("id", F.col("term").cast("string").alias("term"), "docket", "transcript_type"), "id"), "turns", ["term"])
        return self._table("transcripts")

    def build_audio_metadata(self) -> DataFrame:
        """Rate, length and signal problems of media files."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{wav,mp3,ogg,flac}").load(f"{self.root}/landing/audio")
        where = ids.term_and_docket(F.col("path"))
        info = AU.probe(files)
        heard = AU.mono_samples(files).where("error is null")
        frame = F.greatest(F.lit(1), (F.col("sample_rate") * 25 / 1000).cast("int"))
        judged = heard.withColumn("e", M.frame_energies(F.col("samples"), frame)).select("path", M.variation(F.col("e")).alias("energy_cv"), M.mean_of(F.col("e")).alias("mean_rms"),
                                                                                         M.audio_problem(F.col("samples"), F.col("e")).alias("anomaly_reason"))
        out = info.join(judged, "path", "left").withColumns({"recording_id": ids.recording_id_of_path(F.col("path")), "term": where["term"], "docket": where["docket"],
                                                             "source_era": ids.era(where["term"]), "is_anomaly": F.col("anomaly_reason").isNotNull()})
        return self._save(self._of_terms(out), "audio")

    def build_speakers(self) -> DataFrame:
        """Speaker profiles; who was a justice stays one."""
        turns = self._table("turns").withColumn("term", F.col("term").cast("string"))
        seen = S.appearances(turns, ["id", "term", "docket"])
        before = landing.read_or_empty(self.spark, f"{self.root}/processed/speakers", schemas.SPEAKERS).where("role = 'justice'").select("speaker_id")
        known = [r.speaker_id for r in before.collect()]  # members of the bench, a few dozen
        return self._save(S.profiles(seen, self.spark.createDataFrame([(k,) for k in known], "speaker_id long") if known else None), "speakers")

    # --- tiers --------------------------------------------------------------------------------------------------
    def recordings(self) -> DataFrame:
        """Recordings of the flex tier with their speakers."""
        justices = self._table("speakers").where("role = 'justice'").select("speaker_id")
        turns = L.flag_members(self._table("turns").withColumn("term", F.col("term").cast("string")), justices, "speaker_id", "is_justice")
        who = L.speakers_of_recording(turns, ["term", "docket", "transcript_type"])
        a = self._table("audio").withColumn("transcript_type", ids.recording_type(F.col("recording_id")))
        none = F.array().cast("array<bigint>")
        return a.join(who, ["term", "docket", "transcript_type"], "left").select(
            "term", "docket", "recording_id", "transcript_type", F.col("path").alias("audio_path"), F.col("duration").alias("duration_sec"), "sample_rate", "channels",
            F.lower(F.element_at(F.split("path", r"\."), -1)).alias("source_format"), "source_era", F.coalesce("justice_speakers", none).alias("justice_speakers"),
            F.coalesce("other_speakers", none).alias("other_speakers"), F.coalesce("total_speakers", F.lit(0)).cast("int").alias("total_speakers"))

    def utterances(self) -> DataFrame:
        """Utterances of the flex tier."""
        justices = self._table("speakers").where("role = 'justice'").select("speaker_id")
        t = L.flag_members(self._table("turns"), justices, "speaker_id", "is_justice")
        return t.select(F.col("term").cast("string").alias("term"), "docket", "transcript_type", F.col("index").alias("turn_index"), F.col("start").alias("start_sec"), F.col("stop").alias("end_sec"),
                        F.col("duration").alias("duration_sec"), "speaker_id", "speaker_name", "is_justice", "text", F.col("word_count").cast("int").alias("word_count"), F.col("is_valid").alias("valid"),
                        "invalid_reason")

    def write_raw(self, force: bool = False) -> bool:
        files = L.pair_formats(landing.list_media(self.spark, f"{self.root}/landing/audio", ("mp3", "ogg")).select("path"))
        where = ids.term_and_docket(F.col("path"))
        rows = files.select("recording_id", F.col("path").alias("audio_path"), where["term"].alias("term"), where["docket"].alias("docket"))
        return tiers.write_tier(self.spark, f"{self.root}/raw", {"recordings": self._of_terms(rows)}, self.terms, force=force)

    def write_flex(self, force: bool = False) -> bool:
        return tiers.write_tier(self.spark, f"{self.root}/flex", {"recordings": self.recordings(), "utterances": self.utterances(), "speakers": self._table("speakers")}, self.terms, force=force)

    def write_simple(self, include_invalid: bool = False, shard_mb: int = 100) -> None:
        """Usable utterances that have a recording, by split of duration, with their audio where it can be read."""
        rec, utt = landing.load_flex(self.spark, f"{self.root}/flex")
        keys = ["term", "docket", "transcript_type"]
        u = utt if include_invalid else utt.where(F.coalesce("valid", F.lit(False)))
        u = L.with_recording(u, rec, keys)
        first = rec.groupBy(*keys).agg(F.min("audio_path").alias("path"))
        u = u.withColumn("segment_id", F.concat_ws("_", *keys, F.col("turn_index").cast("string")))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.root}/landing/audio")
        cut = AU.cut_segments(u.join(first, keys).select("segment_id", "path", "start_sec", "end_sec"), files)
        tiers.write_simple(self.spark, f"{self.root}/simple", tiers.simple_rows(u.join(cut.select("segment_id", F.col("bytes").alias("audio_bytes")), "segment_id", "left")), shard_mb)

    # --- loading and statistics ---------------------------------------------------------------------------------
    def load_flex(self) -> tuple[DataFrame, DataFrame]:
        return landing.load_flex(self.spark, f"{self.root}/flex")

    def load_simple(self, split: str = "all") -> DataFrame:
        return landing.load_simple(self.spark, f"{self.root}/simple", split)

    def stats_cases(self) -> DataFrame:
        c = self._of_terms(self._table("cases"))
        return c.agg(F.count(F.lit(1)).alias("cases"), F.count_if(F.size("oral_arguments") > 0).alias("with_arguments"), F.count_if(F.size("opinion_announcements") > 0).alias("with_opinions"),
                     F.min("term").alias("first_term"), F.max("term").alias("last_term"))

    def stats_transcripts(self) -> DataFrame:
        return self._of_terms(self._table("turns")).groupBy("transcript_type").agg(
            F.count_distinct("id").alias("transcripts"), F.count(F.lit(1)).alias("turns"), F.count_if("is_valid").alias("valid_turns"), F.sum("word_count").alias("words"))

    def stats_audio(self) -> DataFrame:
        a = self._of_terms(self._table("audio"))
        return a.groupBy("source_era").agg(F.count(F.lit(1)).alias("files"), F.sum("duration").alias("seconds"), F.sum("file_size").alias("bytes"), F.count_if("is_anomaly").alias("anomalies"))

    def stats_speakers(self, top: int = 10) -> DataFrame:
        p = self._table("speakers")
        return L.rank_rows((S.of_terms(p, self.terms) if self.terms else p).select("speaker_id", "name", "role", "turns", "duration_seconds"), "turns", "speaker_id", top)

    def run(self, skip: tuple[str, ...] = ()) -> list[str]:
        """All steps in order of what they need; returns those done."""
        steps = {"cases": self.build_cases, "transcripts": self.build_transcripts, "audio": self.build_audio_metadata, "speakers": self.build_speakers, "raw": self.write_raw, "flex": self.write_flex,
                 "simple": self.write_simple}
        done = []
        for name in STEPS:
            if name not in skip:
                steps[name]()
                done.append(name)
        return done
