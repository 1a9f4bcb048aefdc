"""Transcripts assembled from raw documents: turns, validity, metadata, speaker lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import ids, measures as M
from turnmill.operators.current import previous, unused_name
from turnmill.operators.quality import with_group_max


def flatten_turns(raw: DataFrame) -> DataFrame:
    """Turns of raw documents (``id``, ``transcript.sections[].turns[].text_blocks[]``), numbered from 0 across sections.

    Null times count as 0, blank blocks are dropped and the others joined by one blank; a null transcript, section or turn gives no row.
    """
    sec = raw.select("id", F.posexplode("transcript.sections").alias("section_index", "s")).where("s is not null")
    t = sec.select("id", "section_index", F.posexplode("s.turns").alias("_p", "t")).where("t is not null")
    blocks = F.filter(F.transform(F.filter(F.coalesce("t.text_blocks", F.array()), lambda b: b.isNotNull()), lambda b: F.trim(F.coalesce(b["text"], F.lit("")))), lambda x: x != "")
    w = Window.partitionBy("id").orderBy("section_index", "_p")
    start, stop = F.coalesce("t.start", F.lit(0.0)), F.coalesce("t.stop", F.lit(0.0))
    text = F.array_join(blocks, " ")
    return t.select(
        "id", (F.row_number().over(w) - 1).alias("index"), "section_index", start.alias("start"), stop.alias("stop"), (stop - start).alias("duration"),
        F.col("t.speaker.ID").alias("speaker_id"), F.col("t.speaker.name").alias("speaker_name"), F.size(F.coalesce("t.text_blocks", F.array())).alias("text_block_count"),
        F.length(text).alias("char_count"), M.word_count(text).alias("word_count"), text.alias("text"))


#: Turns of a recording that one task orders at once.
BLOCK = 4096


def with_overlap(turns: DataFrame, recording: str, order: str, start: str = "start", stop: str = "stop", block: int = BLOCK) -> DataFrame:
    """``overlap_seconds`` with the turn before (0 for the first and where a time is missing) and ``is_overlapping``.

    Recordings are ordered in blocks of turn numbers; the first turn of a block looks at the last of the block before.
    """
    prev = unused_name(turns, "stop_before")
    rows = previous(turns, [recording], F.floor(F.col(order) / block), [order], stop, prev)
    over = F.greatest(F.lit(0.0), F.coalesce(F.col(prev) - F.col(start), F.lit(0.0)))
    return rows.withColumn("overlap_seconds", over).withColumn("is_overlapping", F.col("overlap_seconds") > 0).drop(prev)


def with_validity(turns: DataFrame, recording: str, duration: str = "duration", stop: str = "stop") -> DataFrame:
    """``problem`` and ``is_valid``; a turn that is valid by itself but fills more than half of the recording is too_long_ratio."""
    p = M.turn_problem(F.col(duration), F.col("text"), F.col("word_count"), F.col("overlap_seconds"))
    last = unused_name(turns, "last_end")
    out = with_group_max(turns, [recording], stop, last)
    share = F.when(F.col(last) > 0, F.col(duration) / F.col(last))
    out = out.withColumn("problem", F.coalesce(p, F.when(share > M.LARGEST_SHARE, "too_long_ratio"))).drop(last)
    return out.withColumn("is_valid", F.col("problem").isNull())


def metadata(turns: DataFrame, recording: str, durations: DataFrame | None = None, digits: int = 2) -> DataFrame:
    """Per recording: counts of turns, sections, blocks, overlaps and invalid turns, spoken seconds and share, and whether a speaker is missing."""
    spoken = F.sum(F.when(F.col("is_valid") & (F.col("duration") > 0), F.col("duration")))
    agg = turns.groupBy(recording).agg(
        F.count(F.lit(1)).alias("turn_count"), F.count_distinct("section_index").alias("section_count"), F.sum("text_block_count").alias("text_block_count"),
        F.count_if("is_overlapping").alias("overlap_count"), F.count_if(~F.col("is_valid")).alias("invalid_turn_count"),
        F.bool_or(F.col("speaker_id").isNull()).alias("has_null_speakers"), F.round(F.coalesce(spoken, F.lit(0.0)), digits).alias("total_spoken_seconds"), F.max("stop").alias("last_stop"))
    whole = F.col("last_stop")
    if durations is not None:
        agg = agg.join(durations, recording, "left")
        whole = F.col("duration_seconds")
    pct = F.when(whole > 0, F.round(F.col("total_spoken_seconds") / whole * 100, 1)).otherwise(F.lit(0.0))
    return agg.withColumn("spoken_percentage", pct)


def speaker_lists(turns: DataFrame, recording: str) -> DataFrame:
    """(recording, speaker_id, name, turn_count, rank): speakers by number of turns, ties by first appearance; the name last seen."""
    per = turns.where("speaker_id is not null").groupBy(recording, "speaker_id").agg(
        F.count(F.lit(1)).alias("turn_count"), F.min("index").alias("first"), F.max_by("speaker_name", F.when(F.col("speaker_name").isNotNull(), F.col("index"))).alias("name"))
    w = Window.partitionBy(recording).orderBy(F.desc("turn_count"), "first")
    return per.withColumn("rank", F.row_number().over(w)).drop("first")


def one_per_output(transcripts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One transcript per output key, the smallest ``order`` first: several arguments of a case share a key."""
    w = Window.partitionBy(*[F.lower(F.coalesce(F.col(k), F.lit(""))) for k in keys]).orderBy(order)
    return transcripts.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def enrich_dates(transcripts: DataFrame) -> DataFrame:
    """``title_date``, ``url_date`` and ``date_mismatch`` from the title and the mp3 address."""
    t = ids.title_date(F.col("title"))
    u = ids.recording_date(ids.recording_id_of_url(F.col("metadata.audio_urls")["mp3"]))
    return transcripts.withColumn("_t", t).withColumn("_u", u).withColumns(
        {"title_date": ids.iso_date(F.col("_t")), "url_date": ids.iso_date(F.col("_u")), "date_mismatch": ids.date_mismatch(F.col("_t"), F.col("_u"))}).drop("_t", "_u")


def merge_interruptions(turns: DataFrame, recording: str, order: str, most_words: int = 15, most_chars: int = 80, block: int = BLOCK) -> DataFrame:
    """Turns broken off with a dash, a short turn of another speaker, and the resumption with a dash by the first, joined into the first.

    A turn that resumes another begins no further triple, so chains join pairwise. Adds ``merged``; the resumed turns are gone.
    Null texts and speakers interrupt nothing. Recordings are ordered in blocks of turn numbers.
    """
    dash = r"(?:--|[–—])"
    cols = turns.columns
    narrow = turns.select(F.col(recording).alias("_r"), F.col(order).alias("_o"), F.col(order).alias("_v"))
    links = previous(narrow, ["_r"], F.floor(F.col("_o") / block), ["_o"], "_v", "_p").select("_r", "_o", "_p")
    # only turns that resume something are looked at; their neighbours come by key
    back = turns.where(F.trim("text").rlike("^" + dash) & F.col("speaker_id").isNotNull()).select(
        F.col(recording).alias("_r"), F.col(order).alias("_o"), F.col("speaker_id").alias("_who"), F.trim("text").alias("_c"))
    back = back.join(links, ["_r", "_o"]).withColumnRenamed("_p", "_p1")
    back = back.join(links.select("_r", F.col("_o").alias("_p1"), F.col("_p").alias("_p2")), ["_r", "_p1"])
    mids = turns.select(F.col(recording).alias("_r"), F.col(order).alias("_p1"), F.col("speaker_id").alias("_mid"), F.trim("text").alias("_b"))
    heads = turns.where(F.trim("text").rlike(dash + "$")).select(F.col(recording).alias("_r"), F.col(order).alias("_p2"), F.struct(*cols).alias("_a"))
    short = (F.size(F.split("_b", r"\s+")) <= most_words) | (F.length("_b") <= most_chars)
    hits = back.join(heads, ["_r", "_p2"]).join(mids, ["_r", "_p1"]).where((F.col("_a.speaker_id") == F.col("_who")) & (F.col("_mid") != F.col("_who")) & short)
    begun = hits.join(hits.select("_r", F.col("_o").alias("_p2")), ["_r", "_p2"], "left_anti")
    text = F.concat(F.regexp_replace(F.trim("_a.text"), rf"\s*{dash}$", " "), F.regexp_replace("_c", rf"^{dash}\s*", ""))
    whole = begun.select(*[text.alias(x) if x == "text" else F.col("_a")[x].alias(x) for x in cols], F.lit(True).alias("merged"))
    gone = begun.select(F.col("_r").alias(recording), F.explode(F.array("_o", "_p2")).alias(order))
    rest = turns.join(gone, [recording, order], "left_anti").select(*cols, F.lit(False).alias("merged"))
    return rest.unionByName(whole)
