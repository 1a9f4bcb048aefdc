"""Speakers across recordings and terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import ids, measures as M

# Cases and terms from which on a speaker counts as a member of the bench.
BENCH_CASES, BENCH_TERMS = 200, 5


def appearances(turns: DataFrame, recording: list[str]) -> DataFrame:
    """One row per recording and speaker over valid turns with a speaker: turns, duration_seconds, word_count (null words are 0)."""
    ok = turns.where("is_valid and speaker_id is not null")
    return ok.groupBy(*recording, "speaker_id").agg(
        F.count(F.lit(1)).alias("turns"), F.sum(F.coalesce("duration", F.lit(0.0))).alias("duration_seconds"), F.sum(F.coalesce("word_count", F.lit(0))).alias("word_count"),
        F.max("speaker_name").alias("name"))


def totals(seen: DataFrame, digits: int = 2) -> DataFrame:
    """Per speaker over appearances (with term, docket): recordings, cases, turns, duration_seconds, word_count, avg_words_per_turn."""
    case = F.concat_ws("/", "term", "docket")
    return seen.groupBy("speaker_id").agg(
        F.count(F.lit(1)).alias("recordings"), F.count_distinct(case).alias("cases"), F.sum("turns").alias("turns"), F.round(F.sum("duration_seconds"), digits).alias("duration_seconds"),
        F.sum("word_count").alias("word_count"), F.round(F.coalesce(F.try_divide(F.sum("word_count"), F.sum("turns")), F.lit(0.0)), 1).alias("avg_words_per_turn"))


def by_term(seen: DataFrame, digits: int = 2) -> DataFrame:
    """Per speaker and term: recordings, turns, duration_seconds, word_count."""
    return seen.groupBy("speaker_id", "term").agg(
        F.count(F.lit(1)).alias("recordings"), F.sum("turns").alias("turns"), F.round(F.sum("duration_seconds"), digits).alias("duration_seconds"), F.sum("word_count").alias("word_count"))


def roles(seen: DataFrame, before: DataFrame | None = None, cases: int = BENCH_CASES, terms: int = BENCH_TERMS) -> DataFrame:
    """(speaker_id, cases, terms, role): justice from enough cases and terms on, or where ``before`` (speaker_id) says so; else other."""
    n = seen.groupBy("speaker_id").agg(F.count_distinct(F.concat_ws("/", "term", "docket")).alias("cases"), F.count_distinct("term").alias("terms"))
    justice = (F.col("cases") >= cases) & (F.col("terms") >= terms)
    if before is not None:
        n = n.join(before.select("speaker_id", F.lit(True).alias("_was")).distinct(), "speaker_id", "left")
        justice = justice | F.coalesce("_was", F.lit(False))
    return n.withColumn("role", F.when(justice, "justice").otherwise("other")).select("speaker_id", "cases", "terms", "role")


def first_and_last(seen: DataFrame, date: str) -> DataFrame:
    """First and last appearance: smallest and greatest date that is not empty."""
    d = F.nullif(F.col(date), F.lit(""))
    return seen.groupBy("speaker_id").agg(F.min(d).alias("first_appearance"), F.max(d).alias("last_appearance"))


def profiles(seen: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Speaker profiles: id, name, slug, role, totals and a map by term; one exchange by speaker after that by speaker and term."""
    per = by_term(seen)
    maps = per.groupBy("speaker_id").agg(F.map_from_entries(F.collect_list(F.struct("term", F.struct("recordings", "turns", "duration_seconds", "word_count")))).alias("by_term"))
    names = seen.groupBy("speaker_id").agg(F.max("name").alias("name"))
    return (totals(seen).join(roles(seen, before).select("speaker_id", "role"), "speaker_id").join(maps, "speaker_id").join(names, "speaker_id")
            .withColumn("name_slug", ids.slug(F.col("name"))))


def of_terms(profiles_: DataFrame, terms: list[str]) -> DataFrame:
    """Profiles aggregated anew over some terms; speakers without any of them are left out, first and last appearance are terms."""
    some = F.map_filter("by_term", lambda k, v: k.isin(terms))
    kept = profiles_.withColumn("by_term", some).where(F.size("by_term") > 0)
    add = lambda field, zero: F.aggregate(F.map_values("by_term"), zero, lambda a, v: a + v[field])
    none = F.lit(0).cast("long")
    return kept.select(
        "speaker_id", "name", "role", add("recordings", none).alias("recordings"), add("turns", none).alias("turns"),
        F.round(add("duration_seconds", F.lit(0.0)), 2).alias("duration_seconds"), add("word_count", none).alias("word_count"),
        F.array_min(F.map_keys("by_term")).alias("first_appearance"), F.array_max(F.map_keys("by_term")).alias("last_appearance"), "by_term")


def term_rows(profiles_: DataFrame) -> DataFrame:
    """The map by term as an array of rows, in order of term."""
    rows = F.array_sort(F.transform(F.map_entries("by_term"), lambda e: F.struct(
        e["key"].alias("term"), e["value"]["recordings"].alias("recordings"), e["value"]["turns"].alias("turns"), e["value"]["duration_seconds"].alias("duration_seconds"),
        e["value"]["word_count"].alias("word_count"))))
    return profiles_.withColumn("by_term", rows)


def histograms(totals_: DataFrame) -> DataFrame:
    """(kind, bucket, n) of speakers by recordings and by time spoken, in one pass."""
    both = F.array(F.struct(F.lit("recordings").alias("kind"), M.recordings_bucket(F.col("recordings")).alias("bucket")),
                   F.struct(F.lit("time").alias("kind"), M.spoken_bucket(F.col("duration_seconds")).alias("bucket")))
    return totals_.select(F.explode(both).alias("x")).groupBy("x.kind", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def hours_by_role(rows: DataFrame, digits: int = 2) -> DataFrame:
    """(role, seconds, share) of time spoken."""
    per = rows.groupBy("role").agg(F.round(F.sum("duration_seconds"), digits).alias("seconds"))
    whole = F.sum("seconds").over(Window.partitionBy(F.lit(1)))  # a few roles
    return per.withColumn("share", F.round(F.try_divide("seconds", whole), 6))


def top_of_each(rows: DataFrame, group: str, by: str, k: int, tie: str) -> DataFrame:
    """The k rows of every group with the greatest value, ranked from 1; ties by ``tie``. Spark keeps k rows per group and task before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.desc(by), tie)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
