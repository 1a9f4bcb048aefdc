"""Case records from raw list and detail documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.functions import ids


def timeline(events: Column) -> Column:
    """Events with the first of their dates; null elements are dropped, a missing event is ''."""
    kept = F.filter(F.coalesce(events, F.array()), lambda t: t.isNotNull())
    return F.transform(kept, lambda t: F.struct(F.coalesce(t["event"], F.lit("")).alias("event"), ids.epoch_date(F.get(t["dates"], F.lit(0))).alias("date")))


def audio_refs(items: Column, argument: bool) -> Column:
    """References to recordings with their type and speaker; a missing flag is false."""
    kept = F.filter(F.coalesce(items, F.array()), lambda a: a.isNotNull())

    def ref(a: Column) -> Column:
        t = ids.opinion_title(F.coalesce(a["title"], F.lit("")))
        kind, who = (F.lit("oral_argument"), F.lit(None).cast("string")) if argument else (t["type"], t["speaker"])
        return F.struct(a["id"].alias("id"), F.coalesce(a["title"], F.lit("")).alias("title"), F.coalesce(a["href"], F.lit("")).alias("href"),
                        F.coalesce(a["unavailable"], F.lit(False)).alias("unavailable"), kind.alias("type"), who.alias("speaker"))

    return F.transform(kept, ref)


def summaries(raw: DataFrame) -> DataFrame:
    """Case summaries of list pages."""
    cite = F.when(F.col("citation").isNotNull(), F.struct(*[F.coalesce(F.col(f"citation.{x}"), F.lit("")).alias(x) for x in ("volume", "page", "year")]))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return raw.select(F.col("ID").alias("id"), blank("name"), blank("href"), blank("docket_number"), blank("term"), cite.alias("citation"), timeline(F.col("timeline")).alias("timeline"),
                      "question", "description", "justia_url")


def details(raw: DataFrame) -> DataFrame:
    """Case records of detail documents; of several decisions the first counts."""
    d = F.get("decisions", F.lit(0))
    decision = F.when(d.isNotNull(), F.struct(d["decision_type"].alias("type"), d["winning_party"].alias("winner"), d["majority_vote"].alias("majority_votes"), d["minority_vote"].alias("minority_votes")))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return raw.select(F.col("ID").alias("id"), blank("name"), blank("docket_number"), blank("term"), blank("href"), timeline(F.col("timeline")).alias("timeline"), decision.alias("decision"),
                      audio_refs(F.col("oral_argument_audio"), True).alias("oral_arguments"), audio_refs(F.col("opinion_announcement"), False).alias("opinion_announcements"))
