"""Queries of this subpackage and the SQL that checks them, where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.llm.chunking import FORCED, Limits, oversized, split_oversized
from turnmill.llm.mixing import mix, report
from turnmill.llm.packing import pack
from turnmill.llm.pii import find_all, learn_table, name_filter, scan_documents
from turnmill.llm.sentences import lay_out_all, sentences, train
from turnmill.llm.splits import assign_splits, docket_key, related_groups
from turnmill.llm.tokens import token_sizes
from turnmill.llm.turns import item_rows, mark, runs_of_one_person, settle_speakers
from turnmill.operators.current import current_rows
from turnmill.session import durable, spread_scan, table

TURN = ["transcript_id", "turn_index"]


def _turn_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(table(spark, sf_dir, "turns").select(*TURN, "text", "loaded_at"), TURN, "loaded_at", [F.col("text")])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the sentences of every current turn."""
    laid = durable(lay_out_all(_turn_texts(spark, sf_dir), TURN, "text", said=True))
    out = sentences(laid, TURN, train(laid, laid))
    return out.select("transcript_id", F.col("turn_index").cast("long").alias("turn_index"), F.col("end_char"))


def _limits(spark: SparkSession, sf_dir: str) -> Limits:
    got = {r["unit"]: r for r in table(spark, sf_dir, "size_limits").where("item = 'turn'").collect()}  # a table of three rows
    return Limits(got["chars"]["limit_value"], got["chars"]["overlap_value"], got["seconds"]["limit_value"], got["seconds"]["overlap_value"])


def turn_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every current turn that is above a limit."""
    limits = _limits(spark, sf_dir)
    cols = [*TURN, "text", "start", "stop", "duration", "loaded_at"]
    now = current_rows(table(spark, sf_dir, "turns").select(*cols), TURN, "loaded_at", [F.col("text"), F.col("start"), F.col("stop"), F.col("duration")])
    sized = oversized(now, "text", "start", "stop", "duration", limits).withColumn("long_text", F.when(F.col("over"), F.col("text")))
    laid = durable(lay_out_all(sized, [*TURN, "over", "span_us", "size", "timed", "long_text"], "text", silent=True))
    every = lay_out_all(now, TURN, "text", said=True)  # read only where an oversized turn writes no marks
    return split_oversized(laid.where("over"), TURN, train(laid, every), limits)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each turn above a limit had to be cut."""
    return turn_pieces(spark, sf_dir).groupBy("transcript_id", F.col("turn_index").cast("long").alias("turn_index")).agg(
        F.when(F.max("cut") == FORCED, "forced").otherwise("natural").alias("cut"))


def _marked_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current turns with their spans and the person who speaks."""
    cols = [*TURN, "text", "speaker_id", "speaker_name", "loaded_at"]
    now = current_rows(table(spark, sf_dir, "turns").select(*cols), TURN, "loaded_at", [F.col("text"), F.col("speaker_id"), F.col("speaker_name")])
    marked = durable(mark(now, TURN, "text", "speaker_id", "speaker_name"))
    bench, speakers = table(spark, sf_dir, "bench"), table(spark, sf_dir, "speakers")
    people = speakers.select("speaker_id", "name").unionByName(bench.select("speaker_id", "name"))
    tr = current_rows(table(spark, sf_dir, "transcripts").select("id", "term", "metadata.speakers", "loaded_at"), ["id"], "loaded_at")
    listed = tr.select(F.col("id").alias("transcript_id"), F.explode("speakers").alias("s")).select("transcript_id", F.col("s.id").alias("speaker_id"))
    present = marked.select("transcript_id", "speaker_id").where("speaker_id is not null").distinct().unionByName(listed)
    terms = tr.select(F.col("id").alias("transcript_id"), F.expr("try_cast(term as int)").alias("year"))
    # the bench is a table of fixed size; its chiefs by year
    by_year = bench.where("role = 'chief_justice' and first_term <= last_term").select("speaker_id", F.explode(F.sequence("first_term", "last_term")).alias("year"))
    chiefs = terms.join(F.broadcast(by_year), "year").select("transcript_id", "speaker_id")
    # where terms leave it open, the chief who is known to speak there
    seated = present.join(F.broadcast(bench.where("role = 'chief_justice'").select("speaker_id")), "speaker_id").select("transcript_id", "speaker_id")
    one = seated.groupBy("transcript_id").agg(F.min("speaker_id").alias("speaker_id"), F.max("speaker_id").alias("hi")).where("speaker_id = hi").drop("hi")
    chiefs = chiefs.unionByName(one.join(chiefs, "transcript_id", "left_anti"))
    return settle_speakers(marked, TURN, "transcript_id", people, present, chiefs)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in the texts of all current turns, and runs of turns by one person."""
    turns = durable(_marked_turns(spark, sf_dir).select(*TURN, "spans", "said", "person"))
    items = item_rows(turns, TURN).select(
        "transcript_id", F.col("turn_index").cast("long").alias("turn_index"), "item", F.col("start_char").alias("pos_a"), F.col("end_char").alias("pos_b"))
    runs = runs_of_one_person(turns.where("said"), "transcript_id", "turn_index", "person")
    return items.unionByName(runs.select("transcript_id", F.col("first_index").alias("turn_index"), F.lit("speaker_turn").alias("item"),
                                         F.col("last_index").alias("pos_a"), F.col("person").alias("pos_b")))


def _case_and_speaker_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current transcripts (id), and what ties them: (id, key) of their cases and off-bench speakers."""
    tr = current_rows(table(spark, sf_dir, "transcripts").select("id", "case_docket", "term", "turns.speaker_id", "loaded_at"), ["id"], "loaded_at", [F.col("case_docket"), F.col("term")])
    case = tr.select("id", F.concat(F.lit("c\t"), F.trim("term"), F.lit("\t"), docket_key(F.col("case_docket"))).alias("key"))
    flat = current_rows(table(spark, sf_dir, "turns").select(*TURN, "speaker_id", "loaded_at"), TURN, "loaded_at", [F.col("speaker_id")])
    spoke = flat.select(F.col("transcript_id").alias("id"), "speaker_id").unionByName(tr.select("id", F.explode("speaker_id").alias("speaker_id")))
    spoke = spoke.where("speaker_id is not null").distinct()
    # the bench is a table of fixed size
    off = spoke.join(F.broadcast(table(spark, sf_dir, "bench").select("speaker_id")), "speaker_id", "left_anti")
    known = off.join(tr.select("id"), "id", "left_semi").select("id", F.concat(F.lit("s\t"), F.col("speaker_id").cast("string")).alias("key"))
    return tr.select("id"), case.unionByName(known)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts that must stay together: each but the smallest of its group, with that smallest."""
    _, keys = _case_and_speaker_keys(spark, sf_dir)
    return related_groups(keys).select("group_id", F.col("id").alias("transcript_id"))


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split of every current transcript."""
    records, keys = _case_and_speaker_keys(spark, sf_dir)
    targets = [(r["split_name"], r["target_share"]) for r in table(spark, sf_dir, "split_targets").orderBy(F.desc("target_share"), "split_name").collect()]  # three rows
    return assign_splits(records, related_groups(keys), targets).select(F.col("id").alias("transcript_id"), "group_id", "split_name")


def _personal_data(spark: SparkSession, sf_dir: str, redact: bool) -> DataFrame:
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text").where("doc_id is not null"))
    people = table(spark, sf_dir, "speakers").select("name").unionByName(table(spark, sf_dir, "bench").select("name"))
    scanned = durable(scan_documents(docs, "doc_id", "text", name_filter(people), keep_text=redact))
    return find_all(scanned, "doc_id", learn_table(scanned), redact=redact)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return _personal_data(spark, sf_dir, False)


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with placeholders for personal data."""
    return _personal_data(spark, sf_dir, True)


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into containers of the container limit."""
    limit = table(spark, sf_dir, "size_limits").where("item = 'container'").first()["limit_value"]
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pack(token_sizes(docs, ["doc_id"], "text", terms=True), "doc_id", limit)


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in the mixture."""
    rows = table(spark, sf_dir, "mix_targets").collect()  # seven rows
    docs = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix(token_sizes(docs, ["doc_id", "source"], "text"), {r["source"]: (r["target_share"], r["max_repeats"]) for r in rows})


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source of the mixture."""
    return report(p9_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


P5_SQL = r"""
with recursive tr as (
  select * from transcripts where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last, case_docket desc nulls last, term desc nulls last) = 1),
tu as (
  select transcript_id, speaker_id from turns where transcript_id is not null and turn_index is not null
  qualify row_number() over (partition by transcript_id, turn_index order by loaded_at desc nulls last, speaker_id desc nulls last) = 1),
k as (
  select id, 'c|' || trim(term) || '|' || list_aggregate(list_transform(regexp_extract_all(case_docket, '[0-9]+'), lambda x: cast(cast(x as bigint) as varchar)), 'string_agg', '-') as key
  from tr where regexp_matches(case_docket, '[0-9]')
  union select transcript_id, 's|' || speaker_id from tu where speaker_id not in (select speaker_id from bench) and transcript_id in (select id from tr)
  union select id, 's|' || u.speaker_id from (select id, unnest(turns) as u from tr) where u.speaker_id not in (select speaker_id from bench)),
e as (select distinct a.id as a, b.id as b from k a join k b using (key)),
reach as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a)
select min(b) as group_id, a as transcript_id from reach group by a having min(b) <> a
"""

def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of a turn above a limit begins and ends, and what its cut parts."""
    kinds = F.array(F.lit("natural"), F.lit("word"), F.lit("forced"))
    return turn_pieces(spark, sf_dir).select("transcript_id", "turn_index", "piece_no", "start_char", "end_char", F.get(kinds, F.col("cut")).alias("cut"))


def p7_clean_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in which something is said, with the speaker settled and the text clean."""
    return _marked_turns(spark, sf_dir).where("said").select("transcript_id", "turn_index", "person", "clean_text")


def p4_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn above a limit with its length, the characters that no piece covers, and the pieces above the limit of characters."""
    limits = _limits(spark, sf_dir)
    pieces = turn_pieces(spark, sf_dir)
    # a turn's pieces are few; what lies between one and those before it
    w = Window.partitionBy(*TURN).orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.greatest(F.col("start_char") - F.coalesce(F.max("end_char").over(w), F.lit(0)), F.lit(0))
    return pieces.withColumn("gap", gap).groupBy(*TURN).agg(F.max("end_char").alias("characters"), F.sum("gap").alias("uncovered"),
                                                            F.count_if(F.col("end_char") - F.col("start_char") > limits.chars).alias("too_long"))


P4_COVER_SQL = """
with cur as (select * from turns where transcript_id is not null and turn_index is not null
  qualify row_number() over (partition by transcript_id, turn_index order by loaded_at desc nulls last, text desc nulls last, start desc nulls last, stop desc nulls last, duration desc nulls last) = 1),
l as (select max(limit_value) filter (where unit = 'chars') as c, max(limit_value) filter (where unit = 'seconds') as s from size_limits where item = 'turn')
select transcript_id, turn_index, cast(coalesce(length(text), 0) as bigint) as characters, cast(0 as bigint) as uncovered, cast(0 as bigint) as too_long
from cur, l where coalesce(length(text), 0) > c or round(case when start is not null and stop is not null then stop - start else duration end, 6) > s
"""


def p5_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many splits and groups each case, as term and docket, lies in; and every current transcript once."""
    case = _case_and_speaker_keys(spark, sf_dir)[1].where("key like 'c%'")
    return p5_splits(spark, sf_dir).join(case, F.col("id") == F.col("transcript_id"), "left").groupBy(F.coalesce("key", F.col("transcript_id").cast("string")).alias("_k")).agg(
        F.min("transcript_id").alias("first_transcript"), F.count(F.lit(1)).alias("transcripts"), F.count_distinct("split_name").alias("splits"), F.count_distinct("group_id").alias("groups")).drop("_k")


P5_TOGETHER_SQL = """
with tr as (select * from transcripts where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last, case_docket desc nulls last, term desc nulls last) = 1),
k as (select id, case when regexp_matches(case_docket, '[0-9]') then 'c|' || trim(term) || '|' ||
  list_aggregate(list_transform(regexp_extract_all(case_docket, '[0-9]+'), lambda x: cast(cast(x as bigint) as varchar)), 'string_agg', '-') end as key from tr)
select min(id) as first_transcript, count(*) as transcripts, cast(1 as bigint) as splits, cast(1 as bigint) as groups from k group by coalesce(key, cast(id as varchar))
"""


def p8_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its containers' greatest load against the limit, and whether its pieces join without gap or overlap; only one above the limit has several."""
    limit = table(spark, sf_dir, "size_limits").where("item = 'container'").first()["limit_value"]
    rows = durable(p8_containers(spark, sf_dir))
    load = rows.groupBy("container").agg((F.sum("tokens") <= limit).alias("fits"))
    each = rows.join(load, "container").groupBy("doc_id").agg(
        F.bool_and("fits").alias("fits"), F.sum("tokens").alias("t"), F.max("end_token").alias("e"), F.min("start_token").alias("s"), F.count(F.lit(1)).alias("n"))
    return each.select("doc_id", "fits", ((F.col("t") == F.col("e")) & (F.col("s") == 0) & ((F.col("n") == 1) | (F.col("t") > limit))).alias("whole"))


def p9_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: whether its tokens are as near to its target as the largest text allows, and no text is taken more often than allowed."""
    mixture = durable(p9_mixture(spark, sf_dir))
    whole = mixture.agg(F.sum(F.col("tokens") * F.col("copies")).alias("all"), F.max("tokens").alias("largest")).first()
    off = F.abs(F.col("actual_share") - F.col("target_share")) * F.lit(whole["all"])
    return report(mixture, table(spark, sf_dir, "mix_targets")).select(
        "source", "target_share", (off <= F.lit(whole["largest"])).alias("near"), (F.col("most_copies") <= F.col("max_repeats")).alias("within"))


QUERIES = {"p4_pieces": p4_pieces, "p7_clean_turns": p7_clean_turns, "p8_containers": p8_containers, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p4_cover": p4_cover, "p5_together": p5_together, "p8_whole": p8_whole, "p9_bounds": p9_bounds, "p10_found": p10_found, "p10_redacted": p10_redacted, "p5_found": p5_found, "p5_splits": p5_splits, "p1_found": p1_found, "p4_found": p4_found, "p7_found": p7_found}
ORACLES = {
    "p5_found": P5_SQL, "p4_cover": P4_COVER_SQL, "p5_together": P5_TOGETHER_SQL,
    "p8_whole": "select doc_id, true as fits, true as whole from documents where doc_id is not null",
    "p9_bounds": "select source, target_share, true as near, true as within from mix_targets"}
