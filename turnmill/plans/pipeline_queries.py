"""Queries p2, p3 and p6 with the SQL that checks them."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.operators.current import current_rows
from turnmill.operators.intervals import periods_and_gaps
from turnmill.operators.nested import emit_children, emit_raw, read_flat, write_flat
from turnmill.operators.snapshots import canonical_url, last_seen_hash, snapshot_changes
from turnmill.session import shared_dir, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods of speech and silences of each recording."""
    turns = table(spark, sf_dir, "turns").select("transcript_id", "turn_index", "start", "stop", "loaded_at")
    now = current_rows(turns, ["transcript_id", "turn_index"], "loaded_at", [F.col("start"), F.col("stop")])
    spans = now.where("start < stop").select(
        "transcript_id", F.round(F.col("start") * 1000).cast("long").alias("a"), F.round(F.col("stop") * 1000).cast("long").alias("b"))
    out = periods_and_gaps(spans, ["transcript_id"], "a", "b")
    return out.select("transcript_id", "kind", F.col("start").alias("start_ms"), F.col("stop").alias("stop_ms"))


P2_SQL = """
with cur as (
  select transcript_id, start, stop from turns
  where transcript_id is not null and turn_index is not null
  qualify row_number() over (partition by transcript_id, turn_index order by loaded_at desc nulls last, start desc nulls last, stop desc nulls last) = 1),
s as (select transcript_id, cast(round(start * 1000) as bigint) a, cast(round(stop * 1000) as bigint) b from cur where start < stop),
v as (select * from s where a < b),
f as (select transcript_id, a, b, case when a <= max(b) over (partition by transcript_id order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end n from v),
g as (select *, sum(n) over (partition by transcript_id order by a, b rows unbounded preceding) k from f),
p as (select transcript_id, k, min(a) a, max(b) b from g group by 1, 2),
q as (select *, lead(a) over (partition by transcript_id order by a) c from p)
select transcript_id, 'period' as kind, a as start_ms, b as stop_ms from q
union all select transcript_id, 'gap', b, c from q where c is not null
"""


#: Tables that come out of nested records, by where their objects lie, with what of their content is read.
TRANSCRIPT_TAGS = {"turns": "turn", "metadata.speakers": "speaker", "metadata.audio_urls": "audio_url"}
CASE_TAGS = {"oral_arguments": "oral_argument", "opinion_announcements": "opinion_announcement", "timeline": "timeline"}
_RECORDING = "id bigint, title string, href string, unavailable boolean, type string, speaker string"
TABLES = {
    ("transcripts", "turn"): "index int, section_index int, start double, stop double, speaker_id bigint, word_count int, text string",
    ("transcripts", "speaker"): "id bigint, name string, turn_count int", ("transcripts", "audio_url"): "value string",
    ("cases", "oral_argument"): _RECORDING, ("cases", "opinion_announcement"): _RECORDING, ("cases", "timeline"): "event string, date string",
    ("raw_records", "media_file"): "mime string, size bigint, href string", ("raw_records", "section"): "start double, stop double",
    ("raw_records", "turn"): "start double, stop double", ("raw_records", "text_block"): "start double, stop double, text string"}
LINKS = ["source_table", "record_id", "child", "parent_key", "child_key"]


def flat_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child object of the three nested tables with its content."""
    tr = current_rows(table(spark, sf_dir, "transcripts").select("id", "metadata", "turns", "loaded_at"), ["id"], "loaded_at").drop("loaded_at")
    ca = current_rows(table(spark, sf_dir, "cases").select("id", "timeline", "oral_arguments", "opinion_announcements", "loaded_at"), ["id"], "loaded_at").drop("loaded_at")
    ra = current_rows(table(spark, sf_dir, "raw_records").select("record_id", "payload", "fetched_at"), ["record_id"], "fetched_at", [F.col("payload")])
    return emit_children(tr, "transcripts", "id", TRANSCRIPT_TAGS).unionByName(emit_children(ca, "cases", "id", CASE_TAGS)).unionByName(emit_raw(ra))


def flat_tables(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    """The tables of ``flat_children``, written by tag in one pass and each read back with its schema."""
    path = f"{shared_dir(spark)}/turnmill-flat-{uuid.uuid4().hex}"
    write_flat(flat_children(spark, sf_dir), path)
    return {(source, child): read_flat(spark, path, source, child, schema).withColumn("child", F.lit(child)) for (source, child), schema in TABLES.items()}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every child object, from the flat tables."""
    return functools.reduce(DataFrame.unionByName, [t.select(*LINKS) for t in flat_tables(spark, sf_dir).values()])


def p3_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the flat tables of records with a schema hold: rows, those with a title, name, event or text, and its characters in all."""
    tables = flat_tables(spark, sf_dir)
    said = {"turn": "text", "speaker": "name", "audio_url": "value", "oral_argument": "title", "opinion_announcement": "title", "timeline": "event"}
    parts = [t.groupBy("source_table", "child").agg(F.count(F.lit(1)).alias("n"), F.count(said[c]).alias("with_text"), F.coalesce(F.sum(F.length(said[c])), F.lit(0)).alias("characters"))
             for (s, c), t in tables.items() if s != "raw_records"]
    return functools.reduce(DataFrame.unionByName, parts)


_P3_LISTS = [("transcripts", "turn", "tr", "turns", "x.text"), ("transcripts", "speaker", "tr", "metadata.speakers", "x.name"), ("transcripts", "audio_url", "tr", "map_values(metadata.audio_urls)", "x"),
             ("cases", "oral_argument", "ca", "oral_arguments", "x.title"), ("cases", "opinion_announcement", "ca", "opinion_announcements", "x.title"), ("cases", "timeline", "ca", "timeline", "x.event")]
P3_CONTENTS_SQL = """
with tr as (select * from transcripts where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1),
ca as (select * from cases where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1)
""" + " union all ".join(
    f"select '{s}' as source_table, '{c}' as child, count(*) as n, count({t}) as with_text, cast(coalesce(sum(length({t})), 0) as bigint) as characters from (select unnest({v}) as x from {f}) where x is not null having count(*) > 0"
    for s, c, f, v, t in _P3_LISTS)


def _objects(j: str) -> str:
    """SQL for the objects of a JSON value that may be an array, one object, a map from positions, or JSON text of these."""
    text = lambda x: f"case when json_type({x}) = 'VARCHAR' then try_cast({x} ->> '$' as json) else {x} end"
    v = text(j)
    return (f"list_filter(list_transform(case json_type({v}) when 'ARRAY' then cast(({v}) as json[]) when 'OBJECT' then case when len(json_keys({v})) = 0 then [] "
            f"when len(list_filter(json_keys({v}), lambda k: not regexp_full_match(k, '[0-9]+'))) = 0 then list_transform(list_sort(list_transform(json_keys({v}), lambda k: cast(k as bigint))), "
            f"lambda k: json_extract(({v}), '$.\"' || k || '\"')) else [({v})] end else [] end, lambda e: {text('e')}), lambda e: json_type(e) = 'OBJECT')")


P3_SQL = f"""
with tr as (select * from transcripts where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1),
ca as (select * from cases where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1),
ra as (select record_id, try_cast(payload as json) as j from (select * from raw_records where record_id is not null qualify row_number() over (partition by record_id order by fetched_at desc nulls last, payload desc nulls last) = 1)),
ok as (select record_id, j from ra where json_type(j) = 'OBJECT'),
body as (select record_id, list_extract({_objects("(j -> '$.transcript')")}, 1) as j from ok),
sec as (select record_id, unnest(o) as j, generate_subscripts(o, 1) - 1 as s from (select record_id, {_objects("(j -> '$.sections')")} as o from body where j is not null)),
tur as (select record_id, s, unnest(o) as j, generate_subscripts(o, 1) - 1 as t from (select record_id, s, {_objects("(j -> '$.turns')")} as o from sec)),
blk as (select record_id, s, t, unnest(o) as j, generate_subscripts(o, 1) - 1 as b from (select record_id, s, t, {_objects("(j -> '$.text_blocks')")} as o from tur)),
med as (select record_id, unnest(o) as j, generate_subscripts(o, 1) - 1 as m from (select record_id, {_objects("(j -> '$.media_file')")} as o from ok))
select 'raw_records' as source_table, record_id, 'section' as child, '' as parent_key, cast(s as varchar) as child_key from sec
union all select 'raw_records', record_id, 'turn', cast(s as varchar), cast(t as varchar) from tur
union all select 'raw_records', record_id, 'text_block', s || '.' || t, cast(b as varchar) from blk
union all select 'raw_records', record_id, 'media_file', '', cast(m as varchar) from med
union all select 'transcripts', id, 'audio_url', '', e.key from (select id, unnest(map_entries(metadata.audio_urls)) as e from tr) where e.value is not null
""" + "".join(
    f"union all select '{s}', id, '{c}', '', cast(generate_subscripts(o, 1) - 1 as varchar) from (select id, list_filter({v}, lambda x: x is not null) as o from {f})\n"
    for s, c, f, v, _ in _P3_LISTS if c != "audio_url")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls added, removed or with other content between consecutive snapshots."""
    snaps = table(spark, sf_dir, "cache_snapshots").select(
        "snapshot_no", canonical_url(F.col("url")).alias("url"), "fetched_at", last_seen_hash(F.col("versions")).alias("content"))
    return snapshot_changes(snaps, "snapshot_no", "url", "fetched_at", "content")


P6_SQL = """
with r as (
  select snapshot_no s, rtrim(lower(trim(url)), '/') u, fetched_at f,
    coalesce(list_extract(list_reverse_sort([{'seen': v.last_seen, 'hash': lower(trim(v.content_hash))} for v in coalesce(versions, []) if v is not null and v.content_hash is not null]), 1).hash, '') c
  from cache_snapshots where snapshot_no is not null and url is not null),
l as (select s, u, c from r qualify row_number() over (partition by s, u order by f desc nulls last, c desc) = 1),
n as (select s, lag(s) over (order by s) p from (select distinct s from r)),
x as (select n.s, l.u, l.c from n join l on l.s = n.s where n.p is not null),
y as (select n.s, l.u, l.c from n join l on l.s = n.p)
select cast(coalesce(x.s, y.s) as bigint) as snapshot_no, coalesce(x.u, y.u) as url,
  case when y.u is null then 'added' when x.u is null then 'removed' else 'changed' end as change
from x full join y on x.s = y.s and x.u = y.u
where x.u is null or y.u is null or x.c <> y.c
"""

QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_contents": p3_contents, "p6_found": p6_found}
ORACLES = {"p2_found": P2_SQL, "p3_found": P3_SQL, "p3_contents": P3_CONTENTS_SQL, "p6_found": P6_SQL}
