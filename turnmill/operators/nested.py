"""Nested records as flat, linked tables.

Each record is visited once, depth first; every child object leaves one row with its table's tag, the key of its
record, the key of its parent, its own key and its content as JSON. Records with a schema are visited along it
(``visit``), raw documents along their JSON (``emit_raw``). ``write_flat`` writes the rows by tag, ``read_flat`` reads one tag back with its schema.
Keys are positions from 0 after null elements were left out, as strings, joined with points below the first level.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMITTED = "source_table string, record_id bigint, child string, parent_key string, child_key string, payload string"


def visit(value: Column, kind: T.DataType, tags: dict[str, str], path: str = "", parent: Column | None = None) -> list[Column]:
    """Arrays of tagged rows of all arrays of structs and maps below a value, depth first along its type.

    ``tags`` names the table of a path ('turns', 'metadata.speakers'); other lists are left in the content of their parent. Null
    arrays, maps, elements and values give none. The key of a child below another is joined to that one's key by a point.
    """
    parent = F.lit("") if parent is None else parent
    if isinstance(kind, T.StructType):
        out: list[Column] = []
        for f in kind.fields:
            out += visit(value[f.name], f.dataType, tags, f"{path}.{f.name}" if path else f.name, parent)
        return out
    tag = tags.get(path)
    if tag is None:
        return []
    row = lambda key, content: F.struct(F.lit(tag).alias("child"), parent.alias("parent_key"), key.alias("child_key"), F.to_json(content).alias("payload"))
    if isinstance(kind, T.MapType):
        entries = F.filter(F.coalesce(F.map_entries(value), F.array()), lambda e: e["value"].isNotNull())
        return [F.transform(entries, lambda e: row(e["key"], F.struct(e["value"].alias("value"))))]
    kept = F.filter(F.coalesce(value, F.array()), lambda v: v.isNotNull())
    deeper = [f.name for f in kind.elementType.fields if f"{path}.{f.name}" in tags]

    def below(v: Column, i: Column) -> Column:
        key = F.when(parent == "", i.cast("string")).otherwise(F.concat_ws(".", parent, i.cast("string")))
        return F.concat(*visit(v, kind.elementType, tags, path, key))

    own = F.transform(kept, lambda v, i: row(i.cast("string"), F.struct(*[v[f.name].alias(f.name) for f in kind.elementType.fields if f.name not in deeper])))
    return [own, F.flatten(F.transform(kept, below))] if deeper else [own]


def emit_children(df: DataFrame, source: str, record_id: str, tags: dict[str, str]) -> DataFrame:
    """One scan and one generator for all child tables of typed records, see ``visit``; rows without id are left out."""
    groups = [g for f in df.schema.fields if f.name != record_id for g in visit(F.col(f"`{f.name}`"), f.dataType, tags, f.name)]
    rows = df.where(F.col(record_id).isNotNull()).select(F.col(record_id).cast("long").alias("_id"), F.explode(F.concat(*groups)).alias("_c"))
    return rows.select(F.lit(source).alias("source_table"), F.col("_id").alias("record_id"), "_c.child", "_c.parent_key", "_c.child_key", "_c.payload")


def as_objects(value: object) -> list[dict]:
    """The objects of a list that may come as array, as one object, as map from positions, or as JSON text of these."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return []
    if isinstance(value, dict):
        if value and all(k.isdecimal() for k in value):
            value = [value[k] for k in sorted(value, key=int)]
        else:
            value = [value] if value else []
    if not isinstance(value, list):
        return []
    out = []
    for v in value:
        if isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                continue
        if isinstance(v, dict):
            out.append(v)
    return out


#: Levels below ``transcript``: tag and field of its list.
LEVELS = (("section", "sections"), ("turn", "turns"), ("text_block", "text_blocks"))


def _visit(node: dict, level: int, parent: str, out: list[tuple[str, str, str, str]]) -> None:
    child, field = LEVELS[level]
    below = LEVELS[level + 1][1] if level + 1 < len(LEVELS) else None
    for i, v in enumerate(as_objects(node.get(field))):
        out.append((child, parent, str(i), json.dumps({k: x for k, x in v.items() if k != below}, ensure_ascii=False)))
        if below:
            _visit(v, level + 1, f"{parent}.{i}" if parent else str(i), out)


def visit_payload(payload: str | None) -> list[tuple[str, str, str, str]]:
    """(child, parent_key, child_key, payload) of a raw transcript document; unreadable text gives none."""
    if not payload:
        return []
    try:
        doc = json.loads(payload)
    except (ValueError, RecursionError):
        return []
    if not isinstance(doc, dict):
        return []
    out = [("media_file", "", str(i), json.dumps(m, ensure_ascii=False)) for i, m in enumerate(as_objects(doc.get("media_file")))]
    for body in as_objects(doc.get("transcript"))[:1]:
        _visit(body, 0, "", out)
    return out


#: Characters of content that a task holds before it passes rows on.
HELD = 4_000_000


def emit_raw(df: DataFrame, record_id: str = "record_id", payload: str = "payload") -> DataFrame:
    """Child rows of raw JSON documents, passed on in batches of bounded size (or of one document); rows without id are left out."""
    names = ["record_id", "child", "parent_key", "child_key", "payload"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_pydict({"source_table": pa.array(["raw_records"] * len(rows), pa.string())} | {n: pa.array(c, pa.int64() if n == "record_id" else pa.string()) for n, c in zip(names, cols)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for i, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for r in visit_payload(p):
                    rows.append((i, *r))
                    held += len(r[3])
                if held > HELD:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    return df.where(F.col(record_id).isNotNull()).select(F.col(record_id).cast("long"), F.col(payload)).mapInArrow(run, EMITTED)


def typed_table(emitted: DataFrame, child: str, schema: T.StructType | str) -> DataFrame:
    """The rows of one tag with their links, the payload read with ``schema``; fields that don't fit are null."""
    rows = emitted.where(F.col("child") == child)
    return rows.select("source_table", "record_id", "parent_key", "child_key", F.from_json("payload", schema).alias("_v")).select(
        "source_table", "record_id", "parent_key", "child_key", "_v.*")


def write_flat(emitted: DataFrame, path: str) -> None:
    """All tags in one write, one folder per source table and tag."""
    emitted.write.mode("overwrite").partitionBy("source_table", "child").parquet(path)


def read_flat(spark: SparkSession, path: str, source: str, child: str, schema: T.StructType | str) -> DataFrame:
    """One tag of what ``write_flat`` wrote, with its links, read with its schema; a tag of which there are no rows is an empty table."""
    rows = spark.read.schema("record_id bigint, parent_key string, child_key string, payload string, source_table string, child string").parquet(path)
    return typed_table(rows.where(F.col("source_table") == source), child, schema)
