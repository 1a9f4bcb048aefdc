import json

from turnmill.operators.nested import as_objects, emit_raw, typed_table, visit_payload, write_flat
from turnmill.plans import pipeline_queries as P


def keys(doc):
    return [r[:3] for r in visit_payload(json.dumps(doc))]


def test_lists_in_any_form():
    turn = {"start": 0, "text_blocks": {"1": {"text": "b"}, "0": {"text": "a"}, "2": None}}
    doc = {"media_file": {"mime": "m", "href": "h"}, "transcript": {"sections": json.dumps([None, {"turns": [None, turn]}])}}
    assert keys(doc) == [("media_file", "", "0"), ("section", "", "0"), ("turn", "0", "0"), ("text_block", "0.0", "0"), ("text_block", "0.0", "1")]


def test_unreadable_gives_none():
    for p in (None, "", "{", "[1]", "null", "12", '{"transcript": null}', '{"transcript": 5, "media_file": "x"}'):
        assert visit_payload(p) == []
    assert as_objects([1, "x", {"a": 1}, '{"b": 2}']) == [{"a": 1}, {"b": 2}]


def test_tagged_rows_read_back(spark, data, tmp_path):
    flat = P.flat_children(spark, data)
    write_flat(flat, str(tmp_path / "flat"))
    back = spark.read.parquet(str(tmp_path / "flat"))
    assert back.count() == flat.count() > 0
    blocks = typed_table(flat, "text_block", "start double, stop double, text string")
    assert blocks.where("text is not null").count() > 0
    # every child has its parent
    turns = {(r.record_id, f"{r.parent_key}.{r.child_key}") for r in flat.where("child = 'turn' and source_table = 'raw_records'").collect()}
    assert {(r.record_id, r.parent_key) for r in flat.where("child = 'text_block'").collect()} <= turns


def test_empty_table(spark):
    assert emit_raw(spark.createDataFrame([], "record_id long, payload string")).count() == 0
    assert emit_raw(spark.createDataFrame([(None, "{}"), (1, None)], "record_id long, payload string")).count() == 0


def test_visitor_of_any_depth(spark):
    """Lists below lists, maps, nulls at every level; what is not named stays in the content of its parent."""
    from turnmill.operators.nested import emit_children

    rows = [(1, {"parts": [{"name": "a", "notes": [{"t": "x"}, None, {"t": "y"}]}, None, {"name": "b", "notes": None}], "links": {"k": "v", "z": None}, "other": [1]}, "clash"), (2, None, None), (None, None, "z")]
    df = spark.createDataFrame(rows, "id long, doc struct<parts:array<struct<name:string,notes:array<struct<t:string>>>>,links:map<string,string>,other:array<int>>, child string")
    got = {(r.record_id, r.child, r.parent_key, r.child_key, r.payload) for r in emit_children(df, "docs", "id", {"doc.parts": "part", "doc.parts.notes": "note", "doc.links": "link"}).collect()}
    assert got == {(1, "part", "", "0", '{"name":"a"}'), (1, "part", "", "1", '{"name":"b"}'), (1, "note", "0", "0", '{"t":"x"}'), (1, "note", "0", "1", '{"t":"y"}'), (1, "link", "", "k", '{"value":"v"}')}


def test_flat_tables_have_their_schemas(spark, data):
    tables = P.flat_tables(spark, data)
    assert dict(tables[("cases", "timeline")].dtypes)["event"] == "string" and tables[("raw_records", "text_block")].where("text is not null and start is not null").count() > 0
