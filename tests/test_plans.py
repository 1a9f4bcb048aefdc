import re

import pytest

import __spark_entry__ as entry
from turnmill.plans import archive_queries, pipeline_queries

NAMES = sorted({**archive_queries.QUERIES, **pipeline_queries.QUERIES})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_joins(spark, data, name):
    text = plan(entry.queries()[name](spark, data))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scans_read_what_they_need(spark, data):
    text = plan(entry.queries()["p2_found"](spark, data))
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert read == {"transcript_id:bigint,turn_index:int,start:double,stop:double,loaded_at:timestamp_ntz"}
    assert "PushedFilters: [IsNotNull(transcript_id), IsNotNull(turn_index)" in text
    text = plan(entry.queries()["case_stats"](spark, data))
    assert "opinion_announcements" in text and "href" not in text.split("ReadSchema")[0].split("Batched")[0]


def test_latest_rows_are_cut_down_before_the_shuffle(spark, data):
    text = plan(entry.queries()["justice_flag"](spark, data))
    assert text.count("WindowGroupLimit") == 2
