import duckdb

import __spark_entry__ as entry
from turnmill.llm import queries as Q


def test_groups_match_sql(spark, data):
    con = duckdb.connect()
    for t in ("turns", "transcripts", "bench"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    want = sorted(con.execute(Q.ORACLES["p5_found"]).fetchall())
    assert sorted((r.group_id, r.transcript_id) for r in Q.p5_found(spark, data).collect()) == want


def test_columns(spark, data):
    want = {"p1_found": ["transcript_id", "turn_index", "end_char"], "p4_found": ["transcript_id", "turn_index", "cut"], "p5_found": ["group_id", "transcript_id"],
            "p7_found": ["transcript_id", "turn_index", "item", "pos_a", "pos_b"], "p10_found": ["doc_id", "start_char", "end_char", "kind"]}
    for name, cols in want.items():
        df = entry.queries()[name](spark, data)
        assert df.columns == cols and df.count() > 0


def test_no_cross_joins(spark, data):
    for name in ("p1_found", "p4_pieces", "p5_splits", "p7_found", "p8_containers", "p9_shares", "p10_found"):
        text = Q.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_whole_results_match_sql(spark, data):
    """Cover and limits of pieces, cases in one split, containers, shares."""
    con = duckdb.connect()
    for t in ("turns", "transcripts", "documents", "size_limits", "mix_targets"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    for name in ("p4_cover", "p5_together", "p8_whole", "p9_bounds"):
        got = Q.QUERIES[name](spark, data)
        cur = con.execute(Q.ORACLES[name])
        want = [dict(zip([c[0] for c in cur.description], r)) for r in cur.fetchall()]
        assert sorted(map(repr, (sorted(r.asDict().items()) for r in got.collect()))) == sorted(map(repr, (sorted(r.items()) for r in want))), name
