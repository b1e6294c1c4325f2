"""Calls whose ids restart in each conversation, or repeat within one."""

from attesta.llm.queries import ORACLES, call_argument_errors, op10_tool_calls
from attesta.llm.tool_calls import link_tool_calls

CALLS, RESULTS = "conv_id long, call_id string, ord long, name string, arguments string, after string", "conv_id long, call_id string, ord long, content string"


def test_ids_hold_within_their_conversation(spark):
    calls = [(1, "a", 0, "f", "{}", None), (1, "b", 1, "f", "{}", "a"), (2, "a", 0, "f", "{}", None), (2, "a", 3, "f", "[]", None), (2, "a", 3, "f", "[]", None), (None, "a", 5, "f", "{}", None), (2, "b", 6, "f", "{}", "gone")]
    results = [(1, "a", 9, "x"), (2, "a", 9, "y"), (None, "a", 9, "z"), (3, "a", 9, "o")]
    rows = link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), {"f": {}}).collect()
    got = sorted(((r.conv_id, r.call_id, r.ord, r.depth, r.status) for r in rows), key=str)
    assert got == sorted([(1, "a", 0, 0, "linked"), (1, "b", 1, 1, "no_result"), (2, "a", 0, 0, "linked"), (2, "a", 3, None, "duplicate_id"), (None, "a", 5, 0, "linked"), (2, "b", 6, 0, "no_result"), (3, "a", None, None, "orphan_result")], key=str)
    assert all('"id":"a"' in r.json for r in rows if r.status == "linked")
    assert {(r.conv_id, r.json.split('"result":')[1]) for r in rows if r.status == "linked"} == {(1, '"x"}'), (2, '"y"}'), (None, '"z"}')}


def test_the_query_keeps_different_turns_of_one_number(spark, tmp_path):
    rows = [(1, 0, "user", "hello"), (1, 0, "user", "other"), (1, 0, "user", "other"), (1, 1, "assistant", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted(r.status for r in op10_tool_calls(spark, str(tmp_path)).collect()) == ["duplicate_id", "linked"]


def test_argument_errors_from_data(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    want = sorted(con.execute(ORACLES["call_argument_errors"]).fetchall())
    assert sorted(map(tuple, call_argument_errors(spark, sf_dir).collect())) == want
    found = {e for r in want for e in r[2].split(";")}
    assert {"type:chars", "missing:text", "unknown:note", "unknown_tool"} <= found
