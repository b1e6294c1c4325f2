import json

from attesta.llm.tool_calls import TURN_SCHEMAS, argument_errors, link_tool_calls, turns_as_calls

CALLS, RESULTS = "conv_id long, call_id string, ord long, name string, arguments string, after string", "conv_id long, call_id string, ord long, content string"
SCHEMAS = {"add": {"a": ("number", True), "b": ("integer", False), "s": ("string", False), "f": ("boolean", False), "o": ("object", False), "l": ("array", False)}, "none": {}}


def test_arguments_against_schemas(spark):
    cases = [
        ("add", '{"a": 1}', []), ("add", '{"a": 1.5, "b": 2, "s": "x", "f": true, "o": {"k": 1}, "l": []}', []), ("add", "{}", ["missing:a"]), ("add", '{"a": "1", "b": 1.5, "s": 1, "f": 0, "o": [], "l": {}}', ["type:a", "type:b", "type:f", "type:l", "type:o", "type:s"]),
        ("add", '{"a": null}', ["type:a"]), ("add", '{"a": 1, "z": 1, "y": 2}', ["unknown:y", "unknown:z"]), ("add", "nonsense", ["not_json"]), ("add", None, ["not_json"]), ("add", "[1]", ["not_an_object"]), ("sub", "{}", ["unknown_tool"]), ("none", "{}", []), ("none", '{"x": 1}', ["unknown:x"]), ("add", '{"b": true, "a": 1}', ["type:b"]),
    ]
    df = spark.createDataFrame([(i, n, a) for i, (n, a, _) in enumerate(cases)], "i int, name string, arguments string")
    got = {r.i: r.e for r in df.select("i", argument_errors(df.name, df.arguments, SCHEMAS).alias("e")).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, _, want in cases]


def link(spark, calls, results, schemas=SCHEMAS, **more):
    return link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas, **more).collect()


def test_links_order_and_json(spark):
    chain = [(1, f"c{i}", i, "add", '{"b": 2, "a": 1, "o": {"z": 1, "y": "é\\n"}}', f"c{i - 1}" if i else None) for i in range(40)]
    odd = [(1, "loop1", 50, "add", '{"a": 1}', "loop2"), (1, "loop2", 51, "add", '{"a": 1}', "loop1"), (1, "tail", 52, "add", '{"a": 1}', "loop1"), (1, "self", 53, "add", '{"a": 1}', "self"), (1, "lost", 54, "add", "{bad", "gone"), (1, None, 55, "add", '{"a": 1}', None), (1, None, 55, "add", '{"a": 1}', None)]
    rows = link(spark, [*chain, *odd, chain[3], (2, "c3", 99, "none", "{}", None)], [(1, "c3", 1, "x"), (1, "c3", 2, "y"), (1, "c4", 3, None), (1, "who", 4, "o"), (1, None, 5, "n")], by_conversation=False)
    depth = {r.call_id: r.depth for r in rows if r.status != "orphan_result"}
    assert all(depth[f"c{i}"] == i for i in range(40)) and depth["lost"] == 0 and [depth[k] for k in ("loop1", "loop2", "tail", "self")] == [None] * 4
    assert len(rows) == 40 + 7 + 1 + 2
    assert sorted((str(r.call_id), r.result_ord) for r in rows if r.status == "orphan_result") == [("None", 5), ("who", 4)]
    linked = sorted(((r.call_id, r.result_ord, json.loads(r.json)["result"]) for r in rows if r.status == "linked"), key=str)
    assert linked == [("c3", 1, "x"), ("c3", 2, "y"), ("c4", 3, None)]
    text = next(r.json for r in rows if r.call_id == "c5")
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(text) == {"after": "c4", "arguments": {"a": 1, "b": 2, "o": {"y": "é\n", "z": 1}}, "id": "c5", "name": "add", "result": None}
    assert json.loads(next(r.json for r in rows if r.call_id == "lost"))["arguments"] == "{bad"


def test_empty_tables(spark):
    assert link(spark, [], []) == []
    assert [r.status for r in link(spark, [], [(1, "a", 1, "x")])] == ["orphan_result"]


def test_turns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = link_tool_calls(*turns_as_calls(df), TURN_SCHEMAS).collect()
    turns = {(r.conv_id, r.turn): r for r in df.collect()}
    assert len(rows) >= sum(r.role != "assistant" for r in turns.values())
    for r in rows:
        if r.status != "orphan_result":
            got, turn = json.loads(r.json), turns[r.conv_id, r.ord]
            assert r.errors == [] and got["arguments"] == {"chars": len(turn.text), "text": turn.text, "turn": turn.turn}
            after = turns.get((r.conv_id, r.ord + 1))
            assert got["result"] == (after.text if after and after.role == "assistant" else None)
    odd = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (None, 1, "assistant", "x"), (2, None, None, "y"), (3, 0, "robot", "z" * 100_000)], df.schema)
    got = link_tool_calls(*turns_as_calls(odd), TURN_SCHEMAS).collect()
    assert sorted((str(r.call_id), r.status, tuple(r.errors or ())) for r in got) == [("1-0", "no_result", ("missing:chars", "missing:text")), ("3-0", "no_result", ("unknown_tool",)), ("None", "no_result", ("unknown_tool",)), ("None", "orphan_result", ())]


def test_the_main_path_is_native(spark, sf_dir):
    df = link_tool_calls(*turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TURN_SCHEMAS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExternalRDD"))
