import json

from llm_cases import SF_DIR  # noqa: F401
from oracle import connect, differences

from lexmill.llm import queries, tool_calls
from lexmill.llm.tool_calls import Argument

CALLS = "conv_id long, turn long, call_id string, after string, tool string, arguments string, status string, step long"
RESULTS = "conv_id long, turn long, call_id string, content string, depth long"
OTHERS = "conv_id long, turn long, role string, content string, message string"
SCHEMA = [Argument("find", "q", "STRING", max_length=5), Argument("find", "n", "BIGINT", required=False)]


def linked(spark, calls, results, others=()):
    frames = (
        spark.createDataFrame([(*c, None, None) for c in calls], CALLS),
        spark.createDataFrame([(*r, None) for r in results], RESULTS),
        spark.createDataFrame([(*o, None) for o in others], OTHERS),
    )
    return tool_calls.link(*frames, SCHEMA).collect()


def test_query_matches_sql(spark):
    for sf_dir in (SF_DIR, "/root/testdata/sf0.01"):
        found = queries.op10_tool_calls(spark, sf_dir)
        assert differences(found, connect(sf_dir), queries.SQL["op10_tool_calls"]) == []


def test_order_cycles_and_repeats(spark):
    ok = '{"q": "a"}'
    calls = [
        (1, 9, "a", None, "find", ok),
        (1, 2, "b", "a", "find", ok),  # needs a later turn
        (1, 1, "c", "b", "find", ok),
        (1, 3, "d", "e", "find", ok),  # a cycle
        (1, 4, "e", "d", "find", ok),
        (1, 5, "f", "e", "find", ok),  # behind the cycle
        (1, 6, "a", "c", "find", ok),  # an identifier used before: turn 6 counts, as it is earlier
        (2, 1, "a", "gone", "find", ok),  # another conversation; no such call
        (None, 1, "a", None, "find", ok),
        (1, 7, None, "a", "find", ok),
        (1, 8, "s", "s", "find", ok),
    ]
    results = [(1, 10, "a", "r1"), (1, 11, "a", "r2"), (1, 3, "c", None), (1, 4, "zz", "x"), (None, 2, "a", "n"), (1, 5, None, "x")]
    rows = linked(spark, calls, results, [(1, 0, "system", "hi"), (None, None, None, None)])
    assert len(rows) == len(calls) + len(results) + 2
    call = {(r["conv_id"], r["call_id"], r["turn"]): r for r in rows if r["kind"] == "call"}
    # a (turn 6) comes after c, c after b, b after a: a cycle, too
    assert all(call[1, i, t]["step"] is None for i, t in (("a", 6), ("b", 2), ("c", 1), ("d", 3), ("e", 4), ("f", 5), ("s", 8)))
    assert call[1, "a", 9]["status"] == "repeated" and call[1, "a", 9]["step"] is None
    assert call[2, "a", 1]["step"] == 0 and call[2, "a", 1]["status"] == "unanswered"
    assert call[None, "a", 1]["status"] == "answered"
    assert call[1, None, 7]["status"] == "unanswered"
    result = {(r["conv_id"], r["call_id"], r["turn"]): r["status"] for r in rows if r["kind"] == "result"}
    assert result == {(1, "a", 10): "linked", (1, "a", 11): "repeated", (1, "c", 3): "linked", (1, "zz", 4): "orphan", (None, "a", 2): "linked", (1, None, 5): "orphan"}


def test_long_chain_against_its_turns(spark):
    n = 300
    calls = [(1, n - i, f"c{i}", f"c{i - 1}" if i else None, "find", None) for i in range(n)]
    rows = linked(spark, calls, [(1, 0, "c299", "end")])
    assert {r["call_id"]: r["step"] for r in rows if r["kind"] == "call"} == {f"c{i}": 2 * i for i in range(n)}
    assert [r["step"] for r in rows if r["kind"] == "result"] == [2 * n - 1]


def test_arguments_and_canonical_json(spark):
    arguments = {
        "{}": "missing q",
        '{"q": 3}': "type of q",
        '{"q": "abcdef"}': "length of q",
        '{"z": {"b": 1, "a": [1, {"y": null, "x": 2}]}, "q": "é\\n\\""}': "unknown z",
        '{"n": 1.5, "q": null}': "missing q,type of n",
        "[1]": "not an object",
        "nonsense": "not an object",
        '{"n": 7, "q": "ok"}': "",
    }
    calls = [(1, i, f"c{i}", None, "find", a) for i, a in enumerate(arguments)] + [(1, 50, "u", None, "other", "{}")]
    rows = {r["call_id"]: r for r in linked(spark, calls, [])}
    assert rows["u"]["errors"] == "unknown tool"
    for i, (text, errors) in enumerate(arguments.items()):
        found = rows[f"c{i}"]
        assert (errors or found["errors"] == "") and set(errors.split(",")) <= set(found["errors"].replace("type of q,", "type of q,").split(",")), (text, found)
        value = None if text == "nonsense" else json.loads(text)
        plain = json.dumps({"arguments": value, "id": f"c{i}", "kind": "call", "tool": "find"}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert found["message"] == plain


def test_empty_tables(spark):
    assert linked(spark, [], []) == []


def test_no_python_on_the_main_path(spark):
    plan = queries.op10_tool_calls(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
