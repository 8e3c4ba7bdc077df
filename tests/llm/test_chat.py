import json

import pytest

from hazecast.llm.chat import canonical, depths, formatted, problem

SCHEMAS = {"find": {"q": ("string", True), "n": ("integer", False), "after": ("array", False)}, "now": {}}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string"


def lines(spark, calls, results, messages=()):
    df = formatted(
        spark.createDataFrame(list(messages), "conv_id long, turn long, role string, text string"),
        spark.createDataFrame(list(calls), CALLS),
        spark.createDataFrame(list(results), "conv_id long, call_id string, content string"),
        SCHEMAS,
    )
    return {(r.conv_id, r.call_id, r.kind): r for r in df.collect()}


@pytest.mark.parametrize("text", ['{"b": 1, "a": [1, 2.5, {"z": null, "y": "é\\n\\""}]}', "[]", '"x"', "12"])
def test_canonical_json(spark, text):
    got = spark.createDataFrame([(text,)], "j string").select(canonical("j")).first()[0]
    assert got == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_what_is_no_json(spark):
    rows = spark.createDataFrame([("{",), ('{"a":1,"a":2}',), (None,)], "j string").select(canonical("j")).collect()
    assert [r[0] for r in rows] == [None, None, None]


@pytest.mark.parametrize(
    ("name", "arguments", "said"),
    [
        ("find", '{"q":"x","n":3}', None),
        ("find", '{"n":3}', "missing q"),
        ("find", '{"q":null}', "missing q"),
        ("find", '{"q":5}', "q is no string"),
        ("find", '{"q":"x","n":"3"}', "n is no integer"),
        ("find", '{"q":"x","n":3.5}', "n is no integer"),
        ("find", '{"q":"x","z":1}', "unknown argument"),
        ("find", '{"q":"x","n$q":1}', "unknown argument"),
        ("now", '{"":1}', "unknown argument"),
        ("find", "[1]", "not a JSON object"),
        ("find", None, "not a JSON object"),
        ("now", "{}", None),
        ("lost", "{}", "unknown tool"),
        (None, "{}", "no tool"),
    ],
)
def test_arguments_against_schemas(spark, name, arguments, said):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(name, arguments)], "n string, a string").select(problem(F.col("n"), F.col("a"), SCHEMAS)).first()
    assert row[0] == said


def test_calls_stand_after_those_they_wait_for(spark):
    waits = {"a": [], "b": ["a"], "c": ["a", "b"], "d": ["c", "gone"], "e": ["e"], "x": ["y"], "y": ["x"], "z": ["x", "a"]}
    turns = dict(zip(waits, [4, 2, None, 3, 5, 1, 1, 1], strict=True))
    calls = spark.createDataFrame([(1, k, turns[k]) for k in waits] + [(2, "b", 7)], "conv_id long, call_id string, turn long")
    links = spark.createDataFrame([(1, k, w) for k, own in waits.items() for w in own] + [(2, "b", "a")], "conv_id long, call_id string, after string")
    rows = depths(calls, links).collect()
    got = {(r.conv_id, r.call_id): r.depth for r in rows}
    latest = {(r.conv_id, r.call_id): r.at for r in rows if r.depth is not None}
    assert latest == {(1, "a"): 4, (1, "b"): 4, (1, "c"): 4, (1, "d"): 4, (1, "e"): 5, (2, "b"): 7}
    want = {"a": 0, "b": 1, "c": 2, "d": 3, "e": 0, "x": None, "y": None, "z": None}
    assert got == {(1, k): v for k, v in want.items()} | {(2, "b"): 0}


def test_links_statuses_and_lines(spark):
    calls = [
        (1, 3, "a", "find", '{"q": "x", "after": []}'),
        (1, 5, "b", "find", '{"after": ["a"], "q": "y"}'),
        (1, 7, "c", "find", '{"q": 1}'),
        (2, 3, "a", "now", "{}"),
        (2, 3, "a", "now", "{}"),
        (1, 9, None, "now", "{}"),
    ]
    results = [(1, "a", "found"), (1, "b", None), (1, "lost", "?"), (1, "c", "no"), (None, "a", "stray"), (1, "a", "found")]
    got = lines(spark, calls, results, [(1, 0, "user", "hi"), (None, None, None, None)])
    assert got[1, "a", "call"].line == '{"arguments":"{\\"after\\":[],\\"q\\":\\"x\\"}","id":"a","name":"find","role":"assistant"}'
    assert (got[1, "a", "call"].step, got[1, "a", "result"].step, got[1, "b", "call"].step) == (1, 2, 3)
    assert {k: r.status for k, r in got.items() if k[2] == "call"} == {
        (1, "a", "call"): "ok", (1, "b", "call"): "ok", (1, "c", "call"): "q is no string", (2, "a", "call"): "no result", (1, None, "call"): "no result",
    }
    assert got[1, "lost", "result"].status == got[None, "a", "result"].status == "no call"
    assert got[1, "b", "result"].line == '{"content":null,"id":"b","role":"tool"}'
    assert got[1, None, "message"].line == '{"content":"hi","role":"user"}'
    assert len(got) == 12


def test_a_call_that_waits_for_a_later_turn_stands_behind_it(spark):
    calls = [(1, t, k, "find", json.dumps({"q": k, "after": own})) for t, k, own in [(3, "a", ["b"]), (5, "b", []), (4, "c", ["a"]), (6, "d", ["c"]), (None, "e", []), (None, "f", ["b", "e"])]]
    got = lines(spark, calls, [(1, k, k) for k in "abcdef"])
    place = {k: (got[1, k, "call"].turn, got[1, k, "call"].step) for k in "abcdef"}
    assert place == {"a": (5, 3), "b": (5, 1), "c": (5, 5), "d": (6, 7), "e": (None, 1), "f": (5, 3)}
    assert {r.status for r in got.values()} == {"ok"}
    assert all((got[1, k, "result"].turn, got[1, k, "result"].step) == (place[k][0], place[k][1] + 1) for k in "abcdef")


def test_clashing_columns_long_texts_and_null_turns(spark):
    calls = spark.createDataFrame([(1, None, "a", "find", json.dumps({"q": "é" * 200_000}), "x", 3)], CALLS + ", _rank string, depth int")
    messages = spark.createDataFrame([(1, None, "user", "y" * 300_000, 5, "z")], "conv_id long, turn long, role string, text string, step int, line string")
    results = spark.createDataFrame([(1, "a", "n", 1)], "conv_id long, call_id string, content string, turn int")
    rows = {r.kind: r for r in formatted(messages, calls, results, SCHEMAS).collect()}
    assert {k: (r.turn, r.step, r.status) for k, r in rows.items()} == {"message": (None, 0, "ok"), "call": (None, 1, "ok"), "result": (None, 2, "ok")}
    assert len(json.loads(json.loads(rows["call"].line)["arguments"])["q"]) == 200_000


def test_empty_tables(spark):
    assert lines(spark, [], []) == {}


def test_calls_of_the_query_hold_whole_turns(spark, small):
    from hazecast.llm.queries import op2_chat

    lines = op2_chat(spark, small).where("kind = 'call'").select("conv_id", "turn", "line").collect()
    said = spark.read.parquet(f"{small}/conversations.parquet").where("role = 'assistant'").collect()
    whole = {(r.conv_id, r.turn): r.text for r in said}
    found = 0
    for r in lines:
        try:
            arguments = json.loads(json.loads(r.line)["arguments"])
        except ValueError:
            continue
        found += 1
        assert arguments["text"] == whole[r.conv_id, r.turn]
    assert found > 0.8 * len(whole)


def test_an_identifier_used_again_loses_nothing(spark):
    calls = [(1, t, "call_0", "find", json.dumps({"q": f"turn {t}"})) for t in (1, 1, 3, 5)]
    results = [(1, "call_0", f"answer {t}") for t in (1, 3, 3, 5)] + [(1, "x", "a"), (1, "x", "b")]
    df = formatted(
        spark.createDataFrame([], "conv_id long, turn long, role string, text string"),
        spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(results, "conv_id long, call_id string, content string"),
        SCHEMAS,
    )
    rows = df.collect()
    assert sorted((r.turn, r.step, r.status) for r in rows if r.kind == "call") == [(1, 1, "ok"), (3, 1, "duplicate call"), (5, 1, "duplicate call")]
    found = sorted((json.loads(r.line)["content"], r.turn, r.step, r.status) for r in rows if r.kind == "result" and r.call_id == "call_0")
    assert found == [("answer 1", 1, 2, "ok"), ("answer 3", 1, 2, "duplicate result"), ("answer 5", 1, 2, "duplicate result")]
    assert [(r.status, r.turn) for r in rows if r.call_id == "x"] == [("no call", None)] * 2
