import json

import pytest
from lakehist.llm import chat
from lakehist.llm.chat import SCHEMAS, Field, calls_of, levels, linked, plain_of
from lakehist.llm.queries import QUERIES

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after string"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = {"f": {"b": Field("integer", least=0, most=9), "a": Field("string", required=False)}, "g": {"x": Field("number"), "o": Field("object", required=False), "l": Field("array", required=False), "t": Field("boolean", required=False)}}


def events(spark, calls, results, schemas=TOOLS):
    rows = linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas).collect()
    return [r.asDict() for r in rows]


def test_linking_and_order(spark):
    found = events(
        spark,
        [
            (1, 5, "c", "f", '{"b": 1}', "b"),
            (1, 0, "b", "f", '{"b": 1}', "a"),  # earlier turn, but it needs a
            (1, 3, "a", "f", '{"b": 1}', None),
            (1, 9, "lost", "f", '{"b": 1}', "nowhere"),
            (2, 1, "x", "f", '{"b": 1}', "y"),
            (2, 2, "y", "f", '{"b": 1}', "x"),
            (2, 3, None, "f", '{"b": 1}', None),
            (2, 4, "self", "f", '{"b": 1}', "self"),
        ],
        [(1, 4, "a", "one"), (1, 4, "a", "zwei"), (1, 8, "a", "one"), (1, 1, "b", None), (1, 6, "who", "?"), (2, 7, None, "?"), (1, 7, "lost", "x")],
    )
    told = [(r["conv_id"], r["level"], r["kind"], r["call_id"], r["status"]) for r in found]
    assert [t for t in told if t[0] == 1 and t[2] == 0] == [
        (1, 0, 0, "a", "linked"), (1, 0, 0, "lost", "dangling"), (1, 1, 0, "b", "linked"), (1, 2, 0, "c", "unanswered"),
    ]
    assert {t[3]: t[4] for t in told if t[0] == 2 and t[2] == 0} == {"x": "cyclic", "y": "cyclic", None: "unanswered", "self": "cyclic"}
    answers = [(r["call_id"], r["turn"], r["status"]) for r in found if r["kind"] == 1]
    assert sorted(answers, key=str) == sorted(
        [("a", 4, "linked"), ("a", 4, "repeated"), ("a", 8, "repeated"), ("b", 1, "linked"), ("who", 6, "orphan"), (None, 7, "orphan"), ("lost", 7, "linked")], key=str
    )


def test_repeated_calls_share_the_result(spark):
    found = events(spark, [(1, 0, "a", "f", '{"b":1}', None)] * 300, [(1, 1, "a", "r")] * 300)
    assert len(found) == 600 and {r["status"] for r in found} == {"linked"}


@pytest.mark.parametrize(
    ("name", "arguments", "wrong"),
    [
        ("f", '{"b": 3, "a": "x"}', []),
        ("f", '{"a": 1}', ["missing b", "type of a"]),
        ("f", '{"b": null}', ["missing b"]),
        ("f", '{"b": 1.5}', ["type of b"]),
        ("f", '{"b": 10, "z": 0}', ["b too large", "unknown z"]),
        ("f", '{"b": -1}', ["b too small"]),
        ("g", '{"x": 1.5, "o": {}, "l": [], "t": true}', []),
        ("g", '{"x": 1e300, "o": [], "l": {}, "t": 0}', ["type of l", "type of o", "type of t"]),
        ("h", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
        ("f", "[1]", ["malformed"]),
        ("f", "nonsense", ["malformed"]),
        ("f", "", ["malformed"]),
        ("f", None, ["malformed"]),
    ],
)
def test_validation(spark, name, arguments, wrong):
    (found,) = events(spark, [(1, 0, "a", name, arguments, None)], [])
    assert sorted(found["problems"]) == wrong
    body = json.loads(found["json"])
    assert body["id"] == "a" and body.get("name") == name
    if wrong != ["malformed"]:
        assert body["arguments"] == json.loads(arguments)


def test_json_is_canonical(spark):
    one, two = events(spark, [(1, 0, "a", "f", '{ "b" : 1,\n "a":"é \\u0041 \\" \\\\ /" }', None), (1, 1, "b", "f", '{"a":"é A \\" \\\\ /","b":1}', None)], [])
    assert one["json"] == '{"arguments":{"a":"é A \\" \\\\ /","b":1},"id":"a","name":"f","role":"call","turn":0}'
    assert json.loads(one["json"])["arguments"] == json.loads(two["json"])["arguments"]


def test_long_chains(spark):
    calls = [(1, i, f"c{i}", "f", "{}", f"c{i - 1}" if i else None) for i in range(150)]
    found = levels(spark.createDataFrame(calls, CALLS)).collect()
    assert {r["call_id"]: r["level"] for r in found} == {f"c{i}": i for i in range(150)}


def test_turns_as_calls(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = linked(*calls_of(turns.withColumn("status", turns.role)), SCHEMAS).collect()
    held = turns.where("role IN ('user', 'assistant')").collect()
    assert len(rows) == len(held)
    roles = {(r["conv_id"], r["turn"]): r["role"] for r in held}
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in held}
    for r in rows:
        key = r["conv_id"], r["turn"]
        assert roles[key] == ("assistant" if r["kind"] else "user")
        body = json.loads(r["json"])
        said = body["content"] if r["kind"] else body["arguments"].get("text", body["arguments"].get("query"))
        assert said == texts[key]
        if not r["kind"] and r["turn"] < 2:
            answered = roles.get((r["conv_id"], r["turn"] + 1)) == "assistant"
            assert r["level"] == 0 and r["status"] == ("linked" if answered else "unanswered")


def test_nulls_and_nothing(spark):
    odd = spark.createDataFrame([(None, None, "user", None), (1, None, "user", "x"), (None, 3, "assistant", None), (1, 1, None, "x")], "conv_id long, turn long, role string, text string")
    assert len(linked(*calls_of(odd), SCHEMAS).collect()) == 3
    assert linked(*calls_of(odd.limit(0)), SCHEMAS).collect() == []


def test_no_turn_is_left_out(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert turns.where("role = 'system'").count() > 0
    rows = QUERIES["op7_conversations"](spark, sf_dir).collect()
    assert sorted((r["conv_id"], r["turn"]) for r in rows) == sorted((r["conv_id"], r["turn"]) for r in turns.collect())
    assert len([r for r in rows if r["kind"] < 2]) == QUERIES["op7_tool_calls"](spark, sf_dir).count()


def test_plain_turns(spark):
    said = [(1, 0, "system", 'be "kind"'), (1, 1, "user", "x"), (1, 2, "tool", None), (1, 3, None, "y"), (None, None, None, None)]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    found = linked(*calls_of(turns), SCHEMAS, plain_of(turns)).collect()
    assert len(found) == 5
    plain = {r["turn"]: r for r in found if r["kind"] == 2}
    assert {t: r["json"] for t, r in plain.items()} == {
        0: '{"content":"be \\"kind\\"","role":"system","turn":0}',
        2: '{"content":"","role":"tool","turn":2}',
        3: '{"content":"y","turn":3}',
        None: '{"content":""}',
    }
    assert {(r["level"], r["status"], r["call_id"]) for r in plain.values()} == {(0, "plain", None)}


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_a_call_that_a_third_of_all_others_come_after(spark, monkeypatch, size):
    """Many calls after one, many after none, and many results of one: the same at any number of salts."""
    monkeypatch.setattr(chat, "ROWS_PER_SALT", size)
    calls = [(1, 0, "hot", "f", '{"b":1}', None)] + [(1, i, f"a{i}", "f", '{"b":1}', "hot") for i in range(1, 60)]
    calls += [(2, i, f"n{i}", "f", '{"b":1}', None) for i in range(60)] + [(3, i, f"c{i}", "f", '{"b":1}', f"a{i}") for i in range(1, 20)]
    calls += [(4, 0, "l", "f", '{"b":1}', "nowhere"), (4, 1, None, "f", '{"b":1}', "hot")]
    results = [(1, 100 + i, "hot", f"r{i}") for i in range(50)] + [(3, 200, "c3", "x")]
    found = events(spark, calls, results)
    assert len(found) == len(calls) + len(results)
    level = {r["call_id"]: r["level"] for r in found if r["kind"] == 0}
    assert all(level[f"a{i}"] == 1 for i in range(1, 60)) and all(level[f"n{i}"] == 0 for i in range(60)) and level["c7"] == 2
    assert [r["status"] for r in found if r["call_id"] == "l"] == ["dangling"]
    assert sorted(r["status"] for r in found if r["kind"] == 1) == ["linked"] * 2 + ["repeated"] * 49


def test_further_columns_are_ignored(spark):
    calls = spark.createDataFrame([(1, 0, "a", "f", '{"b":1}', None)], CALLS)
    results = spark.createDataFrame([(1, 1, "a", "r")], RESULTS)
    plain = linked(calls, results, TOOLS).collect()
    more = calls.selectExpr("*", "9 AS level", "'x' AS _salt", "true AS answered", "'y' AS parsed")
    assert linked(more, results.selectExpr("'z' AS answer", "*", "1 AS dangling"), TOOLS).collect() == plain
