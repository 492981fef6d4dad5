"""Nearest neighbours against all inner products; chat formatting."""

import json

import numpy as np
import pytest

from tablefold.llm import chat, neighbours


def brute(rows, k):
    out = []
    for q, v in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out += [(q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("dims, n", [(64, 700), (3, 60), (1, 25)])
def test_search_equals_brute_force(spark, dims, n):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(n, dims)) * rng.choice([0.1, 1, 5], (n, 1))
    vectors[5:15] = vectors[4]  # ties
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    bad = [(n + 1, None), (n + 2, []), (n + 3, [0.0] * dims), (n + 4, [float("nan")] * dims), (n + 5, [float("inf")] * dims), (n + 6, [None] * dims), (None, rows[1][1]), rows[7]]
    df = spark.createDataFrame([(i, v, 0.0) for i, v in rows + bad], "vec_id bigint, embedding array<float>, score double")
    index = neighbours.indexed(df)
    got = neighbours.search(index, index.filter("vec_id % 20 = 0"), query_block=16, data_block=100).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == brute(rows, 20)


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0])], "vec_id bigint, embedding array<double>")
    index = neighbours.indexed(few)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(index, index.filter("vec_id = 0")).collect()] == [(0, 1, 1, 4.0)]
    none = neighbours.indexed(few.limit(0))
    assert neighbours.search(none, none).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    turn = neighbours.rotation(64, 512)
    guess, error = neighbours.estimates(*neighbours.codes(x, turn), q, turn)
    exact = (q / np.linalg.norm(q, axis=1)[:, None]) @ x.T
    assert (np.abs(guess - exact) <= error).mean() > 0.99 and np.abs(guess - exact).mean() < 0.3 * error.mean()


SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": ["string", "null"]}}}}}


def call(i, arguments, needs=None, name="add"):
    return (i, name, arguments, needs)


def test_linking_order_and_validation(spark):
    rows = [
        (1, 0, "user", "hi é\n", None, None),
        (1, 1, "assistant", None, [call("y", '{"b": ["s", null], "a": 1}', ["x"]), call("x", '{"a":-1}'), call("z", "{nope", ["y", "unknown"])], None),
        (1, 2, "tool", "rx", None, "x"), (1, 3, "tool", "ry", None, "y"), (1, 4, "tool", "lost", None, "w"), (1, 5, "tool", "again", None, "x"),
        (1, 6, "assistant", "", [call("x", '{"a":5}'), call("p", '{"a":1e999}', ["q"]), call("q", '{"a":true}', ["p"]), call("t", "{}", name="mul"), call(None, "{}")], None),
        (2, 0, None, None, None, None), (None, 0, "assistant", "n", [call("x", "{}")], None), (None, 1, "tool", "n", None, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, content string, calls array<struct<call_id:string,name:string,arguments:string,needs:array<string>>>, call_id string")
    got = chat.format_chats(df, SCHEMAS).collect()
    status = {}
    for r in got:
        status.setdefault((r.conv_id, r.call_id, r.part), []).append((r.status, r.depth))
    assert status[1, "x", 1] == [("invalid", 0)] and status[1, "y", 1] == [("linked", 1)] and status[1, "z", 1] == [("invalid", 2)]
    assert status[1, "p", 1] == [("cyclic", None)] and status[1, "q", 1] == [("cyclic", None)] and status[1, "t", 1] == [("invalid", 0)]
    assert status[1, "x", 2] == [("result", 0)] and status[1, "w", 2] == [("orphan", None)]
    assert status[1, "x", 3] == [("repeated", None)] and status[1, "x", 4] == [("repeated", None)]
    assert status[1, None, 3] == [("unlinked", None)] and status[None, "x", 3] == [("unlinked", None)] and status[None, "x", 2] == [("orphan", None)]
    text = {(r.conv_id, r.call_id, r.part): r.json for r in got}
    assert text[1, "y", 1] == '{"arguments":{"a":1,"b":["s",null]},"id":"y","name":"add"}'
    assert text[1, "x", 2] == '{"call_id":"x","content":"rx","role":"tool"}' and text[2, None, 0] == '{"content":null,"role":null}'
    assert {r.json for r in got if r.status == "message"} >= {'{"content":"hi é\\n","role":"user"}'}
    problems = {r.call_id: r.problems for r in got if r.status == "invalid"}
    assert problems == {"x": ["$.a: below minimum"], "z": ["$: not JSON"], "t": ["$: unknown tool mul"]}
    assert len(got) == 5 + (6 + 3) + (2 + 2 + 1)  # messages, calls, results
    for r in got:
        assert chat.canonical(json.loads(r.json)) == r.json
    assert chat.format_chats(df.limit(0), SCHEMAS).count() == 0


def test_deep_chains_and_a_long_conversation(spark):
    links = [(1, f"c{i}", [f"c{i - 1}"] if i else None) for i in range(12)] + [(1, f"d{i}", ["c3", "c3"]) for i in range(300)]
    df = spark.createDataFrame(links, "conv_id bigint, call_id string, needs array<string>")
    got = {r.call_id: r.depth for r in chat.depths(df).collect()}
    assert got == {f"c{i}": i for i in range(12)} | {f"d{i}": 4 for i in range(300)}
    with pytest.raises(ValueError):
        chat.depths(df, max_depth=3).count()


def test_chains_of_any_depth(spark):
    links = [(1, f"c{i}", [f"c{i - 1}", "c0"] if i else None) for i in range(70)] + [(1, "p", ["q", "c3"]), (1, "q", ["p"]), (1, "behind", ["p"]), (2, "c1", ["c0"])]
    df = spark.createDataFrame(links, "conv_id bigint, call_id string, needs array<string>")
    got = {(r.conv_id, r.call_id): r.depth for r in chat.depths(df).collect()}
    assert got == {(1, f"c{i}"): i for i in range(70)} | {(1, "p"): None, (1, "q"): None, (1, "behind"): None, (2, "c1"): 0}


def test_problems():
    schema = {"type": "object", "properties": {"s": {"type": "string", "minLength": 2, "maxLength": 3, "enum": ["ab", "abcd"]}, "n": {"type": "number", "maximum": 2}}}
    assert chat.problems({"s": "abcd", "n": 3}, schema) == ["$.n: above maximum", "$.s: too long"]
    assert chat.problems({"s": "a", "n": True}, schema) == ["$.n: not number", "$.s: not in enum", "$.s: too short"]
