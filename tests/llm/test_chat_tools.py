import json
import random

import pytest

from mercato.llm import chat_tools as C
from tests.conftest import SF_CHECK, SF_SMALL

SCHEMAS = {"add": {"type": "object", "required": ["a", "b"], "properties": {
    "a": {"type": "number"}, "b": {"type": "integer", "minimum": 0}, "how": {"enum": ["up", "down"]}}, "additionalProperties": False},
    "any": {"type": "object"}}


@pytest.mark.parametrize("value,error", [
    ({"a": 1.5, "b": 2}, None), ({"a": 1, "b": 2.0}, None), ({"a": 1}, "required:/b"), ({"a": "x", "b": 1}, "type:/a"),
    ({"a": True, "b": 1}, "type:/a"), ({"a": 1, "b": -1}, "range:/b"), ({"a": 1, "b": 1, "c": 0}, "unknown:/c"),
    ({"a": {"$ref": "x"}, "b": {"$ref": "y"}}, None), ({"a": 1, "b": 1, "how": "left"}, "enum:/how")])
def test_schema(value, error):
    assert C.schema_error(value, SCHEMAS["add"]) == error


def test_canonical_arguments():
    assert C.checked_arguments("any", '{"b": [1, 2.50], "a": "é\\u0041\\n"}', SCHEMAS) == ('{"a":"éA\\n","b":[1,2.5]}', [], None)
    assert C.checked_arguments("any", None, SCHEMAS) == ("{}", [], None)
    for bad in ("[1]", "{", '{"a": NaN}', "", "[" * 100_000):
        assert C.checked_arguments("any", bad, SCHEMAS) == (json.dumps(bad), [], "bad_json")
    assert C.checked_arguments("no", '{"x": [{"$ref": "q"}, {"y": {"$ref": "p"}}]}', SCHEMAS)[1:] == (["p", "q"], "unknown_tool:no")


def brute(calls, results, schemas=SCHEMAS):
    """Rows as link_calls gives them, one conversation at a time."""
    out = []
    parsed = [(*c[:4], *C.checked_arguments(c[3], c[4], schemas)) for c in calls]
    key = lambda x: tuple((v is not None, v) for v in x)
    first, answer = {}, {}
    for conv, i, turn, name, args, _, _ in parsed:
        if i is not None:
            first[conv, i] = min(first.get((conv, i), (turn, name, args)), (turn, name, args), key=key)
    for conv, i, turn, content in results:
        if i is not None:
            answer[conv, i] = min(answer.get((conv, i), (turn, content)), (turn, content), key=key)
    level = {k: 0 for k in first}
    deps = {k: set() for k in first}
    odd, missing = set(), set()
    for conv, i, turn, _, _, refs, _ in parsed:
        for r in refs if i is not None else ():
            if (conv, r) in first:
                deps[conv, i].add((conv, r))
                if first[conv, r][0] >= turn:
                    odd.add(conv)
            else:
                missing.add((conv, i))
    todo = {k for k in first if k[0] in odd}
    n = 0
    while todo:
        free = {k for k in todo if not deps[k] & todo}
        for k in free or todo:
            level[k] = n if free else None
        todo -= free or todo
        n += 1
    for conv, i, turn, name, args, _, error in parsed:
        k = (conv, i)
        mine = i is not None and first[k] == (turn, name, args)
        a = answer.get(k) if mine else None
        status = "no_id" if i is None else "duplicate_call" if not mine else "linked" if a else "no_result"
        lv = level.get(k, 0)
        error = error or ("missing_ref" if k in missing else "cycle" if lv is None else None)
        line = {"arguments": json.loads(args), "id": i, "name": name, "turn": turn,
                "result": {"content": a[1], "turn": a[0]} if a and (a[0], a[1]) != (None, None) else None}
        out.append((conv, i, turn, a[0] if a else None, lv, status, error, C.canonical(line)))
    for conv, i, turn, content in results:
        status = "no_id" if i is None else "no_call" if (conv, i) not in first else \
            "duplicate_result" if answer[conv, i] != (turn, content) else None
        if status:
            out.append((conv, i, None, turn, 0, status, None, C.canonical({"id": i, "result": {"content": content, "turn": turn}})))
    return sorted(out, key=str)


def run(spark, calls, results):
    c = spark.createDataFrame([(*r, 1) for r in calls], "conv_id long, call_id string, turn long, name string, arguments string, level int")
    r = spark.createDataFrame([(*x, "s") for x in results], "conv_id long, call_id string, turn long, content string, status string")
    return sorted((tuple(x) for x in C.link_calls(c.repartition(3), r, SCHEMAS).collect()), key=str)


def test_random_conversations(spark):
    rnd = random.Random(7)
    calls, results = [], []
    for conv in [*range(12), None]:
        for t in range(rnd.randrange(1, 9)):
            i = f"c{rnd.randrange(8)}"
            refs = ", ".join(f'"r{k}": {{"$ref": "c{rnd.randrange(9)}"}}' for k in range(rnd.randrange(3)))
            calls.append((conv, rnd.choice([i] * 9 + [None]), t, rnd.choice(["any", "any", "add", "nope"]),
                          rnd.choice(["{" + refs + "}"] * 6 + [None, "{]", '{"a": 1, "b": 2}'])))
            if rnd.random() < .8:
                results.append((conv, rnd.choice([i, i, "c0", None, "other"]), t + rnd.randrange(2), rnd.choice(["ok", "é\n\"", None, ""])))
    calls += calls[:3]
    results += results[:3]
    assert run(spark, calls, results) == brute(calls, results)


def test_chains_and_cycles(spark):
    chain = [(1, f"k{i}", 20 - i, "any", f'{{"x": {{"$ref": "k{i - 1}"}}}}' if i else "{}") for i in range(9)]
    ring = [(2, f"k{i}", i, "any", f'{{"x": {{"$ref": "k{(i + 1) % 3}"}}}}') for i in range(3)]
    got = run(spark, chain + ring, [])
    assert got == brute(chain + ring, [])
    assert [r[4] for r in sorted(got, key=lambda r: r[1]) if r[0] == 1] == list(range(9))
    assert {r[6] for r in got if r[0] == 2} == {"cycle"}
    assert run(spark, [], []) == []


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """Chains halve: 200 calls in a row, into a cycle of 7, from a call with two references, beside a conversation without an id."""
    rnd = random.Random(3)
    ref = lambda *ids: json.dumps({f"r{k}": {"$ref": i} for k, i in enumerate(ids)})
    calls = []
    for conv in (1, 2, None):
        calls += [(conv, f"k{i}", 500 - i, "any", ref(f"k{i - 1}") if i else "{}") for i in range(200)]
    calls += [(2, f"z{i}", i, "any", ref(f"z{(i + 1) % 7}")) for i in range(7)] + [(2, "y", 9, "any", ref("z3", "k5"))]
    calls += [(2, f"x{i}", 9 - i, "any", ref(f"x{i - 1}" if i else "y")) for i in range(9)]
    calls += [(1, "w", 900, "any", ref("k199", "k3")), (1, "v", 0, "any", ref("w", "k150", "v2")), (1, "v2", 0, "any", ref("k7"))]
    calls += [(5, f"c{i}", rnd.randrange(40), "any", ref(*{f"c{rnd.randrange(i)}" for _ in range(rnd.randrange(4))} if i else ())) for i in range(40)]
    tables = []
    monkeypatch.setattr(C, "keep", lambda df, name, keep=C.keep: tables.append(name) or keep(df, name))
    got = run(spark, calls, [])
    assert got == brute(calls, [])
    assert max(r[4] for r in got if r[4] is not None) == 201
    assert tables.count("levels") <= 14


def test_messages(spark):
    text = json.dumps({"tool_calls": [{"id": "a", "name": "any", "arguments": {"z": 1, "é": None}}, {"id": 5}, "odd"]})
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", text), (1, 2, "tool", '{"tool_call_id": "a", "content": [1]}'),
            (1, 3, "tool", "plain"), (1, 4, "assistant", None), (1, 5, "assistant", "[1]"), (None, None, None, None)]
    calls, results = C.extract(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.call_id: (r.status, r.json) for r in C.link_calls(calls, results, SCHEMAS).collect()}
    assert got["a"] == ("linked", '{"arguments":{"z":1,"é":null},"id":"a","name":"any","result":{"content":"[1]","turn":2},"turn":1}')
    assert got["5"][0] == "no_result"


def test_driver_table(spark):
    """Conversations without planted mistakes keep every prompt and answer."""
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").where("conv_id % 7 IN (0, 6)")
    got = C.link_calls(*C.turns_as_calls(conv), C.REPLY).collect()
    rows = [tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()]
    users = {(c, t): x for c, t, role, x in rows if role == "user"}
    said = {(c, t): x for c, t, role, x in rows if role == "assistant"}
    assert len([r for r in got if r.turn is not None]) == len(users)
    for r in got:
        if r.turn is not None:
            line = json.loads(r.json)
            assert line["arguments"]["prompt"] == users[r.conv_id, r.turn]
            answer = said.get((r.conv_id, r.turn + 1))
            assert (line["result"] or {}).get("content") == answer and C.canonical(line) == r.json
        else:
            assert (r.conv_id, r.result_turn - 1) not in users


def test_every_check_shows_in_the_driver_table(spark):
    conv = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    calls, results = C.turns_as_calls(conv)
    got = sorted((tuple(r) for r in C.link_calls(calls, results, C.REPLY).collect()), key=str)
    plain = lambda df, *names: [tuple(r) for r in df.select(*names).collect()]
    assert got == sorted(brute(plain(calls, "conv_id", "call_id", "turn", "name", "arguments"),
                               plain(results, "conv_id", "call_id", "turn", "content"), C.REPLY), key=str)
    assert {r[5] for r in got} >= {"linked", "no_result", "no_call", "duplicate_call", "duplicate_result"}
    assert {(r[6] or "").split(":")[0] for r in got} >= {"", "type", "unknown", "bad_json", "unknown_tool", "missing_ref", "cycle"}
    assert max(r[4] or 0 for r in got) >= 2


@pytest.mark.parametrize("part", [{"const": 1}, {"pattern": "a"}, {"anyOf": []}, {"exclusiveMinimum": 0}, {"minItems": 1},
                                  {"uniqueItems": True}, {"additionalProperties": {"type": "string"}}, True])
def test_unsupported_schemas_are_errors(part):
    for schema in (part, {"properties": {"a": part}}, {"items": {"items": part}}):
        with pytest.raises(ValueError, match="unsupported"):
            C.check_calls(None, {"tool": schema})
    for schema in (*SCHEMAS.values(), *C.REPLY.values()):
        C.check_schema(schema)
