import json
import random

from sluice.llm import chat
from sluice.llm.common import Scratch


def call(i, name="search", **arguments):
    return {"id": i, "name": name, "arguments": arguments}


def test_linking(spark):
    r = [
        (1, 0, "user", "hi {not json}"),
        (1, 1, "assistant", json.dumps({"content": "x", "tool_calls": [call("b", query={"$ref": "a"}), call("a", query="é", limit="3"), call("e", "calculate")]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": {"z": 1, "y": 2}})),
        (1, 3, "tool", json.dumps({"tool_call_id": "b", "content": "ok"})),
        (1, 4, "tool", json.dumps({"tool_call_id": "b", "content": "again"})),
        (1, 5, "tool", json.dumps({"tool_call_id": "none", "content": None})),
        (1, 6, "assistant", json.dumps({"tool_calls": [call("a", query="dup"), call("p", query={"$ref": "q"}), call("q", query={"$ref": "p"}), {"id": "s", "name": "search", "arguments": '{"query":"s"}'}]})),
        (2, 0, "tool", json.dumps({"tool_call_id": "late", "content": 1})),
        (2, 1, "assistant", json.dumps({"tool_calls": [call("late", query="x")]})),
        (2, 2, None, None),
        (2, 3, "user", ""),
        (2, 3, "user", ""),
        (None, None, "user", "n"),
        (3, 0, "user", "long " * 20000),
    ]
    rows = spark.createDataFrame([(*x, "clash") for x in r], "conv_id long, turn long, role string, text string, level string")
    got = sorted((tuple(x) for x in chat.format_chats(rows).collect()), key=repr)
    assert len(got) == len(r)
    by = {(x[0], x[1]): x for x in got}
    first = by[1, 1]
    said = json.loads(first[8])
    assert [c["id"] for c in said["tool_calls"]] == ["a", "e", "b"]
    assert [(c["state"], c["level"], c["answer_turn"]) for c in said["tool_calls"]] == [("linked", 0, 2), ("unanswered", 0, None), ("linked", 1, 3)]
    assert said["tool_calls"][0]["faults"] == ["limit: not integer"] and said["tool_calls"][1]["faults"] == ["expression: missing"]
    assert first[4:7] == (3, 2, 2) and first[3] == 1
    assert '"é"' in first[8] and first[8].startswith('{"content":"x","conversation":1,')
    assert [by[1, t][7] for t in (0, 2, 3, 4, 5)] == ["text", "linked", "linked", "repeated", "orphan"]
    assert by[1, 2][8] == '{"content":{"y":2,"z":1},"conversation":1,"role":"tool","state":"linked","tool_call_id":"a","turn":2}'
    states = {c["id"]: c["state"] for c in json.loads(by[1, 6][8])["tool_calls"]}
    assert states == {"a": "duplicate", "p": "cyclic", "q": "cyclic", "s": "unanswered"}
    assert by[2, 0][7] == "early"
    assert json.loads(by[2, 2][8]) == {"content": None, "conversation": 2, "role": None, "turn": 2}
    assert json.loads(by[3, 0][8])["content"] == "long " * 20000
    assert chat.format_chats(rows.limit(0)).collect() == []


def brute_levels(calls):
    """Level of each call by following what it depends on; None on a cycle or behind one."""
    known = {}

    def level(k, path):
        if k in path:
            return None
        if k not in known:
            under = [level(r, path | {k}) for r in calls[k] if r in calls]
            known[k] = None if None in under else 1 + max(under, default=-1)
        return known[k]

    return {k: level(k, frozenset()) for k in calls}


def test_levels_against_brute_force(spark):
    rng = random.Random(3)
    graphs = [{f"c{i}": [f"c{i - 1}"] for i in range(70)}, {"a": ["b"], "b": ["a"], "c": ["a"], "d": ["c", "e"], "e": []}]
    for size in (1, 5, 12, 25):
        graphs.append({f"n{i}": sorted({f"n{rng.randrange(max(1, i + rng.choice([0, 0, 0, 1])))}" for _ in range(rng.choice([0, 1, 1, 2, 3]))}) for i in range(size)})
    rows = [(g, k, refs) for g, calls in enumerate(graphs) for k, refs in calls.items()]
    with Scratch(spark) as work:
        got = {(r.conv_id, r.id): r.level for r in chat.levels(spark.createDataFrame(rows, "conv_id long, id string, refs array<string>"), work).collect()}
    for g, calls in enumerate(graphs):
        for k, v in brute_levels(calls).items():
            assert got.get((g, k)) == v, (g, k)


def test_turns_are_linked(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    got = {(r.conv_id, r.turn): r for r in chat.query(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    roles = {(r.conv_id, r.turn): r.role for r in rows}
    linked = 0
    for r in rows:
        x, key = got[r.conv_id, r.turn], (r.conv_id, r.turn)
        want = {"conversation": r.conv_id, "role": r.role, "turn": r.turn}
        if r.role == "user":
            level = 0
            while roles.get((r.conv_id, r.turn - 2 * level - 2)) == "user":
                level += 1
            answered = roles.get((r.conv_id, r.turn + 1)) == "assistant"
            linked += answered
            arguments = {"role": "user", "text": r.text} | ({"after": [{"$ref": f"turn-{r.turn - 2}"}]} if r.turn >= 2 else {})
            state = "linked" if answered else "unanswered"
            want |= {"content": None, "tool_calls": [{"id": f"turn-{r.turn}", "name": "reply", "arguments": arguments, "state": state, "level": level, "answer_turn": r.turn + 1 if answered else None, "faults": [] if r.text else ["text: below minLength"]}]}
            assert (x.state, x.level, x.n_calls, x.n_linked) == ("calls", level, 1, answered)
        elif r.role == "assistant":
            state = "linked" if roles.get((r.conv_id, r.turn - 1)) == "user" else "orphan"
            want |= {"content": r.text, "tool_call_id": f"turn-{r.turn - 1}", "state": state}
            assert x.state == state
        else:
            want |= {"content": r.text}
        assert x.json == json.dumps(want, ensure_ascii=False, sort_keys=True, separators=(",", ":")), key
    assert linked > 100


def test_schemas():
    schema = {
        "type": "object", "required": ["a"], "additionalProperties": False,
        "properties": {"a": {"type": ["integer", "null"], "maximum": 3}, "b": {"enum": ["x", 1]}, "c": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["k"]}}, "d": {"const": True}},
    }
    cases = {
        '{"a":1,"b":"x","c":[{"k":{"$ref":"z"}}],"d":true}': [],
        '{"a":4,"b":true,"c":[{},3],"d":1,"e":0}': ["a: above maximum", "b: not one of the values", "c[0].k: missing", "c[1]: not object", "d: not the value", "e: unknown"],
        '{"b":1.0,"c":[]}': ["a: missing", "c: below minItems"],
        '{"a":"1"}': ["a: not integer or null"],
        '{"a":true}': ["a: not integer or null"],
        "[]": ["arguments: not object"],
    }
    for text, want in cases.items():
        assert chat.faults(json.loads(text), schema) == want, text


def test_hard_messages(spark):
    deep = "[" * 3000 + "]" * 3000
    texts = [
        '{"tool_call_id":"\\ud800","content":"\\ud800x"}', '{"tool_calls":[{"id":"i","name":"n","arguments":{"d":%s}}]}' % deep, '{"tool_calls":[{"id":"j","name":"n","arguments":{"d":NaN}}]}',
        '{"tool_calls":[{"id":"k","name":"n","arguments":{"d":1e999}}]}', '{"tool_call_id":' + "[" * 200000, '{"tool_calls":[{"id":{"z":1,"a":2},"name":"\\udfff","arguments":"{\\"d\\":1}"}]}', "{" * 100,
    ]
    rows = spark.createDataFrame([(1, i, "tool", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.format_chats(rows).collect()}
    assert len(got) == len(texts)
    assert got[0].state == "orphan" and "\\ud800" in got[0].json and json.loads(got[0].json)["content"] == "\ud800x"
    for i in (2, 3, 4, 6):
        assert got[i].state == "text" and json.loads(got[i].json)["content"] == texts[i]
    assert json.loads(got[5].json)["tool_calls"][0]["id"] == '{"a":2,"z":1}'
