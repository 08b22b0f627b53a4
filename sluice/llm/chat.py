"""Chat formatting: tool calls linked with their results, in dependency order, as canonical JSON.

A message's text is a call message if it is a JSON object with a list `tool_calls` of
{"id", "name", "arguments"} (arguments an object, or a string that holds one), and a result message if it is
a JSON object with `tool_call_id`; anything else is plain text, and so is JSON that holds NaN or infinity, or
is nested deeper than Python's reader and writer go. Calls and results are joined by (conversation,
identifier). A call depends on each call of its conversation that its arguments name as {"$ref": identifier};
levels follow that order (0: depends on none), and a call on a cycle, or behind one, has none. Arguments are
checked against the schema of the named tool: type, enum, const, properties, required, additionalProperties,
items, and least and greatest lengths, counts and values, at any depth; another call's result fits anything.

States of calls: linked, unanswered, duplicate (not the first call of that identifier), cyclic. States of
results: linked, orphan, early (before its call), repeated (not the first result). Ties go to the smaller turn,
then the smaller hash of the message. Messages keep one row each, repeated ones too (identical rows share their
calls). Null turns come first. Null texts are null content; null conversations link nothing. Texts of any length
are taken whole. Half characters (lone surrogates) are written as escapes. Other columns are left out, so names
never clash; an empty table gives no rows.

Every message is a row of its own, so a conversation of any length never meets in one task: calls and
results meet by identifier, and hot identifiers are reduced to their first call before the join. Runs of calls
that each depend on one other are shortened by doubling, so that a chain of n calls takes log n steps.

turns_as_tools() makes tool messages of plain conversations, so that the method applies to all of them: a user's
turn is a call of the tool "reply", which depends on the call two turns before, and an assistant's turn is the
result of the call of the turn before.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, stored, table

NAME = "op8_chat_format"
#: Schemas of known tools; others are not checked.
SCHEMAS: dict[str, dict] = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}}, "required": ["query"]},
    "calculate": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"]},
    "reply": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}, "role": {"enum": ["user"]}, "after": {"type": "array", "items": {"type": "string"}, "maxItems": 1}},
        "required": ["text", "role"],
        "additionalProperties": False,
    },
}
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
HALF_CHARACTER = re.compile("[\ud800-\udfff]")


def written_out(text: str) -> str:
    return HALF_CHARACTER.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and characters as they are."""
    return written_out(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def is_kind(value, kind: str) -> bool:
    if kind in ("integer", "number") and isinstance(value, bool):
        return False
    return kind not in KINDS or isinstance(value, KINDS[kind]) or kind == "integer" and isinstance(value, float) and value.is_integer()


def is_reference(value) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"}


def broken(value, schema, path: str) -> Iterator[str]:
    """What a value breaks in a schema, as `path: what`; no deeper than the schema itself goes."""
    if schema is True or is_reference(value):
        return
    if schema is False:
        yield f"{path}: not allowed"
        return
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_kind(value, k) for k in kinds):
        yield f"{path}: not {' or '.join(kinds)}"
        return
    same = lambda x: type(x) is type(value) and x == value or is_kind(x, "number") and is_kind(value, "number") and x == value
    if "enum" in schema and not any(map(same, schema["enum"])):
        yield f"{path}: not one of the values"
    if "const" in schema and not same(schema["const"]):
        yield f"{path}: not the value"
    sizes = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems"), dict: ("minProperties", "maxProperties")}.get(type(value))
    size, bounds = (len(value), sizes) if sizes else (value, ("minimum", "maximum"))
    if sizes or is_kind(value, "number"):
        if bounds[0] in schema and size < schema[bounds[0]]:
            yield f"{path}: below {bounds[0]}"
        if bounds[1] in schema and size > schema[bounds[1]]:
            yield f"{path}: above {bounds[1]}"
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            yield from broken(v, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        inner = f"{path}." if path != "arguments" else ""
        known, others = schema.get("properties", {}), schema.get("additionalProperties", True)
        yield from (f"{inner}{k}: missing" for k in schema.get("required", []) if k not in value)
        for k, v in value.items():
            if k in known or others is not False:
                yield from broken(v, known.get(k, others), f"{inner}{k}")
            else:
                yield f"{inner}{k}: unknown"


def faults(arguments, schema: dict | None) -> list[str]:
    """What the arguments break in the schema, sorted."""
    if not isinstance(arguments, dict):
        return ["arguments: not object"]
    return sorted(map(written_out, broken(arguments, schema, "arguments"))) if schema is not None else []


def references(value) -> list[str]:
    found, left = set(), [value]
    while left:
        now = left.pop()
        if is_reference(now):
            found.add(identifier(now["$ref"]))
        elif isinstance(now, (dict, list)):
            left += now.values() if isinstance(now, dict) else now
    return sorted(found)


def identifier(value) -> str:
    return written_out(value) if isinstance(value, str) else canonical(value)


def no_constant(name: str):
    raise ValueError(name)


def parse(text: str | None, schemas: dict) -> tuple[list[dict], str | None, str]:
    """(calls, identifier of the call that this answers, content as JSON)."""
    if text and text.lstrip()[:1] == "{":
        try:
            value = json.loads(text, parse_constant=no_constant)
            if isinstance(value, dict) and isinstance(value.get("tool_calls"), list):
                calls = []
                for i, call in enumerate(c for c in value["tool_calls"] if isinstance(c, dict) and c.get("id") is not None):
                    arguments = call.get("arguments")
                    if isinstance(arguments, str):
                        try:
                            held = json.loads(arguments, parse_constant=no_constant)
                            canonical(held)
                            arguments = held
                        except (ValueError, RecursionError):
                            pass
                    name = identifier(call.get("name"))
                    calls.append({"i": i, "id": identifier(call["id"]), "name": name, "arguments": canonical(arguments), "faults": faults(arguments, schemas.get(name)), "refs": references(arguments)})
                return calls, None, canonical(value.get("content"))
            if isinstance(value, dict) and value.get("tool_call_id") is not None:
                return [], identifier(value["tool_call_id"]), canonical(value.get("content"))
        except (ValueError, RecursionError):
            pass
    return [], None, canonical(text)


CALL = pa.struct([("i", pa.int32()), ("id", pa.string()), ("name", pa.string()), ("arguments", pa.string()), ("faults", pa.list_(pa.string())), ("refs", pa.list_(pa.string()))])
CALL_SQL = "struct<i:int,id:string,name:string,arguments:string,faults:array<string>,refs:array<string>>"


def parsed(messages: DataFrame, schemas: dict) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                said = [parse(t, schemas) for t in part.column(5).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array([x[0] for x in said], pa.list_(CALL)), pa.array([x[1] for x in said], pa.string()), pa.array([x[2] for x in said], pa.string())], ["conv_id", "turn", "role", "m1", "m2", "calls", "answers", "content"])

    one, two = (F.xxhash64(F.lit(i), "conv_id", "turn", "role", "text").alias(f"m{i}") for i in (1, 2))
    rows = messages.select("conv_id", "turn", "role", one, two, "text")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, m1 long, m2 long, calls array<{CALL_SQL}>, answers string, content string")


def levels(calls: DataFrame, work: Scratch) -> DataFrame:
    """(conv_id, id, level) of the calls that no cycle holds up."""
    key = ["conv_id", "id"]
    edges = work.stored(calls.select("conv_id", "id", F.explode("refs").alias("to")).distinct().join(calls.select("conv_id", F.col("id").alias("to")), ["conv_id", "to"], "left_semi"))
    if edges.isEmpty():
        return calls.select("conv_id", "id", F.lit(0).cast("long").alias("level"))
    needs = work.stored(edges.groupBy(*key).agg(F.count(F.lit(1)).alias("needs"), F.min("to").alias("to")))
    # calls that depend on one other look past each other: to the first that depends on none or on several
    single = needs.filter("needs = 1")
    beyond = work.stored(single.select(*key, "to", F.lit(1).cast("long").alias("steps"), F.lit(True).alias("more")))
    left = beyond.count()
    while left:
        on = beyond.select("conv_id", F.col("id").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("steps2"), F.col("more").alias("more2"))
        further = beyond.join(on, ["conv_id", "to"], "left").select(*key, F.coalesce("to2", "to").alias("to"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), F.col("to2").isNotNull().alias("more"))
        beyond = work.stored(further)
        now = beyond.filter("more").count()
        if now == left:
            break  # the rest run in circles
        left = now
    ends = beyond.filter("not more").select("conv_id", "id", F.col("to").alias("end"), "steps")
    # calls that depend on several: those whose needs the last level met come next
    joint = edges.join(needs.filter("needs > 1").select(*key), key, "left_semi")
    stops = ends.select("conv_id", F.col("id").alias("to"), "end", "steps")
    held = beyond.filter("more").select("conv_id", F.col("id").alias("to"))  # never met
    joint = joint.join(stops, ["conv_id", "to"], "left").select(*key, F.coalesce("end", "to").alias("end"), F.coalesce("steps", F.lit(0)).alias("steps"), "to").join(held.withColumn("held", F.lit(True)), ["conv_id", "to"], "left")
    joint = work.stored(joint.select(*key, "end", "steps", "held"))
    new = work.stored(calls.select(*key).join(needs.select(*key), key, "left_anti").withColumn("level", F.lit(0).cast("long")))
    done, open_ = new, work.stored(joint.groupBy(*key).agg(F.sum(F.when(F.col("held").isNull(), 1).otherwise(2)).alias("waits"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("top")).select(*key, F.when(F.col("waits") == F.col("n"), F.col("n")).otherwise(F.col("n") + 1).alias("waits"), "top"))
    while not open_.isEmpty() and not new.isEmpty():
        met = joint.join(new.select("conv_id", F.col("id").alias("end"), "level"), ["conv_id", "end"]).groupBy(*key).agg(F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("steps")).alias("high"))
        after = work.stored(open_.join(met, key, "left").select(*key, (F.col("waits") - F.coalesce("met", F.lit(0))).alias("waits"), F.greatest("top", "high").alias("top")))
        new = work.stored(after.filter("waits = 0").select(*key, (F.col("top") + 1).alias("level")))
        open_, done = after.filter("waits > 0"), done.unionByName(new)
    return done.unionByName(ends.join(done.select("conv_id", F.col("id").alias("end"), "level"), ["conv_id", "end"]).select(*key, (F.col("level") + F.col("steps")).alias("level")))


def format_chats(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """A row for each message: conv_id, turn, level, role, n_calls, n_linked, n_invalid, state, json."""
    with Scratch(messages.sparkSession) as work:
        return stored(_format(messages, SCHEMAS if schemas is None else schemas, work))


def _format(messages: DataFrame, schemas: dict, work: Scratch) -> DataFrame:
    rows = work.stored(parsed(messages, schemas))
    calls = rows.filter(F.size("calls") > 0).select("conv_id", "turn", "m1", "m2", F.inline("calls")).dropDuplicates(["m1", "m2", "i"])
    linkable = calls.filter(F.col("conv_id").isNotNull())
    order = F.struct("turn", "m1", "m2", "i")
    first = work.stored(linkable.groupBy("conv_id", "id").agg(F.min(F.struct(order.alias("o"), F.col("refs"))).alias("x")).select("conv_id", "id", "x.o.*", "x.refs"))
    results = rows.filter(F.col("answers").isNotNull()).select("conv_id", F.col("answers").alias("id"), F.col("turn").alias("r_turn"), F.struct("m1", "m2").alias("r_mid")).distinct()
    joined = results.join(first.select("conv_id", "id", F.col("turn").alias("c_turn")), ["conv_id", "id"], "left")
    early = F.col("r_turn") < F.col("c_turn")
    state = F.when(F.col("c_turn").isNull(), "orphan").when(early, "early").otherwise("linked")
    said = joined.select("conv_id", "id", "r_turn", "r_mid", state.alias("r_state"))
    answer = said.filter("r_state = 'linked'").groupBy("conv_id", "id").agg(F.min(F.struct("r_turn", "r_mid")).alias("a"))
    said = said.join(answer, ["conv_id", "id"], "left").select(
        "r_mid.*", F.when((F.col("r_state") == "linked") & (F.col("a.r_mid") != F.col("r_mid")), "repeated").otherwise(F.col("r_state")).alias("r_state")
    )
    known = first.select("conv_id", "id", F.struct("m1", "m2").alias("f_mid"), F.col("i").alias("f_i")).join(levels(first, work), ["conv_id", "id"], "left").join(answer.select("conv_id", "id", F.col("a.r_turn").alias("answer_turn")), ["conv_id", "id"], "left")
    call_state = (
        F.when(F.col("f_mid").isNull() | (F.col("f_mid") != F.struct("m1", "m2")) | (F.col("f_i") != F.col("i")), "duplicate").when(F.col("level").isNull(), "cyclic").when(F.col("answer_turn").isNull(), "unanswered").otherwise("linked")
    )
    linked = calls.join(known, ["conv_id", "id"], "left").select(
        "m1", "m2", F.struct("i", "id", "name", "arguments", "faults", F.when(F.col("conv_id").isNull(), "unanswered").otherwise(call_state).alias("state"), "level", "answer_turn").alias("call")
    )
    per_message = linked.groupBy("m1", "m2").agg(F.array_sort(F.collect_list("call")).alias("linked"))  # a message's own calls
    whole = rows.join(per_message, ["m1", "m2"], "left").join(said, ["m1", "m2"], "left")
    level = F.coalesce(F.array_max(F.transform("linked", lambda c: c["level"])), F.lit(0))

    def object_of(call: dict) -> str:
        values = {k: v if k == "arguments" else canonical(v) for k, v in call.items() if k != "i"}
        return "{" + ",".join(f'"{k}":{v}' for k, v in sorted(values.items())) + "}"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"state": [], "json": []}
            for conv, turn, role, content, answers, r_state, made in zip(*(c.to_pylist() for c in batch.columns[:7]), strict=True):
                message = {"content": content, "conversation": canonical(conv), "role": canonical(role), "turn": canonical(turn)}
                if made:
                    ordered = sorted(made, key=lambda c: (c["level"] is None, c["level"] or 0, c["i"]))
                    message["tool_calls"] = f"[{','.join(object_of(c) for c in ordered)}]"
                if answers is not None:
                    message |= {"tool_call_id": canonical(answers), "state": canonical(r_state or "orphan")}
                out["state"].append((r_state or "orphan") if answers is not None else ("calls" if made else "text"))
                out["json"].append("{" + ",".join(f'"{k}":{v}' for k, v in sorted(message.items())) + "}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *batch.columns[7:], pa.array(out["state"], pa.string()), pa.array(out["json"], pa.string())], ["conv_id", "turn", "role", "level", "n_calls", "n_linked", "n_invalid", "state", "json"])

    n = lambda f: F.coalesce(F.size(F.filter("linked", f)), F.lit(0)) if f else F.coalesce(F.size("linked"), F.lit(0))
    ready = whole.select(
        "conv_id", "turn", "role", "content", "answers", "r_state", "linked", level.cast("int").alias("level"),
        F.when(F.col("linked").isNull(), 0).otherwise(F.size("linked")).cast("long").alias("n_calls"),
        F.when(F.col("linked").isNull(), 0).otherwise(n(lambda c: c["state"] == "linked")).cast("long").alias("n_linked"),
        F.when(F.col("linked").isNull(), 0).otherwise(n(lambda c: F.size(c["faults"]) > 0)).cast("long").alias("n_invalid"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema}
    return ready.mapInArrow(written, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, level int, n_calls long, n_linked long, n_invalid long, state string, json string")


def turns_as_tools(conversations: DataFrame) -> DataFrame:
    """Tool messages (conv_id, turn, role, text) of plain turns; texts that are JSON objects, and rows without a turn, stay."""
    name = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    turn = F.col("turn")
    after = F.when(turn >= 2, F.array(F.struct(name(turn - 2).alias("$ref"))))
    arguments = F.struct("text", "role", after.alias("after"))
    call = F.to_json(F.struct(F.array(F.struct(name(turn).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(name(turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    plain = turn.isNotNull() & ~F.coalesce(F.ltrim("text").startswith("{"), F.lit(False))
    text = F.when(plain & (F.col("role") == "user"), call).when(plain & (F.col("role") == "assistant"), result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(turns_as_tools(table(spark, sf_dir, "conversations")))
