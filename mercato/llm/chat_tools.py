"""Chat formatting: tool calls linked to their results, as canonical JSON.

Calls and results meet in a hash join on (conversation, call id).  Arguments
are parsed, validated against the tool's schema and written in canonical form
(keys sorted by code point, no spaces, no escapes but JSON's own).

Order: an argument ``{"$ref": "<call id>"}`` uses another call's result, so
that call must come first.  Where every reference of a conversation points to
an earlier turn, the turn order is already topological (level 0 throughout).
Only conversations with a reference to the same or a later turn are levelled:
rounds release the calls whose references have all been released, and halve
chains of references by pointer jumping; a cycle is never released.  Rows are to be read in order of (conv_id, level, turn,
call_id); a conversation is never gathered in one task.

``status`` of a call: ``linked``, ``no_result``, ``duplicate_call`` (another
call of the id is smaller by turn, name and arguments), ``no_id``; of a
result: ``no_call``, ``duplicate_result``, ``no_id`` (a linked result is in
its call's row).  ``error`` says what is wrong with the arguments, a
reference (``missing_ref``) or the order (``cycle``).

Cases: null arguments are ``{}``; text that is no JSON object is kept as a
JSON string with the error ``bad_json``; numbers JSON does not have (NaN) are
``bad_json`` too; a null conversation is one of its own; identical rows are
linked each; empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import keep

_TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value: Any, kind: str) -> bool:
    if kind in ("number", "integer"):
        whole = isinstance(value, int) or kind == "integer" and isinstance(value, float) and value.is_integer()
        return not isinstance(value, bool) and (whole or kind == "number" and isinstance(value, float))
    return isinstance(value, _TYPES[kind])


def schema_error(value: Any, schema: dict, at: str = "") -> str | None:
    """The first violation of a JSON schema (type, enum, properties, required,
    additionalProperties, items, minimum, maximum, minLength, maxLength); a
    reference to a result satisfies any schema."""
    if isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str) and at:
        return None
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return f"type:{at or '.'}"
    if "enum" in schema and value not in schema["enum"]:
        return f"enum:{at or '.'}"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"required:{at}/{name}"
        for name in sorted(value):
            if name in known:
                if found := schema_error(value[name], known[name], f"{at}/{name}"):
                    return found
            elif schema.get("additionalProperties", True) is False:
                return f"unknown:{at}/{name}"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if found := schema_error(item, schema["items"], f"{at}/{i}"):
                return found
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"range:{at or '.'}"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"length:{at or '.'}"
    return None


_CHECKS = {"type", "enum", "properties", "required", "additionalProperties", "items", "minimum", "maximum",
           "minLength", "maxLength"}
_NOTES = {"title", "description", "default", "examples", "deprecated", "$schema", "$id", "$comment"}


def check_schema(schema: Any, at: str = "") -> None:
    """Raise ``ValueError`` if a schema uses what ``schema_error`` does not check."""
    if not isinstance(schema, dict):
        raise ValueError(f"unsupported schema at {at or '.'}: {schema!r}")
    unknown = sorted(set(schema) - _CHECKS - _NOTES)
    if not isinstance(schema.get("additionalProperties", True), bool):
        unknown.append("additionalProperties with a schema")
    if unknown:
        raise ValueError(f"unsupported schema keywords at {at or '.'}: {', '.join(unknown)}")
    for name, part in schema.get("properties", {}).items():
        check_schema(part, f"{at}/{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}/items")


def references(value: Any) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        return set().union(*map(references, value.values()))
    return set().union(*map(references, value)) if isinstance(value, list) else set()


def _no_constant(name: str) -> None:
    raise ValueError(name)


def checked_arguments(name: str | None, text: str | None, schemas: dict[str, dict]) -> tuple[str, list[str], str | None]:
    """Canonical arguments, the call ids they refer to, and what is wrong."""
    try:
        value = json.loads(text, parse_constant=_no_constant) if text is not None else {}
        if not isinstance(value, dict):
            raise ValueError("no object")
        out = canonical(value)
    except (ValueError, RecursionError):
        return canonical(text), [], "bad_json"
    error = schema_error(value, schemas[name]) if name in schemas else f"unknown_tool:{name}"
    return out, sorted(references(value)), error


_CHECKED = ("conv_id long, call_id string, turn long, name string, arguments string, refs array<string>, error string")


def check_calls(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    for name, schema in schemas.items():
        check_schema(schema, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [checked_arguments(n, a, schemas) for n, a in
                   zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "call_id", "turn", "name")), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.list_(pa.string())), pa.array([g[2] for g in got], pa.string())],
                names=["conv_id", "call_id", "turn", "name", "arguments", "refs", "error"])

    return calls.select(F.col("conv_id").cast("long"), F.col("call_id").cast("string"), F.col("turn").cast("long"),
                        F.col("name").cast("string"), F.col("arguments").cast("string")).mapInArrow(run, _CHECKED)


def _same(left: str, right: str, *columns: str):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _greatest(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*(F.max(c).alias(c) for c in rows.columns if c not in by))


def levels(first: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, call_id, level) of the calls of conversations that the turn
    order does not settle (level null: in or behind a cycle), and references
    to calls that do not exist (conv_id, call_id).

    ``first``: conv_id, call_id, turn; ``refs``: conv_id, call_id, turn, ref.

    A call has a lowest level ``base`` and edges (ref, w): its level is
    the greatest of base and of w + the level of each ref.  In a round an edge
    to a call without edges settles; an edge to a call with one edge jumps to
    where that leads, so a chain halves; others wait for theirs.  A path longer
    than its conversation has references (``n``) runs into a cycle, and is not
    followed further."""
    to = (refs.alias("r").join(first.alias("f"), F.expr("r.conv_id <=> f.conv_id AND r.ref = f.call_id"), "left")
          .select("r.conv_id", "r.call_id", "r.turn", "r.ref", F.col("f.turn").alias("ref_turn")))
    to = keep(to, "references")
    missing = to.where("ref_turn IS NULL").select("conv_id", "call_id").distinct()
    odd = keep(to.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("ref_turn >= turn")).alias("odd"))
               .where("odd").select("conv_id", "n"), "odd")
    edges = keep(to.where("ref_turn IS NOT NULL").alias("e").join(odd.alias("o"), F.expr("e.conv_id <=> o.conv_id"))
                 .select("e.conv_id", "e.call_id", "e.ref", F.lit(1).cast("long").alias("w"), "o.n").distinct(), "edges")
    calls = keep(first.alias("f").join(odd.alias("o"), F.expr("f.conv_id <=> o.conv_id"), "left_semi")
                 .select("conv_id", "call_id", F.lit(0).cast("long").alias("base")), "lowest")
    while True:
        leads = edges.groupBy("conv_id", "call_id").agg(
            F.count(F.lit(1)).alias("k"), F.max("ref").alias("next"), F.max("w").alias("next_w"), F.max(F.expr("w > n")).alias("lost"))
        state = keep(calls.alias("w").join(leads.alias("l"), _same("w", "l", "conv_id", "call_id"), "left")
                     .select("w.*", F.coalesce("l.k", F.lit(0)).alias("k"), "l.next", "l.next_w", "l.lost"), "levels")
        step = F.expr("CASE WHEN e.w > e.n OR s.k > 1 OR s.lost THEN 'wait' WHEN s.k = 0 THEN 'settle' ELSE 'jump' END")
        moved = keep(edges.alias("e").join(state.alias("s"), F.expr("e.conv_id <=> s.conv_id AND e.ref = s.call_id"))
                     .select("e.*", "s.next", "s.next_w", (F.col("e.w") + F.col("s.base")).alias("least"), step.alias("step")), "moved")
        if moved.where("step != 'wait'").isEmpty():
            break
        least = moved.where("step != 'wait'").select("conv_id", "call_id", F.col("least").alias("base"))
        calls = keep(_greatest(state.select("conv_id", "call_id", "base").unionByName(least), "conv_id", "call_id"), "lowest")
        edges = keep(_greatest(moved.where("step != 'settle'").select(
            "conv_id", "call_id", F.expr("if(step = 'jump', next, ref)").alias("ref"),
            F.expr("if(step = 'jump', w + next_w, w)").alias("w"), "n"), "conv_id", "call_id", "ref"), "edges")
    return state.select("conv_id", "call_id", F.expr("if(k = 0, cast(base AS int), null)").alias("level")), missing


def _line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``json``: the call with its result, or the lone result."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            result = None if r["result_turn"] is None and r["content"] is None else \
                {"content": r["content"], "turn": r["result_turn"]}
            if r["status"] in ("no_call", "duplicate_result") or r["kind"] == "result":
                out.append(canonical({"id": r["call_id"], "result": result}))
                continue
            # the arguments are canonical already
            out.append('{"arguments":' + r["arguments"] + ',"id":' + canonical(r["call_id"]) + ',"name":' + canonical(r["name"])
                       + ',"result":' + canonical(result) + ',"turn":' + canonical(r["turn"]) + "}")
        names = ["conv_id", "call_id", "turn", "result_turn", "level", "status", "error"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.string())], names=[*names, "json"])


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, turn, result_turn, level, status, error, json: a row
    for each row of ``calls`` (conv_id, call_id, turn, name, arguments), and
    for each of ``results`` (conv_id, call_id, turn, content) that no call takes."""
    checked = keep(check_calls(calls, schemas), "calls")
    answers = results.select(F.col("conv_id").cast("long"), F.col("call_id").cast("string"), F.col("turn").cast("long"),
                             F.col("content").cast("string"))
    first = checked.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "name", "arguments")).alias("first"))
    answer = answers.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("answer"))
    refs = checked.where("call_id IS NOT NULL").select("conv_id", "call_id", "turn", F.explode("refs").alias("ref"))
    order, missing = levels(first.select("conv_id", "call_id", "first.turn"), refs)
    joined = (checked.alias("c").join(first.alias("f"), _same("c", "f", "conv_id", "call_id"), "left")
              .join(answer.alias("a"), _same("c", "a", "conv_id", "call_id") & (
                  F.struct("c.turn", "c.name", "c.arguments").eqNullSafe(F.col("f.first"))), "left")
              .join(order.alias("o"), _same("c", "o", "conv_id", "call_id"), "left")
              .join(missing.withColumn("gone", F.lit(True)).alias("m"), _same("c", "m", "conv_id", "call_id"), "left"))
    of_calls = joined.select(
        "c.conv_id", "c.call_id", "c.turn", F.col("a.answer.turn").alias("result_turn"),
        F.when(F.col("o.call_id").isNull(), 0).otherwise(F.col("o.level")).alias("level"),
        F.expr("CASE WHEN c.call_id IS NULL THEN 'no_id' WHEN NOT (struct(c.turn, c.name, c.arguments) <=> f.first) "
               "THEN 'duplicate_call' WHEN a.call_id IS NULL THEN 'no_result' ELSE 'linked' END").alias("status"),
        F.coalesce("c.error", F.expr("CASE WHEN m.gone THEN 'missing_ref' WHEN o.call_id IS NOT NULL AND o.level IS NULL "
                                     "THEN 'cycle' END")).alias("error"),
        "c.name", "c.arguments", F.col("a.answer.content").alias("content"), F.lit("call").alias("kind"))
    lone = (answers.alias("r").join(first.alias("f"), _same("r", "f", "conv_id", "call_id"), "left")
            .join(answer.alias("a"), _same("r", "a", "conv_id", "call_id"), "left")
            .withColumn("state", F.expr(
                "CASE WHEN r.call_id IS NULL THEN 'no_id' WHEN f.call_id IS NULL THEN 'no_call' "
                "WHEN NOT (struct(r.turn, r.content) <=> a.answer) THEN 'duplicate_result' END"))
            .where("state IS NOT NULL"))
    none = F.lit(None)
    of_results = lone.select(
        "r.conv_id", "r.call_id", none.cast("long").alias("turn"), F.col("r.turn").alias("result_turn"),
        F.lit(0).alias("level"), F.col("state").alias("status"), none.cast("string").alias("error"),
        none.cast("string").alias("name"), none.cast("string").alias("arguments"), "r.content", F.lit("result").alias("kind"))
    return of_calls.unionByName(of_results).mapInArrow(
        _line, "conv_id long, call_id string, turn long, result_turn long, level int, status string, error string, json string")


_MESSAGE_CALLS = "conv_id long, turn long, kind string, call_id string, name string, body string"


def extract(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of messages (conv_id, turn, role, text): an assistant's
    text ``{"tool_calls": [{"id", "name", "arguments"}, ...]}`` and a tool's
    text ``{"tool_call_id", "content"}``.  Texts of another form hold none."""
    def text_of(value):
        return value if isinstance(value, str) or value is None else canonical(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    value = json.loads(r["text"] or "")
                except (ValueError, RecursionError):
                    continue
                if not isinstance(value, dict):
                    continue
                if r["role"] == "assistant" and isinstance(value.get("tool_calls"), list):
                    rows += [{"conv_id": r["conv_id"], "turn": r["turn"], "kind": "call", "call_id": text_of(c.get("id")),
                              "name": text_of(c.get("name")), "body": text_of(c.get("arguments"))}
                             for c in value["tool_calls"] if isinstance(c, dict)]
                elif r["role"] == "tool" and "tool_call_id" in value:
                    rows.append({"conv_id": r["conv_id"], "turn": r["turn"], "kind": "result", "name": None,
                                 "call_id": text_of(value["tool_call_id"]), "body": text_of(value.get("content"))})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("conv_id", pa.int64()), ("turn", pa.int64()), ("kind", pa.string()), ("call_id", pa.string()),
                ("name", pa.string()), ("body", pa.string())]))

    found = keep(messages.where("role IN ('assistant', 'tool')").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string")).mapInArrow(run, _MESSAGE_CALLS), "messages")
    return (found.where("kind = 'call'").select("conv_id", "call_id", "turn", "name", F.col("body").alias("arguments")),
            found.where("kind = 'result'").select("conv_id", "call_id", "turn", F.col("body").alias("content")))


#: The schema of the calls that ``turns_as_calls`` makes.
REPLY = {"reply": {"type": "object", "required": ["prompt"], "additionalProperties": False, "properties": {
    "prompt": {"type": "string", "minLength": 1}, "history": {"type": "string"}}}}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results: a user's turn calls ``reply``
    with its text, and with the result of the call two turns before; an
    assistant's turn is the result of the turn before it.

    Plain conversations make no mistakes, so some are changed by their number
    modulo 7: in 1, calls refer to the call two turns later instead, or to none
    where the turn modulo 8 is 6 or 7 (levels, in chains of four calls at most);
    in 2, the first call refers to the one two turns later, which refers back
    (a cycle); in 3, arguments break the schema (a number as prompt, an unknown
    property, text that is no JSON); in 4, every call is repeated by a later
    one of an unknown tool and every result is given twice; in 5, results name
    other calls than they answer."""
    c = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text",
                             F.coalesce(F.pmod(F.col("conv_id").cast("long"), F.lit(7)), F.lit(0)).alias("k"))

    def call_id(back):
        return F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), (F.col("turn") - back).cast("string"))

    k, turn = F.col("k"), F.col("turn")
    later = ((k == 1) & (turn % 8 < 6)) | ((k == 2) & (turn == 0))
    ref = F.when(later, call_id(-2)).when((k != 1) & (turn >= 2), call_id(2))
    history = F.when(ref.isNotNull(), F.named_struct(F.lit("$ref"), ref))
    plain = F.to_json(F.named_struct(F.lit("prompt"), F.col("text"), F.lit("history"), history))
    broken = (F.when(turn % 6 == 0, F.to_json(F.named_struct(F.lit("prompt"), turn)))
              .when(turn % 6 == 2, F.to_json(F.named_struct(F.lit("prompt"), F.col("text"), F.lit("extra"), F.lit(1))))
              .otherwise(F.lit("{reply")))
    call = F.struct(turn.alias("turn"), F.lit("reply").alias("name"))
    again = F.struct((turn + 1).alias("turn"), F.lit("reply2").alias("name"))
    calls = (c.where("role = 'user'").select(
        "conv_id", call_id(0).alias("call_id"), F.when(k == 3, broken).otherwise(plain).alias("arguments"),
        F.explode(F.when(k == 4, F.array(call, again)).otherwise(F.array(call))).alias("c"))
        .select("conv_id", "call_id", "c.turn", "c.name", "arguments"))
    other = F.when(k == 5, F.lit("x")).otherwise(F.lit(""))
    turns = F.when(k == 4, F.array(turn, turn + 1)).otherwise(F.array(turn))
    results = c.where("role = 'assistant'").select("conv_id", F.concat(call_id(1), other).alias("call_id"),
                                                   F.explode(turns).alias("turn"), F.col("text").alias("content"))
    return calls, results
