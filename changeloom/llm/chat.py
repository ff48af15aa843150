"""Chat formatting with tool calls: linking by identifier, topological order, schema checks, canonical JSON.

Calls and results meet in a hash join on conversation and identifier. A call may name the call whose result it uses;
its depth in that order is found by pointer doubling, in as many rounds as the logarithm of the longest conversation.
Every record carries its own place (depth, turn), so no conversation is ever gathered in one task.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import staged, with_python

_SURROGATE = re.compile("[\ud800-\udfff]")
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


#: What :func:`violation` looks at, and words that restrict nothing. A schema with others is refused, not half checked.
_CHECKED = frozenset(
    "type enum const anyOf allOf minLength maxLength minItems maxItems minimum maximum pattern properties required additionalProperties items".split()
)
_REMARKS = frozenset("title description default examples $schema $comment deprecated".split())
#: Levels of nesting that arguments may have.
MAX_DEPTH = 200


def check_schema(schema: object, where: str = "$") -> None:
    """Raises ValueError, naming the word, if a schema asks for something that is not checked here."""
    if not isinstance(schema, dict):
        raise ValueError(f"{where}: a schema is an object")
    if unknown := sorted(schema.keys() - _CHECKED - _REMARKS):
        raise ValueError(f"{where}: {', '.join(unknown)} is not checked")
    kinds = schema.get("type", [])
    if unknown := [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in _KINDS]:
        raise ValueError(f"{where}: no type {unknown[0]}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{where}: additionalProperties is true or false")
    re.compile(schema.get("pattern", ""))
    parts = [*schema.get("properties", {}).items(), *((f"{w}[{k}]", x) for w in ("anyOf", "allOf") for k, x in enumerate(schema.get(w, [])))]
    for name, part in [*parts, *([("items", schema["items"])] if "items" in schema else [])]:
        check_schema(part, f"{where}.{name}")


def _is(value: object, kind: str) -> bool:
    return isinstance(value, _KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def _same(a: object, b: object) -> bool:
    """Equal as JSON, where true is not 1."""
    return canonical(a) == canonical(b)


def violation(value: object, schema: dict, where: str = "$") -> str | None:
    """The first way in which a value breaks a schema: type, constants, alternatives, lengths, limits, pattern, properties, items."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return f"{where}: not {' or '.join(kinds)}"
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]) or "const" in schema and not _same(value, schema["const"]):
        return f"{where}: not allowed"
    if "anyOf" in schema and all(violation(value, x, where) for x in schema["anyOf"]):
        return f"{where}: anyOf"
    if found := next((f for x in schema.get("allOf", ()) if (f := violation(value, x, where))), None):
        return found
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        return f"{where}: pattern"
    size = len(value) if isinstance(value, (str, list)) else None
    number = value if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    unit = "Items" if isinstance(value, list) else "Length"
    limits = ((size, f"min{unit}", -1), (size, f"max{unit}", 1), (number, "minimum", -1), (number, "maximum", 1))
    for got, name, side in limits:
        if got is not None and name in schema and (got - schema[name]) * side > 0:
            return f"{where}: {name}"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{where}.{name}: missing"
        for name in sorted(value):
            if name in known and (found := violation(value[name], known[name], f"{where}.{name}")):
                return found
            if name not in known and schema.get("additionalProperties") is False:
                return f"{where}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        return next((f for k, x in enumerate(value) if (f := violation(x, schema["items"], f"{where}[{k}]"))), None)
    return None


def canonical(value: object) -> str:
    """JSON with sorted keys and without spaces; equal values give equal text. Half of a surrogate pair stays an escape."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _SURROGATE.sub(lambda c: f"\\u{ord(c[0]):04x}", text)


def parsed(arguments: str) -> object:
    """The value of a JSON text; ValueError if it is none, or nested deeper than ``MAX_DEPTH``."""
    value = json.loads(arguments)
    level, depth = [value], 0
    while level := [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]:
        depth += 1
        if depth > MAX_DEPTH:
            raise ValueError("nested too deep")
    return value


def _linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls with their results, and the results that no call has. Equal rows are one with their number of copies."""
    key, place = ["conv_id", "call_id"], F.struct("turn", "hash")
    calls = calls.withColumn("hash", F.xxhash64("name", "arguments", "after"))
    calls = staged(calls.groupBy(*calls.columns).agg(F.count("*").alias("copies")), "chat-calls")
    results = results.withColumn("hash", F.xxhash64("content"))
    results = staged(results.groupBy(*results.columns).agg(F.count("*").alias("copies")), "chat-results")
    # One row per identifier, found by aggregates, so an identifier may repeat any number of times.
    heads = staged(calls.filter("call_id IS NOT NULL").groupBy(*key).agg(F.min(place).alias("head")), "chat-heads")
    firsts = results.filter("call_id IS NOT NULL").groupBy(*key).agg(F.min_by(F.struct("turn", "hash", "content"), place).alias("answer"))
    firsts = staged(firsts, "chat-answers")
    is_head = F.col("conv_id").isNull() | F.col("head").isNotNull() & (place == F.col("head"))
    asked = calls.join(heads, key, "left").withColumn("is_head", is_head).drop("head")
    asked = asked.join(firsts.withColumn("is_head", F.lit(True)), [*key, "is_head"], "left")
    status = (
        F.when(F.col("call_id").isNull(), "without identifier")
        .when(~F.col("is_head"), "repeated")
        .when(F.col("answer").isNull(), "without result")
        .when(F.col("answer.turn") < F.col("turn"), "result before call")
        .otherwise("linked")
    )
    asked = asked.select(*key, "turn", status.alias("status"), "name", "arguments", "after", F.col("answer.content").alias("content"), "copies")
    told = results.join(firsts, key, "left").withColumn("first", F.coalesce(F.col("answer.turn").eqNullSafe(F.col("turn")) & (F.col("answer.hash") == F.col("hash")), F.lit(False)))
    told = told.join(heads.select(*key, F.lit(True).alias("called")), key, "left")
    status = F.when(F.col("called").isNull() | F.col("conv_id").isNull(), "result without call").when(~F.col("first"), "repeated result")
    none = F.lit(None).cast("string")
    told = told.withColumn("status", status).filter("status IS NOT NULL")
    return asked.union(told.select(*key, "turn", "status", none.alias("name"), none.alias("arguments"), none.alias("after"), "content", "copies"))


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id and depth (0 for calls that use no other call of the conversation, null on or behind a cycle)."""
    calls = calls.filter("call_id IS NOT NULL")
    nodes = staged(calls.groupBy("conv_id", "call_id").agg(F.min("after").alias("after")), "chat-calls")
    parents = nodes.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there"))
    state = nodes.join(parents, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("there"), F.col("after")).alias("to"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth")
    )
    state = staged(state, "chat-depths")
    longest = nodes.groupBy("conv_id").count().agg(F.max("count")).head()[0] or 1
    for _ in range(math.ceil(math.log2(longest)) + 1):
        next_ = state.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("far"), F.col("depth").alias("more"))
        joined = state.join(next_, ["conv_id", "to"], "left")
        state = staged(joined.select("conv_id", "call_id", F.col("far").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "chat-depths")
        if state.filter("`to` IS NOT NULL").isEmpty():
            break
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], others: DataFrame | None = None) -> DataFrame:
    """One record for every call, for every result that no call has, and for every other turn.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON) and after (the identifier of the call whose result it
    uses, or null); ``results`` has conv_id, turn, call_id and content. Other columns are not read. The result has
    conv_id, turn, depth, call_id, status, copies, valid, problem and json. Sorted by depth and turn, the records of a
    conversation are in topological order. Calls and results without conversation link to nothing and repeat nothing.

    A null identifier links to nothing. Of calls with one identifier the first by turn is the call and the others are
    "repeated"; results likewise. Equal rows are one record with their number of copies. A dependence on an unknown call is none; calls on or
    behind a cycle have a null depth. Arguments that are null, no JSON, or for a tool without schema are invalid and
    kept as text, and so are those nested deeper than ``MAX_DEPTH``. A schema with words that are not checked is refused
    before anything runs. Empty tables give an empty result.

    ``others`` has conv_id, turn, role and text of turns that are neither call nor result. Their records hold role and
    text; they have the status "no call", no identifier, a null depth and no problem, and are not valid calls.
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    linked = _linked(calls, results.select("conv_id", "turn", "call_id", "content"))
    rows = linked.join(depths(calls), ["conv_id", "call_id"], "left")

    def _record(call_id, name, arguments, after, status, content) -> tuple[bool, str | None, str]:
        problem, value = None, arguments
        if status not in ("result without call", "repeated result"):
            try:
                value = parsed(arguments) if arguments is not None else None
                problem = violation(value, schemas[name]) if name in schemas else f"no schema for {name}"
                canonical(value)
            except (ValueError, RecursionError):
                problem, value = "arguments are not JSON", arguments
        record = {"call_id": call_id, "name": name, "arguments": value, "after": after, "result": content, "status": status}
        return problem is None and status == "linked", problem, canonical(record)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fields = batch[["call_id", "name", "arguments", "after", "status", "content"]].astype(object)
            out = [_record(*row) for row in fields.where(fields.notna(), None).itertuples(index=False)]
            extra = pd.DataFrame(out, columns=["valid", "problem", "json"])
            yield pd.concat([batch[["conv_id", "turn", "depth", "call_id", "status", "copies"]].reset_index(drop=True), extra], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, depth long, call_id string, status string, copies long, valid boolean, problem string, json string"
    records = with_python(rows).mapInPandas(write, shape)
    return records if others is None else records.unionByName(_carried(others))


def _carried(others: DataFrame) -> DataFrame:
    """Records of turns that are neither call nor result. Equal rows are one with their number of copies."""
    turns = others.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fields = batch[["role", "text"]].astype(object)
            pairs = fields.where(fields.notna(), None).itertuples(index=False)
            out = [(None, None, "no call", False, None, canonical({"role": role, "status": "no call", "text": text})) for role, text in pairs]
            extra = pd.DataFrame(out, columns=["depth", "call_id", "status", "valid", "problem", "json"])
            yield pd.concat([batch[["conv_id", "turn", "copies"]].reset_index(drop=True), extra], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    shape = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, copies long, depth long, call_id string, status string, valid boolean, problem string, json string"
    return with_python(turns).mapInPandas(write, shape)


#: What a turn of the conversations is checked against when it is read as a call.
ASK = {
    "type": "object",
    "required": ["question", "turn"],
    "additionalProperties": False,
    "properties": {
        "question": {"type": "string", "minLength": 1, "maxLength": 4000},
        "turn": {"type": "integer", "minimum": 0},
        "words": {"type": "integer", "minimum": 1},
    },
}


def identifier(conv_id: Column, turn: Column) -> Column:
    return F.concat(F.lit("call-"), F.substring(F.sha2(F.concat_ws(":", conv_id, turn), 256), 1, 16))


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that conversations (conv_id, turn, role, text) stand for: a user's turn asks, an assistant's answers the turn before.

    A question uses the answer to the question two turns earlier. Other roles are neither; ``other_turns`` has them.
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    question = F.to_json(F.struct(F.col("text").alias("question"), turn.alias("turn"), F.regexp_count("text", F.lit(r"\S+")).alias("words")))
    calls = conversations.filter("role = 'user'").select(
        "conv_id", "turn", identifier(conv, turn).alias("call_id"), F.lit("ask").alias("name"), question.alias("arguments"), identifier(conv, turn - 2).alias("after")
    )
    results = conversations.filter("role = 'assistant'").select("conv_id", "turn", identifier(conv, turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """The turns that ``conversation_calls`` takes for neither call nor result: system, tool, any other role and none."""
    return conversations.filter("role IS NULL OR role NOT IN ('user', 'assistant')").select("conv_id", "turn", "role", "text")
