"""Chat formatting: tool calls linked with their results.

Calls and results are rows. They are reduced to one per conversation and
identifier (partial aggregation, so a repeated identifier never multiplies),
then hash-joined on both. Arguments are parsed, checked against the tool's JSON
schema and, like the whole message, serialised as canonical JSON: keys sorted,
no spaces, integers and decimals in their shortest form.

A call may name others whose results it needs, by ``{"$ref": "<call id>"}``
anywhere in its arguments. ``wave`` orders calls topologically: sorting a
conversation by (wave, turn, call id), null turns first, puts every call after
those it needs. Where calls only need earlier ones, as almost always, the
order of turns is topological and no work is done (wave 0). Conversations in
which a call needs a later one are peeled: in one task each up to ``PEELED``
calls and references, counted first, and beyond that in rounds, each a join on
call identifiers over all of them at once, so that no larger conversation is
gathered anywhere. Calls on a cycle, or that need one, get no wave.

Defined cases: rows without conversation or identifier are left out. Of calls
(results) with one identifier in a conversation the first by turn, then by
content, stands; ``calls`` and ``results`` count them. A call without result has status
``unanswered``, a result without call ``orphan``. References to unknown calls
are errors of validation, not of order; only a string can refer. Null or
malformed arguments (also numbers that are not finite and lone surrogates, for
which there is no canonical form), unknown tools and null content are reported
the same way, with the raw text kept as a JSON string. A tool's schema with a
keyword or pattern that is not understood is refused at once. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vetline.llm.frames import durable


# -- canonical JSON and schemas ----------------------------------------------------------------------

def canonical(value) -> str:
    """JSON with sorted keys (by UTF-16 units), no spaces, and shortest numbers."""
    todo, out = [value], []
    while todo:  # a stack, so that nesting has no limit
        item = todo.pop()
        if isinstance(item, _Raw):
            out.append(item)
        elif isinstance(item, dict):
            parts: list = [_Raw("{")]
            for k, key in enumerate(sorted(item, key=lambda s: s.encode("utf-16-be", "surrogatepass"))):
                parts += [_Raw("," * (k > 0) + json.dumps(key, ensure_ascii=False) + ":"), item[key]]
            todo.extend(reversed([*parts, _Raw("}")]))
        elif isinstance(item, list):
            parts = [_Raw("[")]
            for k, one in enumerate(item):
                parts += [_Raw("," * (k > 0)), one]
            todo.extend(reversed([*parts, _Raw("]")]))
        elif isinstance(item, float):
            out.append(_number(item))
        else:
            out.append(json.dumps(item, ensure_ascii=False))
    return "".join(out)


class _Raw(str):
    """Text that is already JSON."""


def _number(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError("JSON has no such number")
    if x == int(x) and abs(x) < 1e21:
        return str(int(x))
    mantissa, _, exponent = repr(x).partition("e")
    return f"{mantissa}e{int(exponent):+d}" if exponent else mantissa


#: Keywords that ``violations`` checks, and those that describe without constraining.
_CHECKED = {"type", "enum", "const", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "minLength",
            "maxLength", "pattern", "minimum", "maximum"}
_DESCRIBING = {"title", "description", "default", "examples", "format", "$schema", "$id", "$comment", "deprecated", "readOnly", "writeOnly"}


def check_schema(schema, at: str = "$") -> None:
    """Refuse a schema that ``violations`` would not check in full."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object, not {schema!r}")
    unknown = sorted(set(schema) - _CHECKED - _DESCRIBING)
    if unknown:
        raise ValueError(f"{at}: unknown keywords {', '.join(unknown)}")
    kinds = schema.get("type", [])
    odd = [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in (*_TYPES, "integer", "number")]
    if odd:
        raise ValueError(f"{at}: unknown types {', '.join(map(str, odd))}")
    try:
        re.compile(schema.get("pattern", ""))
    except re.error as exc:
        raise ValueError(f"{at}: pattern {schema['pattern']!r}: {exc}") from exc
    for name, own in schema.get("properties", {}).items():
        check_schema(own, f"{at}.{name}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        check_schema(schema["additionalProperties"], f"{at}.*")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _TYPES.get(kind, ()))


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What in a value breaks a JSON schema, as "path: keyword" strings.

    Keywords: type, enum, const, required, properties, additionalProperties,
    items, minItems, maxItems, minLength, maxLength, pattern, minimum, maximum.
    """
    if isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str):
        return []  # stands for another call's result
    found = []
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    if "enum" in schema and not any(canonical(value) == canonical(x) for x in schema["enum"]):
        found.append(f"{at}: enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        found.append(f"{at}: const")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: additionalProperties")
            elif isinstance(schema.get("additionalProperties"), dict):
                found += violations(value[k], schema["additionalProperties"], f"{at}.{k}")
    elif isinstance(value, list):
        found += [f"{at}: {k}" for k, bad in (("minItems", len(value) < schema.get("minItems", 0)),
                                             ("maxItems", len(value) > schema.get("maxItems", len(value)))) if bad]
        if isinstance(schema.get("items"), dict):
            for i, one in enumerate(value):
                found += violations(one, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        found += [f"{at}: {k}" for k, bad in (("minLength", len(value) < schema.get("minLength", 0)),
                                             ("maxLength", len(value) > schema.get("maxLength", len(value))),
                                             ("pattern", "pattern" in schema and not re.search(schema["pattern"], value))) if bad]
    elif _is(value, "number"):
        found += [f"{at}: {k}" for k, bad in (("minimum", value < schema.get("minimum", value)),
                                             ("maximum", value > schema.get("maximum", value))) if bad]
    return found


def references(value) -> list[str]:
    """Identifiers of the calls that arguments refer to, sorted."""
    todo, found = [value], set()
    while todo:
        item = todo.pop()
        if isinstance(item, dict):
            if set(item) == {"$ref"} and isinstance(item["$ref"], str):
                found.add(item["$ref"])
            todo.extend(item.values())
        elif isinstance(item, list):
            todo.extend(item)
    return sorted(found)


_READ = (T.StructType().add("json", T.StringType()).add("needs", T.ArrayType(T.StringType())).add("errors", T.ArrayType(T.StringType())))


def _number_by_name(name: str) -> float:
    raise ValueError(f"JSON has no {name}")


def read_arguments(name: str | None, arguments: str | None, tools: dict[str, dict]) -> dict:
    """Canonical form, references and errors of one call's arguments."""
    try:
        value = json.loads(arguments, parse_constant=_number_by_name)
        text = canonical(value)
        text.encode()  # a lone surrogate is no text
    except (TypeError, ValueError, RecursionError):
        return {"json": canonical(arguments), "needs": [], "errors": ["$: json"]}
    schema = tools.get(name)
    errors = ["tool: unknown"] if schema is None else violations(value, schema)
    return {"json": text, "needs": references(value), "errors": errors}


def _reader(tools: dict[str, dict]):
    @F.arrow_udf(_READ)
    def read(names: pa.Array, arguments: pa.Array) -> pa.Array:
        rows = [read_arguments(n.as_py(), a.as_py(), tools) for n, a in zip(names, arguments)]
        return pa.array(rows, to_arrow_type(_READ))

    return read


# -- linking --------------------------------------------------------------------------------------------

def _first(rows: DataFrame, count: str, *columns: str) -> DataFrame:
    """One row per conversation and identifier: the first by turn, then by content."""
    top = (rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id")
           .agg(F.min(F.struct(F.col("turn").isNull(), "turn", *columns)).alias("top"), F.count("*").alias(count)))
    return top.select("conv_id", "call_id", count, "top.turn", *[f"top.{c}" for c in columns])


#: Calls and references of a conversation that one task orders at most.
PEELED = 100_000


def peel(calls: list[str], needs: list[tuple[str, str]]) -> dict[str, int]:
    """Wave of each call that does not stand on or behind a cycle; ``needs`` pairs a call with one it needs."""
    waiting, wanted_by = dict.fromkeys(calls, 0), {}
    for call, need in needs:
        waiting[call] += 1
        wanted_by.setdefault(need, []).append(call)
    done, ready, wave = {}, [c for c in calls if not waiting[c]], 0
    while ready:
        done.update(dict.fromkeys(ready, wave))
        freed = []
        for need in ready:
            for call in wanted_by.get(need, ()):
                waiting[call] -= 1
                if not waiting[call]:
                    freed.append(call)
        ready, wave = freed, wave + 1
    return done


def waves(calls: DataFrame, peeled: int = PEELED) -> DataFrame:
    """``conv_id, call_id, wave`` of ``calls(conv_id, call_id, turn, needs)``; wave is null on and behind cycles."""
    key = ["conv_id", "call_id"]
    needs = (calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("needs")).alias("need"))
             .join(calls.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("need_turn")), ["conv_id", "need"]))
    place = lambda turn, call: F.struct(F.col(turn).isNotNull(), F.coalesce(turn, F.lit(0)), F.col(call))
    late = needs.where(place("need_turn", "need") >= place("turn", "call_id"))
    tangled = durable(late.select("conv_id").distinct(), "chat-tangled")
    if tangled.isEmpty():
        return calls.select(*key, F.lit(0).alias("wave"))
    left = durable(calls.join(tangled, "conv_id", "left_semi").select(*key), "chat-left")
    edges = durable(needs.join(tangled, "conv_id", "left_semi").select(*key, "need"), "chat-edges")
    plain = calls.join(tangled, "conv_id", "left_anti").select(*key, F.lit(0).alias("wave"))
    rows = left.withColumn("need", F.lit(None).cast("string")).unionByName(edges)
    large = durable(rows.groupBy("conv_id").count().where(F.col("count") > peeled).select("conv_id"), "chat-large")

    def order(own):
        found = peel(own.loc[own["need"].isna(), "call_id"].tolist(), list(own.loc[own["need"].notna(), ["call_id", "need"]].itertuples(index=False, name=None)))
        out = own.loc[own["need"].isna(), key]
        return out.assign(wave=out["call_id"].map(found).astype("Int32"))

    kind = T.StructType([left.schema["conv_id"], left.schema["call_id"], T.StructField("wave", T.IntegerType())])
    small = rows.join(large, "conv_id", "left_anti").groupBy("conv_id").applyInPandas(order, kind)
    return plain.unionByName(small).unionByName(_in_rounds(left.join(large, "conv_id", "left_semi"), edges.join(large, "conv_id", "left_semi")))


def _in_rounds(left: DataFrame, edges: DataFrame) -> DataFrame:
    """Waves of calls ``left`` with ``edges``, one join a wave."""
    key = ["conv_id", "call_id"]
    if left.isEmpty():
        return left.withColumn("wave", F.lit(None).cast("int"))
    done, wave = None, 0
    while True:
        ready = durable(left.join(edges.select(*key), key, "left_anti").withColumn("wave", F.lit(wave)), "chat-ready")
        if ready.isEmpty():
            break
        done = ready if done is None else durable(done.unionByName(ready), "chat-done")
        left = durable(left.join(ready, key, "left_anti"), "chat-left")
        edges = durable(edges.join(ready.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"], "left_anti"), "chat-edges")
        wave += 1
    stuck = left.withColumn("wave", F.lit(None).cast("int"))
    return stuck if done is None else done.unionByName(stuck)


def link(calls: DataFrame, results: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """Calls joined with their results, ordered, validated and serialised.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text). ``results``:
    conv_id, turn, call_id, content. ``tools``: JSON schema of each tool's
    arguments. Gives conv_id, call_id, turn, wave, status, calls, results,
    errors (array) and message (canonical JSON).
    """
    for name, schema in tools.items():
        check_schema(schema, name)
    called = _first(calls, "calls", "name", "arguments")
    called = durable(called.withColumn("read", _reader(tools)("name", "arguments")).drop("arguments"), "chat-calls")
    answered = _first(results, "results", "content").withColumnRenamed("turn", "result_turn")
    ordered = waves(called.select("conv_id", "call_id", "turn", F.col("read.needs").alias("needs")))
    needs = called.select("conv_id", "call_id", F.explode("read.needs").alias("need"))
    unknown = (needs.join(called.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"], "left_anti")
               .groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set(F.concat(F.lit("$ref: "), "need"))).alias("unknown")))
    rows = (called.join(ordered, ["conv_id", "call_id"]).join(unknown, ["conv_id", "call_id"], "left")
            .join(answered.hint("shuffle_hash"), ["conv_id", "call_id"], "full_outer"))
    status = F.when(F.col("calls").isNull(), "orphan").when(F.col("results").isNull(), "unanswered").otherwise("linked")
    none = F.array().cast("array<string>")
    errors = F.concat(F.coalesce("read.errors", none), F.coalesce("unknown", none))
    text = lambda c: F.when(F.col(c).isNull(), "null").otherwise(_string(F.col(c)))
    message = F.concat(F.lit('{"arguments":'), F.coalesce("read.json", F.lit("null")), F.lit(',"call_id":'), text("call_id"),
                       F.lit(',"content":'), text("content"), F.lit(',"name":'), text("name"), F.lit("}"))
    return rows.select("conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "wave", status.alias("status"),
                       F.coalesce("calls", F.lit(0)).alias("calls"), F.coalesce("results", F.lit(0)).alias("results"),
                       errors.alias("errors"), message.alias("message"))


@F.arrow_udf(T.StringType())
def _string(col: pa.Array) -> pa.Array:
    """Canonical JSON strings."""
    return pa.array([None if x is None else json.dumps(x, ensure_ascii=False) for x in col.to_pylist()], pa.string())


# -- turns as calls ---------------------------------------------------------------------------------------

#: Schema of the call that a user's turn stands for.
TURN_TOOLS = {"answer": {"type": "object", "required": ["question", "turn"], "additionalProperties": False,
                         "properties": {"question": {"type": "string", "minLength": 8, "maxLength": 400},
                                        "turn": {"type": "integer", "minimum": 0, "maximum": 1_000_000},
                                        "after": {"type": "string"}}}}


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a plain conversation table (conv_id, turn, role, text).

    Each user turn calls ``answer`` with its text, after the answer two turns
    back; the assistant's turn that follows is the result.
    """
    name = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    asked = turns.where("role = 'user'")
    before = F.when(F.col("turn") >= 2, F.struct(name(F.col("turn") - 2).alias("$ref")))
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text").alias("question"), before.alias("after")))
    calls = asked.select("conv_id", "turn", name(F.col("turn")).alias("call_id"), F.lit("answer").alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
