"""Chat formatting with tool-call linking.

Turns become messages, one row each, with canonical JSON (keys sorted, no spaces,
UTF-8). A turn's text may carry tool calls and results:

* ``<tool_call>{"id": ..., "name": ..., "arguments": {...}, "after": [...]}</tool_call>``
  inside any text; ``after`` and every ``{"$ref": "<id>"}`` within the arguments name
  calls of the same conversation that must come before;
* ``<tool_result>{"id": ..., "content": ...}</tool_result>`` likewise, or a turn of role
  ``tool`` whose whole text is such an object.

Calls and results are hash-joined by (conversation, id). Calls are ordered
topologically by rounds of joins (a call's level is one more than the highest level
of those it waits for), so that a long conversation is never gathered. Arguments are
validated against the tool's schema, given or declared by the conversation itself: ``<tools>[{"name":
..., "parameters": {schema}}, ...]</tools>`` in a turn of role ``system``, joined by (conversation, name).
Problems are listed, nothing is dropped.

Edge cases: a null role is ``unknown``, a null text empty content; markup that is not valid
JSON, or is nested more than ``MAX_DEPTH`` levels, stays part of the text and is reported (NaN,
Infinity and numbers beyond the range of a double are not valid); half a surrogate pair becomes U+FFFD; of calls or results that repeat an
id the first in (turn, place) order is linked and the others are reported; calls in
a cycle keep their place after all others, with ``cycle``; repeated turns stay, each
a message; without a conversation id nothing is linked; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.llm.components import staged
from hoodcast.llm.registry import query, table
from hoodcast.session import ensure_checkpoint_dir

_MARK = re.compile(r"<tool_(call|result)>(.*?)</tool_\1>|<tools>(?P<tools>.*?)</tools>", re.S)
_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


#: Levels of arrays and objects that markup may have.
MAX_DEPTH = 64


def canonical_json(value) -> str:
    """Sorted keys, no spaces, characters as they are; whole numbers without a fraction."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical_json(k)}:{canonical_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        value = int(value)
    return json.dumps(value, ensure_ascii=False)


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, int) and not isinstance(value, bool) or \
            isinstance(value, float) and (kind == "number" or value.is_integer())
    return kind in _TYPES and isinstance(value, _TYPES[kind])


def violations(value, schema: dict, at: str = "arguments") -> list[str]:
    """What in ``value`` breaks a JSON schema of types (one or a list), properties, required,
    additionalProperties, items, enum, minimum and maximum. What is no schema allows anything."""
    if not isinstance(schema, dict) or isinstance(value, dict) and set(value) == {"$ref"}:
        return []  # a $ref is the value of an earlier call, known only when it ran
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else [k for k in kinds if isinstance(k, str)] if isinstance(kinds, list) else []
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if isinstance(schema.get("enum"), list) and canonical_json(value) not in map(canonical_json, schema["enum"]):
        out.append(f"{at}: not in enum")
    if _is(value, "number"):
        low, high = (schema.get(k) if _is(schema.get(k), "number") else value for k in ("minimum", "maximum"))
        if value < low or value > high:
            out.append(f"{at}: out of range")
    if isinstance(value, dict):
        known = schema.get("properties") if isinstance(schema.get("properties"), dict) else {}
        required = schema.get("required") if isinstance(schema.get("required"), list) else []
        out += [f"{at}.{k}: missing" for k in required if isinstance(k, str) and k not in value]
        for k, v in sorted(value.items()):
            if k in known:
                out += violations(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return out


def _refs(value) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        return set().union(*map(_refs, value.values())) if value else set()
    return set().union(*map(_refs, value)) if isinstance(value, list) and value else set()


def _depth(value, limit: int) -> int:
    """Levels of nesting, counted to ``limit`` + 1 at most."""
    level, here = 0, [value]
    while here and level <= limit:
        here = [x for v in here if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        level += bool(here)
    return level


def _whole(value):
    """Half surrogate pairs replaced, in keys too."""
    if isinstance(value, str):
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    if isinstance(value, list):
        return [_whole(v) for v in value]
    return {_whole(k): _whole(v) for k, v in value.items()} if isinstance(value, dict) else value


def _finite(number: str) -> float:
    if math.isinf(value := float(number)):
        raise ValueError(number)
    return value


def _refuse(constant: str):
    raise ValueError(constant)


def _json(raw: str):
    """(value, problem)."""
    try:
        value = json.loads(raw, parse_float=_finite, parse_constant=_refuse)
        if _depth(value, MAX_DEPTH) > MAX_DEPTH:
            return None, "too deep"
    except RecursionError:
        return None, "too deep"
    except ValueError:
        return None, "malformed"
    return (_whole(value) if "\\" in raw else value), None


def _object(raw: str, needed: tuple[str, ...]):
    value, problem = _json(raw)
    if problem is None and not (isinstance(value, dict) and isinstance(value.get("id"), str) and all(k in value for k in needed)):
        problem = "malformed"
    return value, problem


def _declared(raw: str):
    """[(name, schema)] of a declaration, or a problem."""
    value, problem = _json(raw)
    if problem is None and not (isinstance(value, list) and all(isinstance(x, dict) and isinstance(x.get("name"), str) for x in value)):
        problem = "malformed"
    return problem or [(x["name"], x.get("parameters", {})) for x in value]


def parse(role: str, text: str) -> list[tuple]:
    """(place, kind, call id or tool name, body as JSON, ids waited for, problems) of a turn's parts."""
    if role == "tool":
        whole, problem = _object(text, ("content",))
        if not problem:
            return [(0, "result", whole["id"], canonical_json(whole["content"]), [], [])]
    out, rest, at = [], [], 0
    problems = []
    for m in _MARK.finditer(text):
        kind = "tools" if m["tools"] is not None else m[1]
        if kind == "tools":
            if role != "system":
                continue
            value, problem = _declared(m["tools"]), None
            if isinstance(value, str):
                problem = value
        else:
            value, problem = _object(m[2], ("name",) if kind == "call" else ("content",))
        if problem:
            problems.append(f"{problem} {kind}")
            continue
        place = len(out) + 1
        if kind == "tools":  # the declaration stays part of its message
            out += [(place + k, "tool", name, canonical_json(schema), [], []) for k, (name, schema) in enumerate(value)]
            continue
        rest.append(text[at:m.start()])
        at = m.end()
        if kind == "result":
            out.append((place, kind, value["id"], canonical_json(value["content"]), [], []))
            continue
        arguments, name = value.get("arguments", {}), value["name"] if isinstance(value["name"], str) else canonical_json(value["name"])
        after = value.get("after") if isinstance(value.get("after"), list) else []
        waits = sorted(_refs(arguments) | {x for x in after if isinstance(x, str)})
        out.append((place, kind, value["id"], canonical_json({"arguments": arguments, "name": name}), waits, []))
    rest.append(text[at:])
    return [(0, "text", None, canonical_json("".join(rest)), [], problems), *out]


_PARTS = "conv {0}, turn {1}, role string, place int, kind string, call_id string, body string, " \
         "waits array<string>, problems array<string>"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv", "turn", "role", "place", "kind", "call_id", "body", "waits", "problems"]
    for b in batches:
        source, rows = [], []
        for i, (role, text) in enumerate(zip(b.column("role").to_pylist(), b.column("text").to_pylist())):
            role = "unknown" if role is None else role
            for part in parse(role, text or ""):
                source.append(i)
                rows.append((role, *part))
        at = pa.array(source, pa.int64())
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(),
                 pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([b.column("conv").take(at), b.column("turn").take(at),
                                          *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)


def _validate(tools: dict[str, dict] | None):
    """Problems of calls: rows (call, body, schema, declares) -> (call, wrong)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wrong = []
            for body, schema, declares in zip(*(b.column(c).to_pylist() for c in ("body", "schema", "declares"))):
                call = json.loads(body)
                known = {**(tools or {}), **({call["name"]: json.loads(schema)} if schema is not None else {})}
                wrong.append(violations(call["arguments"], known[call["name"]]) if call["name"] in known
                             else ["unknown tool"] if declares or tools is not None else [])
            yield pa.RecordBatch.from_arrays([b.column("call"), pa.array(wrong, pa.list_(pa.string()))], ["call", "wrong"])
    return run


def _validated(parts: DataFrame, tools: dict[str, dict] | None, path: str) -> DataFrame:
    """(conv, turn, place, wrong) of the calls that break their tool's schema."""
    declared = parts.where("kind = 'tool' AND conv IS NOT NULL").groupBy("conv", F.col("call_id").alias("tool")).agg(
        F.min_by("body", F.struct("turn", "place")).alias("schema"))
    declared = staged(declared, os.path.join(path, "tools"))
    calls = parts.where("kind = 'call'").select(
        F.struct("conv", "turn", "place").alias("call"), "conv", F.get_json_object("body", "$.name").alias("tool"), "body")
    calls = calls.join(declared, ["conv", "tool"], "left").join(
        declared.select("conv", F.lit(True).alias("declares")).distinct(), "conv", "left")
    kind = dict(parts.dtypes)
    wrong = calls.select("call", "body", "schema", "declares").mapInArrow(
        _validate(tools), f"call struct<conv:{kind['conv']},turn:{kind['turn']},place:int>, wrong array<string>")
    # a call is known by its place; repeated turns have the same problems
    return staged(wrong.where("size(wrong) > 0").select("call.*", "wrong").distinct(), os.path.join(path, "wrong"))


def _levels(calls: DataFrame, path: str) -> DataFrame:
    """(conv, call_id, level) by rounds: a call is placed once all it waits for are; those
    never placed are in a cycle (or wait for one) and are left out."""
    edges = calls.select("conv", "call_id", F.explode("waits").alias("wait"))
    known = calls.select("conv", F.col("call_id").alias("wait"))
    edges = staged(edges.join(known, ["conv", "wait"], "left_semi").distinct(), os.path.join(path, "edges"))
    nodes = calls.select("conv", "call_id")
    placed = staged(nodes.join(edges.select("conv", "call_id").distinct(), ["conv", "call_id"], "left_anti")
                    .withColumn("level", F.lit(0)), os.path.join(path, "level0"))
    level = 0
    while not edges.isEmpty():
        level += 1
        done = placed.select("conv", F.col("call_id").alias("wait"))
        waiting = edges.join(done, ["conv", "wait"], "left_anti")
        ready = edges.select("conv", "call_id").distinct() \
            .join(waiting.select("conv", "call_id").distinct(), ["conv", "call_id"], "left_anti") \
            .join(placed.select("conv", "call_id"), ["conv", "call_id"], "left_anti").withColumn("level", F.lit(level))
        ready = staged(ready, os.path.join(path, f"ready{level}"))
        if ready.isEmpty():
            break
        placed = placed.union(ready)
        edges = staged(edges.join(ready.select("conv", "call_id"), ["conv", "call_id"], "left_anti"),
                       os.path.join(path, f"edges{level}"))
    return placed


def format_chat(turns: DataFrame, tools: dict[str, dict] | None = None, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: (conversation, turn, place, level, role, json, linked, problems).

    Messages of a conversation read in the order (turn, level, place); ``level`` is 0 but for
    calls that wait for others, ``linked`` says whether a call has its result or a result its call.
    """
    spark = turns.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "chat", uuid.uuid4().hex)
    kinds = dict(turns.dtypes)
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    parts = staged(rows.mapInArrow(_split, _PARTS.format(kinds[conv_col], kinds[turn_col])),
                   os.path.join(path, "parts"))
    wrong = _validated(parts, tools, path)
    parts = parts.where("kind <> 'tool'")
    marked = parts.where("call_id IS NOT NULL AND conv IS NOT NULL")
    # of equal ids the first counts; a grouped minimum, no window over a conversation
    firsts = marked.groupBy("conv", "kind", "call_id").agg(
        F.min(F.struct("turn", "place")).alias("first"), F.min_by("waits", F.struct("turn", "place")).alias("waits"))
    firsts = staged(firsts, os.path.join(path, "firsts"))
    calls = firsts.where("kind = 'call'").select("conv", "call_id", "waits", F.col("first").alias("called"))
    results = firsts.where("kind = 'result'").select("conv", "call_id", F.col("first").alias("answered"))
    levels = _levels(calls, path)
    links = calls.select("conv", "call_id", "called").join(results, ["conv", "call_id"], "full") \
        .join(levels, ["conv", "call_id"], "left")
    links = staged(links, os.path.join(path, "links")).withColumnsRenamed({"conv": "l_conv", "call_id": "l_id"})
    wrong = wrong.select(*[F.col(c).alias(f"w_{c}") for c in ("conv", "turn", "place")], "wrong")
    parts = parts.join(wrong, parts.conv.eqNullSafe(wrong.w_conv) & parts.turn.eqNullSafe(wrong.w_turn)
                       & (parts.place == wrong.w_place), "left")
    j = parts.join(links, (parts.conv == links.l_conv) & (parts.call_id == links.l_id), "left")
    here = F.struct("turn", "place")
    own = F.when(F.col("kind") == "call", F.col("called")).otherwise(F.col("answered"))
    repeated = (F.col("kind") != "text") & (own != here)
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    problem = lambda when, what: F.when(when, F.lit(what))
    found = F.array_compact(F.array(
        problem(repeated, "repeated id"),
        problem(call & F.col("answered").isNull(), "no result"),
        problem(result & F.col("called").isNull(), "no call"),
        problem(result & (F.col("answered") < F.col("called")), "result before call"),
        problem(call & F.col("called").isNotNull() & F.col("level").isNull(), "cycle")))
    role_json = F.expr("regexp_replace(to_json(struct(role AS v)), '^.\"v\":|.$', '')")
    id_json = F.expr("regexp_replace(to_json(struct(call_id AS v)), '^.\"v\":|.$', '')")
    message = F.when(call, F.concat(F.lit('{"call":'), "body", F.lit(',"id":'), id_json, F.lit(',"role":'), role_json,
                                    F.lit("}"))) \
        .when(result, F.concat(F.lit('{"content":'), "body", F.lit(',"id":'), id_json, F.lit(',"role":'), role_json,
                               F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"content":'), "body", F.lit(',"role":'), role_json, F.lit("}")))
    return j.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "place",
        F.when(call, F.coalesce("level", F.lit(1 << 30))).otherwise(0).alias("level"), "role", message.alias("json"),
        F.when(F.col("kind") != "text", F.col("called").isNotNull() & F.col("answered").isNotNull() & ~repeated)
        .alias("linked"), F.concat("problems", F.coalesce("wrong", F.array().cast("array<string>")), found).alias("problems"))


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per conversation: a JSON array of its messages in order. A conversation then has
    to fit a row; the message rows of ``format_chat`` have no such limit."""
    ordered = F.sort_array(F.collect_list(F.struct(turn_col, "level", "place", "json")))
    return messages.groupBy(conv_col).agg(
        F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda m: m["json"]), ","), F.lit("]")).alias("json"))


ORACLE = """
SELECT conv_id, turn, 0::INT AS place, 0::INT AS level, coalesce(role, 'unknown') AS role,
       '{"content":' || to_json(coalesce(text, ''))::VARCHAR || ',"role":'
           || to_json(coalesce(role, 'unknown'))::VARCHAR || '}' AS json,
       NULL::BOOLEAN AS linked, 0::BIGINT AS n_problems
FROM conversations"""


@query("op6_chat_formatting", ORACLE)
def op6(spark, sf_dir):
    out = format_chat(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "turn", "place", "level", "role", "json", "linked",
                      F.size("problems").cast("long").alias("n_problems"))
