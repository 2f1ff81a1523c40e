"""Tool calls in conversations: link calls to results, order them, validate, serialise.

Messages carry calls (id, name, arguments as JSON text) or the id of the call whose result they
are. Calls and results meet by a hash join on (conversation, identifier). Dependencies run from
a call to its result and from a call to calls whose arguments mention its identifier as
``{"$ref": id}``. Almost all of them point back in the conversation already; only records
that depend on a later one, and what depends on those, are ordered in rounds (Kahn), so that a
conversation of a third of all rows needs no group of its own. Each record is one row with a
sort key; records of a conversation sorted by it are in topological order.
"""

from __future__ import annotations

import json
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.session import stage

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict,
         "array": list, "null": type(None)}


DEPTH = 100   # of lists and objects in arguments


def problems(value: Any, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a schema: type, enum, minimum, maximum, required, properties,
    additionalProperties (false) and items are understood."""
    kind = schema.get("type")
    if kind:
        right = isinstance(value, TYPES[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))
        if not right:
            return [f"{at}: not {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{at}: below minimum"] * (value < schema.get("minimum", value))
        out += [f"{at}: above maximum"] * (value > schema.get("maximum", value))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: not known")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += problems(v, schema["items"], f"{at}[{i}]")
    return out


def _pairs(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key twice")
    return out


def _refuse(text: str) -> None:
    raise ValueError(f"{text} is not JSON")


def parsed(text: str | None) -> Any:
    """JSON without repeated keys, NaN or infinities."""
    return json.loads(text or "", object_pairs_hook=_pairs, parse_constant=_refuse)


def bounded(value: Any) -> Any:
    """The value, unless lists and objects lie more than DEPTH deep in each other."""
    level = [value]
    for _ in range(DEPTH + 1):
        level = [v for outer in level if isinstance(outer, (dict, list))
                 for v in (outer.values() if isinstance(outer, dict) else outer)]
        if not level:
            return value
    raise ValueError("too deep")


def canonical(value: Any) -> str:
    """Keys sorted by code point, no white space, text as it is; a half of a surrogate pair is no text."""
    made = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    made.encode()
    return made


def references(value: Any) -> list[str]:
    """Identifiers that a value mentions as {"$ref": id}."""
    if isinstance(value, dict):
        own = [value["$ref"]] if isinstance(value.get("$ref"), str) else []
        return own + [r for k in sorted(value) for r in references(value[k])]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def checked(records: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Adds ``arguments_json`` (canonical, null if not JSON), ``issues`` and ``refs`` to calls.

    Arguments that are nested more than DEPTH deep, or that hold half a surrogate pair, are not JSON.
    """
    kind = T.StructType([T.StructField("arguments_json", T.StringType()),
                         T.StructField("issues", T.ArrayType(T.StringType())),
                         T.StructField("refs", T.ArrayType(T.StringType()))])

    @F.arrow_udf(kind)
    def check(name: pa.Array, arguments: pa.Array) -> pa.Array:
        rows = []
        for tool, text in zip(name.to_pylist(), arguments.to_pylist()):
            try:
                value = bounded(parsed(text))
                own = canonical(value)
            except (ValueError, RecursionError):
                rows.append({"arguments_json": None, "issues": ["$: not JSON"], "refs": []})
                continue
            found = problems(value, schemas[tool]) if tool in schemas else ["tool not known"]
            rows.append({"arguments_json": own, "issues": found, "refs": sorted(set(references(value)))})
        return pa.array(rows, pa.struct([("arguments_json", pa.string()), ("issues", pa.list_(pa.string())),
                                         ("refs", pa.list_(pa.string()))]))

    return records.withColumn("_check", check("name", "arguments")).select("*", "_check.*").drop("_check")


def ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, ready, level, cyclic) for nodes (node, place) and edges (first, then).

    ``place`` is unique and rises along the conversation. (ready, level, place) sorts every
    record behind those it depends on: ready is the greatest place among it and all it depends
    on, level counts rounds where that does not suffice. Records on a cycle or behind one are
    marked and keep their place.
    """
    edges = stage(
        edges.distinct().join(nodes.select(F.col("node").alias("first"), F.col("place").alias("p1")), "first")
        .join(nodes.select(F.col("node").alias("then"), F.col("place").alias("p2")), "then"))
    # What depends on a later record, directly or through others.
    new = stage(edges.where("p1 >= p2").select(F.col("then").alias("node")).distinct())
    late = new
    while not new.isEmpty():
        new = stage(edges.join(new, edges["first"] == new["node"], "left_semi").select(F.col("then").alias("node"))
                    .distinct().join(late, "node", "left_anti"))
        late = stage(late.union(new))
    if late.isEmpty():
        return nodes.select("node", F.col("place").alias("ready"), F.lit(0).alias("level"), F.lit(False).alias("cyclic"))
    own = stage(edges.join(late.withColumnRenamed("node", "then"), "then"))
    done = late.limit(0).join(nodes, "node").select("node", F.col("place").alias("ready"), F.lit(0).alias("level"))
    left = late.join(nodes, "node")
    while True:
        left = stage(left.join(done.select("node"), "node", "left_anti"))
        # The records whose every need is either in place or done.
        need = own.join(left.select(F.col("node").alias("then"), "place"), "then").join(
            late.select(F.col("node").alias("first"), F.lit(True).alias("is_late")), "first", "left").join(
            done.select(F.col("node").alias("first"), "ready", "level"), "first", "left")
        free = need.groupBy("then").agg(
            F.max(F.expr("is_late and ready is null")).alias("waits"), F.first("place").alias("place"),
            F.max(F.coalesce("ready", "p1")).alias("before"), F.max(F.coalesce("level", F.lit(0))).alias("under"),
        ).where("waits is null or not waits").select(
            F.col("then").alias("node"), F.greatest("place", "before").alias("ready"), (F.col("under") + 1).alias("level"))
        more = stage(free)
        if more.isEmpty():
            break
        done = stage(done.union(more))
    moved = done.select("node", "ready", "level", F.lit(False).alias("cyclic"))
    stuck = left.select("node", F.col("place").alias("ready"), F.lit(0).alias("level"), F.lit(True).alias("cyclic"))
    still = nodes.join(late, "node", "left_anti").select(
        "node", F.col("place").alias("ready"), F.lit(0).alias("level"), F.lit(False).alias("cyclic"))
    return still.unionByName(moved).unionByName(stuck)


def linked(messages: DataFrame, schemas: dict[str, dict], plain: bool = False) -> DataFrame:
    """One row for each call and result of messages (conv_id, turn, calls, result_of, text) and,
    with ``plain``, for each message that is neither.

    ``calls`` is array<struct<id, name, arguments>>. Columns: conv_id, turn, kind (call,
    result or message), call_id, name, status, issues, arguments_json, order_turn, order_level,
    order_ready, order_place, record: the canonical JSON of the record. (order_ready, order_level,
    order_place) sorts a conversation so that every record is behind those it depends on;
    ready and place are structs of turn, row and the call's place in its message. Status: ``ok``; ``invalid`` arguments; ``no_result``;
    ``duplicate`` for another call or result of an identifier that an earlier one has;
    ``no_call`` for a result without a call; ``no_id``; ``unknown_ref`` for arguments that mention
    no call of the conversation; ``cyclic``. The first that holds, in the order cyclic, no_id,
    duplicate, invalid, unknown_ref, no_call, no_result. Plain messages are ``ok``; in their record the
    id is ``message-`` and their turn. Null conversations are one of their own.
    """
    base = messages.select("conv_id", "turn", "calls", "result_of", "text",
                           F.monotonically_increasing_id().alias("_row"))
    calls = base.select("conv_id", "turn", "_row", F.posexplode("calls").alias("pos", "c")).select(
        "conv_id", "turn", "_row", "pos", F.lit("call").alias("kind"), F.col("c.id").alias("call_id"), "c.name",
        "c.arguments", F.lit(None).cast("string").alias("text"))
    results = base.where("result_of is not null").select(
        "conv_id", "turn", "_row", F.lit(-1).alias("pos"), F.lit("result").alias("kind"),
        F.col("result_of").alias("call_id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), "text")
    if plain:
        neither = F.col("result_of").isNull() & (F.coalesce(F.size("calls"), F.lit(0)) <= 0)
        results = results.unionByName(base.where(neither).select(
            "conv_id", "turn", "_row", F.lit(-1).alias("pos"), F.lit("message").alias("kind"), "text"),
            allowMissingColumns=True)
    records = stage(checked(calls, schemas).unionByName(results, allowMissingColumns=True)
                    .withColumn("conv_key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))))
    place = F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "_row", "pos").alias("place")
    nodes = records.select("conv_key", "call_id", "kind", "refs", place, F.struct("_row", "pos", "kind").alias("node"))
    heads = stage(nodes.where("call_id is not null").groupBy("conv_key", "call_id", "kind").agg(
        F.min_by("node", "place").alias("head")))
    call_heads = heads.where("kind = 'call'").select("conv_key", "call_id", F.col("head").alias("first"))
    # An identifier's first call comes before its first result; calls after the calls they mention.
    edges = heads.where("kind = 'result'").join(call_heads, ["conv_key", "call_id"]).select(
        "first", F.col("head").alias("then"))
    mention = nodes.where("kind = 'call'").select("conv_key", F.explode("refs").alias("call_id"), F.col("node").alias("then"))
    met = mention.join(call_heads, ["conv_key", "call_id"], "left")
    edges = edges.unionByName(met.where("first is not null").select("first", "then"))
    order = ordered(nodes.select("node", "place"), edges)
    lost = met.where("first is null").select(F.col("then").alias("node")).distinct().withColumn("lost", F.lit(True))
    both = heads.groupBy("conv_key", "call_id").agg(
        F.max(F.when(F.col("kind") == "call", F.col("head"))).alias("call_head"),
        F.max(F.when(F.col("kind") == "result", F.col("head"))).alias("result_head"))
    rows = (
        records.withColumns({"node": F.struct("_row", "pos", "kind"), "place": place})
        .join(both, ["conv_key", "call_id"], "left").join(order, "node").join(lost, "node", "left")
    )
    own = F.when(F.col("kind") == "call", F.col("call_head")).otherwise(F.col("result_head"))
    status = (
        F.when(F.col("kind") == "message", "ok").when(F.col("cyclic"), "cyclic").when(F.col("call_id").isNull(), "no_id")
        .when(own != F.col("node"), "duplicate").when(F.size("issues") > 0, "invalid")
        .when(F.col("lost"), "unknown_ref")
        .when((F.col("kind") == "result") & F.col("call_head").isNull(), "no_call")
        .when((F.col("kind") == "call") & F.col("result_head").isNull(), "no_result").otherwise("ok"))
    rows = rows.withColumn("status", status)

    @F.arrow_udf(T.StringType())
    def record(turn: pa.Array, kind: pa.Array, call_id: pa.Array, name: pa.Array, arguments: pa.Array, text: pa.Array,
               state: pa.Array) -> pa.Array:
        out = []
        for at, k, i, n, a, t, s in zip(*(x.to_pylist() for x in (turn, kind, call_id, name, arguments, text, state))):
            i = f"message-{'null' if at is None else at}" if k == "message" else i
            body = {"id": i, "status": s, "type": k}
            body |= {"name": n, "arguments": json.loads(a) if a is not None else None} if k == "call" else {"content": t}
            out.append(canonical(body))
        return pa.array(out, pa.string())

    return rows.select(
        "conv_id", "turn", "kind", "call_id", "name", "status", "issues", "arguments_json",
        F.col("ready.turn").alias("order_turn"), F.col("level").alias("order_level"),
        F.col("ready").alias("order_ready"), F.col("place").alias("order_place"),
        record("turn", "kind", "call_id", "name", "arguments_json", "text", "status").alias("record"))
