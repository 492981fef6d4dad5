"""Chat messages with linked tool calls, as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefold.llm.common import stored

#: Frames of settled calls that are put together at a time.
MERGED = 32
_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
}


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces, and characters as they are; numbers that are not finite raise."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def problems(value: Any, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks ``schema``: type, enum, required, properties, additionalProperties, items, minimum, maximum, minLength, maxLength."""
    wanted = schema.get("type")
    kinds = [wanted] if isinstance(wanted, str) else wanted or []
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not {'/'.join(kinds)}"]
    found = [f"{at}: not in enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            found += [f"{at}.{k}: unknown" for k in sorted(value) if k not in properties]
        for k in sorted(value):
            if k in properties:
                found += problems(value[k], properties[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{at}: below minimum"] if "minimum" in schema and value < schema["minimum"] else []
        found += [f"{at}: above maximum"] if "maximum" in schema and value > schema["maximum"] else []
    if isinstance(value, str):
        found += [f"{at}: too short"] if len(value) < schema.get("minLength", 0) else []
        found += [f"{at}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    return found


def checked_arguments(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[str]]:
    """Canonical arguments (null if they are no JSON) and what is wrong with them."""
    try:
        value = json.loads(arguments or "")
        text = canonical(value)
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]
    return text, problems(value, schemas[name]) if name in schemas else [f"$: unknown tool {name}"]


def depths(calls: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``conv_id, call_id, depth`` of calls with ``needs`` (call ids that must come first); null on or behind a cycle.

    Depth 0 needs nothing known. Each round drops the needs settled in the round before
    and settles the calls that have none left, by joins on (conversation, call): calls
    are spread by call, so a very long conversation is not one task, and settled calls
    are not written again in every round. Rounds end when nothing settles, however deep
    that is; only with ``max_depth`` deeper chains raise.
    """
    keys = ["conv_id", "call_id"]
    known = calls.select(*keys)
    links = calls.select(*keys, F.explode(F.array_distinct("needs")).alias("need"))
    links = stored(links.join(known.toDF("conv_id", "need"), ["conv_id", "need"], "left_semi").select(*keys, "need"))
    open_ = stored(links.select(*keys).distinct())
    ready = known.join(open_, keys, "left_anti")
    first, deeper, depth = ready.withColumn("depth", F.lit(0)), [], 0
    while not open_.isEmpty():
        links = stored(links.join(ready.toDF("conv_id", "need"), ["conv_id", "need"], "left_anti").select(*keys, "need"))
        ready = stored(open_.join(links, keys, "left_anti"))
        if ready.isEmpty():
            break
        depth += 1
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"calls depend on each other over more than {max_depth} steps")
        deeper.append(ready.withColumn("depth", F.lit(depth)))
        if len(deeper) == MERGED:
            deeper = [stored(reduce(DataFrame.unionByName, deeper))]
        open_ = stored(open_.join(ready, keys, "left_anti"))
    return reduce(DataFrame.unionByName, deeper, first).unionByName(open_.withColumn("depth", F.lit(None).cast("int")))


def format_chats(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Messages in an order in which results follow their calls, each as canonical JSON.

    ``messages``: ``conv_id, turn, role, content``, ``calls`` (array of ``call_id, name,
    arguments, needs``) and, on rows that report a tool's result, ``call_id``.

    Calls and results meet by ``(conv_id, call_id)``. Returned rows: ``conv_id, turn,
    depth, call_id, part`` (their order: a message, then its calls by depth and
    identifier, each followed by its result), ``role``, ``status`` and ``json``.
    Status of a message is ``message``; of a call ``linked``, ``unanswered``,
    ``invalid`` (arguments break their schema or are no JSON; ``problems`` tells
    where) or ``cyclic``; of a result ``result``, or ``orphan`` for one without call,
    which stays at its own turn. Of calls that repeat an identifier the first counts
    (smallest turn, name, arguments), the others are ``repeated``; the same for
    results. Nulls: a null role or content is JSON null; calls with a null conversation
    or identifier are ``unlinked``, such results ``orphan``; an empty table gives no rows.
    """
    base = stored(messages.select("conv_id", "turn", "role", "content", "calls", "call_id"))
    plain = base.filter("call_id is null").select("conv_id", "turn", "role", "content")
    calls = base.filter("call_id is null").select("conv_id", "turn", F.explode("calls").alias("c")).select("conv_id", "turn", "c.call_id", "c.name", "c.arguments", F.coalesce("c.needs", F.array().cast("array<string>")).alias("needs"))
    results = base.filter("call_id is not null").select("conv_id", "turn", "call_id", "role", "content")
    keys = ["conv_id", "call_id"]
    known = (F.col("conv_id").isNotNull()) & (F.col("call_id").isNotNull())
    first_call = calls.filter(known).groupBy(*keys).agg(F.min(F.struct("turn", "name", "arguments", "needs")).alias("first"), F.count("*").alias("n_calls"))
    first_result = results.filter(known).groupBy(*keys).agg(F.min(F.struct("turn", "role", "content")).alias("answer"), F.count("*").alias("n_results"))
    linked = stored(first_call.join(first_result, keys, "left").join(depths(first_call.select(*keys, "first.needs")), keys))

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = [checked_arguments(n, a, schemas) for n, a in zip(frame["name"], frame["arguments"], strict=True)]
            text = [canonical({"arguments": json.loads(x) if x is not None else a, "id": i, "name": n}) for (x, _), a, i, n in zip(pairs, frame["arguments"], frame["call_id"], frame["name"], strict=True)]
            yield frame.assign(json=text, problems=[p for _, p in pairs])

    types = dict(base.dtypes)
    fields = f"conv_id {types['conv_id']}, call_id {types['call_id']}, turn {types['turn']}, depth int, name string, arguments string, answered boolean, json string, problems array<string>"
    call_rows = linked.select(*keys, F.col("first.turn").alias("turn"), "depth", F.col("first.name").alias("name"), F.col("first.arguments").alias("arguments"), F.col("answer").isNotNull().alias("answered"))
    call_rows = call_rows.mapInPandas(written, fields)
    status = F.when(F.col("depth").isNull(), "cyclic").when(F.size("problems") > 0, "invalid").when(F.col("answered"), "linked").otherwise("unanswered")
    nothing = F.array().cast("array<string>")

    def message(*extra):
        return F.struct(*extra, "content", "role")

    def as_text(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(json=[canonical(json.loads(x)) for x in frame["json"]])

    def serialised(df: DataFrame) -> DataFrame:
        out = df.withColumn("json", F.to_json("body", {"ignoreNullFields": "false"})).drop("body")
        return out.mapInPandas(as_text, out.schema)

    none = F.lit(None)
    order = ["conv_id", "turn", "depth", "call_id", "part", "role", "status", "json", "problems"]
    said = serialised(plain.select("conv_id", "turn", none.cast("int").alias("depth"), none.cast(types["call_id"]).alias("call_id"), F.lit(0).alias("part"), "role", F.lit("message").alias("status"), message().alias("body"), nothing.alias("problems")))
    called = call_rows.select("conv_id", "turn", "depth", "call_id", F.lit(1).alias("part"), F.lit("assistant").alias("role"), status.alias("status"), "json", "problems")
    answers = linked.filter("answer is not null").select("conv_id", F.col("first.turn").alias("turn"), "depth", "call_id", F.col("answer.role").alias("role"), F.col("answer.content").alias("content"))
    lonely = results.join(first_call.select(*keys), keys, "left_anti").select("conv_id", "turn", none.cast("int").alias("depth"), "call_id", "role", "content")
    told = serialised(
        answers.withColumn("status", F.lit("result")).unionByName(lonely.withColumn("status", F.lit("orphan")))
        .select("conv_id", "turn", "depth", "call_id", F.lit(2).alias("part"), "role", "status", message("call_id").alias("body"), nothing.alias("problems"))
    )
    extra = serialised(
        _others(calls, first_call, "first", ["turn", "name", "arguments", "needs"]).select("conv_id", "turn", none.cast("int").alias("depth"), "call_id", F.lit(3).alias("part"), F.lit("assistant").alias("role"), F.when(known, "repeated").otherwise("unlinked").alias("status"), F.struct("arguments", "call_id", "name").alias("body"), nothing.alias("problems"))
    ).unionByName(serialised(
        _others(results.join(first_call.select(*keys), keys, "left_semi"), first_result, "answer", ["turn", "role", "content"]).select("conv_id", "turn", none.cast("int").alias("depth"), "call_id", F.lit(4).alias("part"), "role", F.lit("repeated").alias("status"), message("call_id").alias("body"), nothing.alias("problems"))
    ))
    return said.select(*order).unionByName(called.select(*order)).unionByName(told.select(*order)).unionByName(extra.select(*order))


def _others(rows: DataFrame, first: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Rows besides the first of their key; of rows equal to the first all but one."""
    counted = rows.groupBy("conv_id", "call_id", *columns).agg(F.count("*").alias("n"))
    joined = counted.join(first.select("conv_id", "call_id", name), ["conv_id", "call_id"], "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"{name}.{c}"))
    times = F.when(F.col(name).isNotNull() & same, F.col("n") - 1).otherwise(F.col("n")).cast("int")
    return joined.withColumn("_i", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")))).drop("_i", "n", name)
