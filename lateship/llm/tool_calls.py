"""Chat formatting: tool calls linked to their results, ordered, validated.

* Calls and results are joined on the conversation and the call identifier;
  repeated results of one identifier are folded into the first before the
  join, so a join never multiplies rows.
* Arguments are parsed and validated against the tool's schema, and references
  to other calls (``{"$ref": "<call id>"}``) are gathered, in one Arrow pass.
* A conversation whose references all point to earlier calls is in topological
  order by position already. The others are peeled level by level with joins
  over calls and references; each level is written to the shared folder. No
  conversation is ever gathered into one task.
* Each call becomes one message in canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .components import dropped, saved

CHECKED = StructType([
    StructField("errors", ArrayType(StringType())), StructField("refs", ArrayType(StringType())),
    StructField("canonical", StringType()),
])


def canonical(value) -> str:
    """Canonical JSON: keys sorted by code point, no spaces, no escapes but the needed ones."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parse_json(text: str):
    """Strict JSON: no NaN or Infinity, no repeated keys."""
    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("repeated key")
        return out

    def constant(name):
        raise ValueError(f"{name} is not JSON")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant)


_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool), "boolean": lambda v: isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool), "null": lambda v: v is None,
}


def is_ref(value) -> bool:
    return isinstance(value, dict) and list(value) == ["$ref"] and isinstance(value["$ref"], str)


def _broken(value, schema: dict, at: str) -> tuple[list[str], list[tuple]]:
    """What is wrong with ``value`` itself, and what remains to be looked at:
    ``(value, schema, place)`` of its parts, or a message, in order."""
    if is_ref(value):
        return [], []
    kind = schema.get("type")
    if kind and not any(_TYPES[k](value) for k in ([kind] if isinstance(kind, str) else kind)):
        return [f"{at}: not of type {kind}"], []
    errors, parts = [], []
    if "enum" in schema and not any(value == e and type(value) is type(e) for e in schema["enum"]):
        errors.append(f"{at}: not one of the allowed values")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0) or len(value) > schema.get("maxLength", len(value)):
            errors.append(f"{at}: length out of bounds")
    elif _TYPES["number"](value):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            errors.append(f"{at}: out of bounds")
    elif isinstance(value, list):
        if len(value) < schema.get("minItems", 0) or len(value) > schema.get("maxItems", len(value)):
            errors.append(f"{at}: number of items out of bounds")
        if schema.get("items"):
            parts = [(x, schema["items"], f"{at}[{i}]") for i, x in enumerate(value)]
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                parts.append((value[k], known[k], f"{at}.{k}"))
            elif schema.get("additionalProperties", True) is False:
                parts.append((f"{at}.{k}: unknown",))
    return errors, parts


def validate(value, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks ``schema`` (a subset of JSON Schema). A
    reference to another call's result stands for a value of any kind. Values
    nested to any depth are walked with a stack of their own."""
    errors, todo = [], [(value, schema, at)]
    while todo:
        item = todo.pop()
        if len(item) == 1:
            errors.append(item[0])
            continue
        found, parts = _broken(*item)
        errors += found
        todo += reversed(parts)
    return errors


def refs_of(value) -> set[str]:
    """The call identifiers that a value refers to."""
    found, todo = set(), [value]
    while todo:
        v = todo.pop()
        if is_ref(v):
            found.add(v["$ref"])
        elif isinstance(v, dict):
            todo += v.values()
        elif isinstance(v, list):
            todo += v
    return found


def check_arguments(name: str | None, arguments: str | None, schemas: dict) -> tuple[list[str], list[str], str | None]:
    """``(errors, refs, canonical arguments)`` of one call."""
    try:
        value = parse_json(arguments if arguments is not None else "null")
        text = canonical(value)
        text.encode()                         # half a surrogate pair is no text
    except (ValueError, RecursionError) as e:
        return [f"$: not JSON: {type(e).__name__}"], [], None
    if name not in schemas:
        return ["unknown tool"], sorted(refs_of(value)), text
    return validate(value, schemas[name]), sorted(refs_of(value)), text


def _checked(calls: DataFrame, schemas: dict) -> DataFrame:
    """``calls`` with ``errors``, ``refs`` and ``canonical``."""
    rest = StructType([f for f in calls.schema.fields if f.name != "arguments"])
    shape = StructType([*rest.fields, *CHECKED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [check_arguments(n.as_py(), a.as_py(), schemas) for n, a in zip(b.column("name"), b.column("arguments"))]
            errors, refs, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in rest.fields], pa.array(errors, pa.list_(pa.string())),
                 pa.array(refs, pa.list_(pa.string())), pa.array(texts, pa.string())], names=shape.names)

    return calls.mapInArrow(run, shape)


def topological_levels(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(conv, call, level)`` for ``nodes(conv, call)`` that can be ordered.

    ``edges(conv, call, needs)`` among the nodes. A node's level is one more
    than the highest of what it needs. Nodes on a cycle, or that need one, get
    no row.
    """
    needs = edges.groupBy("conv", "call").agg(F.count("*").alias("n"))
    done = saved(spark, nodes.join(needs, ["conv", "call"], "left_anti").withColumn("level", F.lit(0).cast("long")), "level")
    new, level, parts = done, 0, [done]
    waiting = saved(spark, edges, "waiting")
    while not new.isEmpty():
        level += 1
        left = saved(spark, waiting.join(new.select("conv", F.col("call").alias("needs")), ["conv", "needs"], "left_anti")
                     .select("conv", "call", "needs"), "waiting")
        freed = waiting.select("conv", "call").distinct().join(left.select("conv", "call").distinct(), ["conv", "call"], "left_anti")
        new = saved(spark, freed.withColumn("level", F.lit(level).cast("long")), "level")
        parts.append(new)
        dropped(spark, waiting)
        waiting = left
    dropped(spark, waiting)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def link_tool_calls(spark: SparkSession, calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per call: ``conv, position, call, name, level, status, errors, message``.

    ``calls(conv, position, call, name, arguments)``, ``results(conv, position,
    call, content)``; ``schemas``: tool name -> schema of its arguments.

    Within a conversation, the order of (level, position, call) puts every
    call after those it refers to; ``level`` is 0 throughout if the positions
    alone do. ``status`` is the first that holds of ``no_id``, ``cycle`` (level
    is null), ``invalid`` (see ``errors``), ``unresolved`` (refers to a call
    that the conversation has not), ``no_result`` and ``ok``. ``message`` is
    canonical JSON of arguments, id, name and result.

    Defined results: calls without an identifier link to nothing; of several
    results of one identifier the one with the smallest position (ties: the
    smallest content) holds; repeated calls each give a row with the same
    result; results without a call are not listed; null arguments are JSON
    null; a null conversation is a conversation of its own; empty tables give
    an empty result; other columns are not read. Arguments of any length are
    parsed whole; those nested too deeply for the JSON parser are an error
    entry (``invalid``), like any other text that cannot be parsed.
    """
    calls = calls.select(F.col("conv").cast("string").alias("conv"), F.col("position").cast("long").alias("position"),
                         F.col("call").cast("string").alias("call"), F.col("name").cast("string").alias("name"),
                         F.col("arguments").cast("string").alias("arguments"))
    # A null conversation must join with itself: keys carry a mark in front.
    key = F.when(F.col("conv").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("conv")))
    checked = saved(spark, _checked(calls.withColumn("conv", key), schemas), "calls")
    first = (results.select(F.col("conv").cast("string").alias("conv"), F.col("call").cast("string").alias("call"),
                            F.struct(F.col("position").cast("long").alias("position"), F.col("content").cast("string").alias("content")).alias("r"))
             .withColumn("conv", key).where("call IS NOT NULL").groupBy("conv", "call").agg(F.min("r").alias("r")))
    nodes = checked.where("call IS NOT NULL").groupBy("conv", "call").agg(F.min("position").alias("position"))
    edges = (checked.where("call IS NOT NULL").select("conv", "call", F.explode("refs").alias("needs")).distinct()
             .join(nodes.select("conv", "call", F.col("position").alias("at")), ["conv", "call"])
             .join(nodes.select("conv", F.col("call").alias("needs"), F.col("position").alias("needs_at")), ["conv", "needs"]))
    edges = saved(spark, edges.select("conv", "call", "needs", F.coalesce(F.col("needs_at") < F.col("at"), F.lit(False)).alias("forward")), "references")
    unordered = saved(spark, edges.where("NOT forward").select("conv").distinct(), "unordered")
    # Calls without references to others, and that none refers to, need no peeling.
    tangled = edges.join(unordered, "conv", "left_semi").select("conv", "call", "needs")
    some = tangled.select("conv", "call").union(tangled.select("conv", "needs")).distinct()
    levels = topological_levels(spark, some, tangled)
    state = some.join(levels, ["conv", "call"], "left").select("conv", "call", F.coalesce("level", F.lit(-1)).alias("lv"))
    missing = (checked.where("call IS NOT NULL").select("conv", "call", F.explode("refs").alias("needs")).distinct()
               .join(edges, ["conv", "call", "needs"], "left_anti").select("conv", "call").distinct().withColumn("missing", F.lit(True)))
    linked = (checked.join(first, ["conv", "call"], "left").join(state, ["conv", "call"], "left").join(missing, ["conv", "call"], "left"))
    level = F.when(F.col("lv") >= 0, F.col("lv")).when(F.col("lv").isNull(), F.lit(0).cast("long"))
    status = (F.when(F.col("call").isNull(), "no_id").when(F.col("lv") == -1, "cycle").when(F.size("errors") > 0, "invalid")
              .when(F.col("missing"), "unresolved").when(F.col("r").isNull(), "no_result").otherwise("ok"))
    full = linked.select(F.when(F.col("conv").startswith("+"), F.substring("conv", 2, 1 << 30)).alias("conv"), "position", "call", "name",
                         level.alias("level"), status.alias("status"), "errors", "canonical", F.col("r.content").alias("result"))
    return _serialised(full)


def _serialised(linked: DataFrame) -> DataFrame:
    rest = StructType(linked.schema.fields[:7])
    shape = StructType([*rest.fields, StructField("message", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for call, name, arguments, result in zip(*[b.column(c).to_pylist() for c in ("call", "name", "canonical", "result")]):
                texts.append('{"arguments":%s,"id":%s,"name":%s,"result":%s}' % (
                    arguments if arguments is not None else "null", canonical(call), canonical(name), canonical(result)))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in rest.fields], pa.array(texts, pa.string())], names=shape.names)

    return linked.mapInArrow(run, shape)
