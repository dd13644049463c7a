import json

import pytest
from lateship.llm.queries import TOOL_SCHEMAS, derived_calls
from lateship.llm.tool_calls import canonical, check_arguments, link_tool_calls, parse_json, validate

CALLS = "conv string, position long, call string, name string, arguments string"
RESULTS = "conv string, position long, call string, content string"
S = {"t": {"type": "object", "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"type": "string"}}},
           "required": ["a"], "additionalProperties": False}}


def ref(c):
    return '{"$ref":"%s"}' % c


def brute(calls, results):
    """Ordering and linking by plain loops."""
    first = {}
    for conv, pos, call, content in results:
        if call is not None:
            k = (conv, call)
            key = (pos is not None, pos, content is not None, content)
            if k not in first or key < first[k][0]:
                first[k] = (key, content)
    nodes, needs = {}, {}
    for conv, pos, call, name, args in calls:
        if call is not None:
            k = (conv, call)
            old = nodes.get(k)
            nodes[k] = pos if old is None else min(old, pos if pos is not None else old)
            needs.setdefault(k, set()).update((conv, r) for r in check_arguments(name, args, S)[1])
    edges = {k: {n for n in v if n in nodes} for k, v in needs.items()}
    tangled = {k[0] for k, v in edges.items() for n in v if not (nodes[n] is not None and nodes[k] is not None and nodes[n] < nodes[k])}
    level, todo = {}, {k for k in nodes if k[0] in tangled and (edges[k] or any(k in e for e in edges.values()))}
    while True:
        free = {k for k in todo if k not in level and all(n in level for n in edges[k])}
        if not free:
            break
        level.update({k: max([level[n] + 1 for n in edges[k]], default=0) for k in free})
    out = []
    for conv, pos, call, name, args in calls:
        k = (conv, call)
        errors, _, text = check_arguments(name, args, S)
        lv = level.get(k) if k in todo and call is not None else 0
        hit = first.get(k) if call is not None else None
        status = ("no_id" if call is None else "cycle" if lv is None else "invalid" if errors else
                  "unresolved" if needs[k] - set(nodes) else "no_result" if hit is None else "ok")
        out.append((conv, pos, call, name, lv, status, errors, text, hit[1] if hit else None))
    return out


CASE_CALLS = [
    ("c", 1, "x1", "t", '{"a":1}'), ("c", 3, "x2", "t", '{ "b" : [], "a":%s }' % ref("x1")), ("c", 3, "x2", "t", '{ "b" : [], "a":%s }' % ref("x1")),
    ("c", 5, "x3", "u", "{}"), ("c", 7, "x4", "t", '{"a":-1,"z":0,"b":[1]}'), ("c", 9, None, "t", '{"a":1}'), ("c", 9, "x5", "t", None),
    ("c", 10, "x6", "t", "{bad"), ("c", 11, "x7", "t", '{"a":%s}' % ref("nowhere")), ("c", 12, "x8", None, '{"a":1}'), ("c", 13, "x9", "t", '{"a":1,"a":2}'),
    ("d", 1, "y1", "t", '{"a":%s}' % ref("y2")), ("d", 2, "y2", "t", '{"a":%s}' % ref("y3")), ("d", 3, "y3", "t", '{"a":1}'), ("d", 4, "y4", "t", '{"a":%s,"b":[%s]}' % (ref("y1"), ref("y3"))),
    ("d", 9, "y9", "t", '{"a":1}'), ("e", 1, "z1", "t", '{"a":%s}' % ref("z2")), ("e", 2, "z2", "t", '{"a":%s}' % ref("z1")), ("e", 3, "z3", "t", '{"a":%s}' % ref("z2")),
    ("e", 4, "z4", "t", '{"a":%s}' % ref("z4")), (None, 1, "x1", "t", '{"a":5}'), (None, 2, "n2", "t", '{"a":%s}' % ref("x1")), ("f", 1, "x1", "t", '{"a":"\\ud800"}'),
    ("f", None, "p", "t", '{"a":NaN}'), ("", 1, "x1", "t", '{"a":1}'),
]
CASE_RESULTS = [("c", 2, "x1", "r1"), ("c", 4, "x2", "second"), ("c", 2, "x2", "b"), ("c", 2, "x2", "a"), ("c", 2, "lost", "no call"), ("c", 10, None, "no id"),
                ("d", 2, "y2", None), ("d", 5, "y1", 'é"\n'), (None, 3, "x1", "of null"), ("", 1, "x1", "of empty"), ("c", 8, "x4", "x")]


def test_matches_brute_force(spark):
    got = link_tool_calls(spark, spark.createDataFrame(CASE_CALLS, CALLS).repartition(3), spark.createDataFrame(CASE_RESULTS, RESULTS), S).collect()
    want = brute(CASE_CALLS, CASE_RESULTS)
    key = lambda r: str((r[0], r[1], r[2], r[3]))
    assert len(got) == len(want)
    for r, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert r[:6] == w[:6] and list(r[6]) == w[6], (r, w)
        m = json.loads(r[7])
        assert (m["id"], m["name"], m["result"]) == (w[2], w[3], w[8]) and list(m) == sorted(m)
        assert r[7] == canonical(m)
        assert canonical(m["arguments"]) == (w[7] or "null")


def test_order_puts_calls_after_what_they_need(spark):
    n = 60
    calls = [("k", n - i, f"c{i}", "t", '{"a":%s}' % (ref(f"c{i - 1}") if i else "1")) for i in range(12)] + [("k", 100 + i, f"d{i}", "t", '{"a":1}') for i in range(n)]
    got = link_tool_calls(spark, spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), S).collect()
    at = {r.call: (r.level, r.position) for r in got}
    assert all(at[f"c{i}"] > at[f"c{i - 1}"] for i in range(1, 12))
    assert {r.status for r in got} == {"no_result"}


def test_empty(spark):
    assert link_tool_calls(spark, spark.createDataFrame([], CALLS), spark.createDataFrame(CASE_RESULTS, RESULTS), S).count() == 0


@pytest.mark.parametrize("value,schema,bad", [
    (1, {"type": "integer"}, 0), (True, {"type": "integer"}, 1), (1.5, {"type": "number", "maximum": 1}, 1), ("ab", {"maxLength": 1}, 1), (None, {"type": ["string", "null"]}, 0),
    ([1, "x"], {"items": {"type": "string"}, "maxItems": 1}, 2), ({"x": 1}, {"required": ["y"], "additionalProperties": False}, 2), ("b", {"enum": ["a"]}, 1), (1, {"enum": [True]}, 1)])
def test_schema_rules(value, schema, bad):
    assert len(validate(value, schema)) == bad


@pytest.mark.parametrize("depth", [500, 3000, 100_000])
def test_deep_and_long_arguments_are_no_crash(spark, depth):
    rule = {"type": "array"}
    for _ in range(4):
        rule = {"type": "array", "items": rule}
    loop = {"type": "object", "properties": {"a": rule}}
    loop["properties"]["a"]["items"] = loop["properties"]["a"]           # a schema of any depth
    errors, refs, text = check_arguments("t", '{"a":' + "[" * depth + "]" * depth + "}", {"t": loop})
    assert refs == [] and (errors == [] and text is not None or errors == ["$: not JSON: RecursionError"])
    deep = []
    for _ in range(depth):
        deep = [deep]
    assert validate(deep, loop["properties"]["a"]) == []
    while deep:
        deep = deep.pop()
    calls = spark.createDataFrame([("c", 1, "x", "t", '{"b":' + "[" * depth + "]" * depth + "}"), ("c", 2, "y", "t", '{"a":1,"b":["%s"]}' % ("é" * 200_000))], CALLS)
    got = {r.call: r for r in link_tool_calls(spark, calls, spark.createDataFrame([], RESULTS), S).collect()}
    assert got["x"].status == "invalid" and got["y"].status == "no_result" and len(got["y"].message) > 200_000


def test_strict_json():
    for bad in ("", "{", '{"a":1,"a":1}', "NaN", "[1,]"):
        with pytest.raises(ValueError):
            parse_json(bad)
    assert canonical(parse_json('{ "b":1.50, "a":"\\u00e9\\n" }')) == '{"a":"é\\n","b":1.5}'


def test_query_covers_every_assistant_turn(spark, sf_dir):
    from lateship.llm.queries import QUERIES
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = derived_calls(turns)
    assert all(parse_json(r.arguments)["query"] for r in calls.collect())
    rows = QUERIES["op1_tool_calls"](spark, sf_dir).collect()
    assert len(rows) == turns.where("role = 'assistant'").count()
    found = {(r.conv, r.call): r.content for r in results.collect()}
    for r in rows:
        m = json.loads(r.message)
        assert m["id"] == r.call_id and m["result"] == found.get((r.conv_id, r.call_id)) and canonical(m) == r.message
    assert TOOL_SCHEMAS and {r.status for r in rows} >= {"ok", "invalid", "no_result"}
