"""Schemas whose values are taken apart in one cast: nested items, members that are missing or of another kind, odd names."""

import json
import random

from pyspark.sql import functions as F
from test_contracts import slow_errors

from tidegraph.functions import schema
from tidegraph.operators import extraction
from tidegraph.plans import contract_queries

TEXT = {"type": "string"}
NESTED = {
    "$defs": {"leaf": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}, "y": {"type": ["object", "null"], "properties": {"z": TEXT}}}}},
    "type": "object", "required": ["a", "A"],
    "properties": {
        "a": {"type": "array", "items": {
            "type": "object", "required": ["in", "b`c"], "additionalProperties": {"type": ["string", "object"]},
            "properties": {"in": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/leaf"}}, "b`c": {"type": "object", "required": ["k"], "properties": {"k": TEXT, "l": {"type": "array", "items": TEXT}}}, "o": {"type": "object", "properties": {"p": {"type": ["array", "string"], "items": {"type": "null"}, "maxLength": 2}}}},
        }},
        "A": {"allOf": [{"$ref": "#/$defs/leaf"}, {"properties": {"y": {"required": ["w"]}}}]}, "same": {"type": "array"}, "Same": TEXT, "c": {"const": None}, "d,1": {"enum": [1, "u", None, False]},
        "m": {"type": "array", "items": {"type": "array", "items": {"type": "object", "required": ["x"], "properties": {"x": {"not": {"type": "boolean"}}}}}},
        "i": {"if": {"required": ["x"]}, "then": {"properties": {"x": TEXT}}, "else": {"type": ["array", "null"], "items": TEXT}},
    },
}
NAMES = ["a", "A", "in", "b`c", "k", "l", "o", "p", "x", "y", "z", "w", "same", "Same", "c", "d,1", "m", "i"]


def drawn(r, rules, depth=0):
    """Mostly what the rules ask for, now and then something else."""
    while "$ref" in rules:
        rules = NESTED["$defs"]["leaf"]
    rules = rules["allOf"][0] if "allOf" in rules else rules
    while "$ref" in rules:
        rules = NESTED["$defs"]["leaf"]
    kind = rules.get("type", "any")
    kind = r.choice(kind) if isinstance(kind, list) else kind
    if r.random() < 0.12 or kind == "any" or depth > 6:
        return r.choice([None, True, False, 0, 1, -1, 2.0, 2.5, "", "u", "abc", [], {}, ["u"], {"x": 1}, {"x": "t"}, [None], [{}], {"k": "v"}])
    if kind == "object":
        out = {n: drawn(r, s, depth + 1) for n, s in rules.get("properties", {}).items() if r.random() < 0.8}
        return out | ({r.choice(NAMES): drawn(r, {}, depth + 1)} if r.random() < 0.2 else {})
    if kind == "array":
        return [drawn(r, rules.get("items", TEXT), depth + 1) for _ in range(r.randint(0, 3))]
    return {"string": "u", "integer": r.choice([1, 2.0, -1]), "null": None, "boolean": True}[kind]


def test_nested_shapes_equal_the_slow_rules(spark):
    r = random.Random(11)
    values = [drawn(r, NESTED) for _ in range(600)] + [{"a": [], "A": {"x": 1}}, {"a": [{"in": [{"x": 2}], "b`c": {"k": "u"}}], "A": {"x": 0, "y": None}, "c": None, "d,1": "u", "i": {"x": "u"}}]
    d = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    got = {x["i"]: x["e"] for x in d.select("i", schema.errors(NESTED, F.parse_json("j")).alias("e")).collect()}
    want = {i: sorted(slow_errors(NESTED, v, NESTED)) for i, v in enumerate(values)}
    assert got == want
    assert len({e for x in want.values() for e in x}) >= 30 and want[600] == want[601] == []


def test_answers_are_taken_apart_in_few_casts(spark):
    """Every cast to a variant copies all that is below, for each answer or each item of it."""
    texts = spark.createDataFrame([("a", "{}")], "doc_id string, answer string")
    plan = extraction.schema_errors(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(") < 100


def test_lines_of_one_file_are_dealt_to_all_cores(spark):
    assert contract_queries.answers(spark, "/root/testdata/sf0.01").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
