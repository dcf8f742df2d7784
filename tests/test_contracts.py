"""Schemas as expressions, checked sinks, the cube of mentions, and places without a global order."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegraph.functions import contracts, schema
from tidegraph.functions import scoring as s
from tidegraph.operators import extraction, trend
from tidegraph.plans import contract_queries
from tidegraph.sources import files

P = s.Profile()


def is_kind(v, kind):
    if kind in ("number", "integer"):
        return isinstance(v, (int, float)) and not isinstance(v, bool) and (kind == "number" or v == int(v))
    return {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}[kind] is type(v)


def slow_errors(rules, v, root, path=""):
    """The same rules, value by value."""
    out, at = set(), path or "$"
    for key, r in rules.items():
        if key == "$ref":
            out |= slow_errors(root["$defs"][r.rpartition("/")[2]], v, root, path)
        elif key == "type" and not any(is_kind(v, k) for k in ([r] if isinstance(r, str) else r)):
            out.add(f"{at}: type")
        elif key in ("enum", "const") and not any(type(v) is type(x) and v == x for x in (r if key == "enum" else [r])):
            out.add(f"{at}: {key}")
        elif key in ("minimum", "maximum") and is_kind(v, "number") and (v < r if key == "minimum" else v > r):
            out.add(f"{at}: {key}")
        elif key in ("minLength", "maxLength") and isinstance(v, str) and (len(v) < r if key == "minLength" else len(v) > r):
            out.add(f"{at}: {key}")
        elif key in ("minItems", "maxItems") and isinstance(v, list) and (len(v) < r if key == "minItems" else len(v) > r):
            out.add(f"{at}: {key}")
        elif key == "required" and isinstance(v, dict):
            out |= {f"{path}.{n}: required".lstrip(".") for n in r if n not in v}
        elif key == "properties" and isinstance(v, dict):
            for n in r.keys() & v.keys():
                out |= slow_errors(r[n], v[n], root, f"{path}.{n}".lstrip("."))
        elif key == "additionalProperties" and isinstance(v, dict):
            rest = v.keys() - rules.get("properties", {}).keys()
            if r is False and rest:
                out.add(f"{at}: additionalProperties")
            for n in rest if isinstance(r, dict) else ():
                out |= slow_errors(r, v[n], root, f"{path}.*".lstrip("."))
        elif key == "items" and isinstance(v, list):
            for x in v:
                out |= slow_errors(r, x, root, f"{path}[]")
        elif key == "allOf":
            out |= set().union(*(slow_errors(x, v, root, path) for x in r))
        elif key in ("anyOf", "oneOf"):
            fit = sum(not slow_errors(x, v, root, path) for x in r)
            if fit == 0 or (key == "oneOf" and fit > 1):
                out.add(f"{at}: {key}")
        elif key == "not" and not slow_errors(r, v, root, path):
            out.add(f"{at}: not")
        elif key == "if":
            then = rules.get("else" if slow_errors(r, v, root, path) else "then", {})
            out |= slow_errors(then, v, root, path)
    return out


RULES = {
    "$defs": {"name": {"type": "string", "minLength": 2, "maxLength": 4}},
    "type": "object", "required": ["a", "b c"], "additionalProperties": {"type": ["integer", "null"]},
    "properties": {
        "a": {"$ref": "#/$defs/name"}, "b c": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"anyOf": [{"const": 1}, {"const": True}, {"type": "object", "properties": {"x": {"minimum": 0, "maximum": 2}}, "additionalProperties": False}]}},
        "d": {"if": {"type": "string"}, "then": {"enum": ["u", "v"]}, "else": {"allOf": [{"type": "number"}, {"not": {"const": 3}}]}}, "e": {"oneOf": [{"type": "integer"}, {"type": "number", "minimum": 5}]}, "any": {},
    },
}


def drawn(r, depth=0):
    plain = [None, True, False, 0, 1, 3, 2.0, 2.5, -1, 6, "", "u", "abc", "abcdef"]
    k = r.random()
    if depth > 2 or k < 0.5:
        return r.choice(plain)
    if k < 0.7:
        return [drawn(r, depth + 1) for _ in range(r.randint(0, 3))]
    return {n: drawn(r, depth + 1) for n in r.sample(["a", "b c", "d", "e", "x", "any", "other"], r.randint(0, 5))}


def test_compiled_rules_equal_the_slow_ones(spark):
    r = random.Random(3)
    values = [drawn(r) for _ in range(150)] + [{n: drawn(r, 1) for n in r.sample(["a", "b c", "d", "e", "any", "q"], r.randint(2, 6))} for _ in range(350)]
    d = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string")
    got = {x["i"]: x["e"] for x in d.select("i", schema.errors(RULES, F.parse_json("j")).alias("e")).collect()}
    assert got == {i: sorted(slow_errors(RULES, v, RULES)) for i, v in enumerate(values)}
    assert len({e for x in got.values() for e in x}) >= 15


def test_missing_values_and_unknown_rules(spark):
    d = spark.range(1).select(schema.errors(RULES, F.lit(None).cast("variant")).alias("e"), schema.errors({}, F.parse_json(F.lit("1"))).alias("f"))
    assert d.first() == (None, [])
    for bad in ({"dependentRequired": {}}, {"$ref": "http://x"}, {"properties": {"x": {"uniqueItems": True}}}, {"$defs": {"n": {"items": {"$ref": "#/$defs/n"}}}, "$ref": "#/$defs/n"}, {"const": [1]}):
        with pytest.raises(ValueError):
            schema.errors(bad, F.parse_json(F.lit("1")))


def test_every_rule_of_answers_fails_once():
    rules = contracts.extraction()
    for place, value, want in contract_queries.FAULTS:
        if value != "broken":
            assert sorted(slow_errors(rules, json.loads(contract_queries.faulty(place, value).replace("@share", "0.5")), rules)) == want, place


def test_answers_in_spark(spark):
    rows = [(str(i), contract_queries.faulty(place, value).replace("@share", "0.5")) for i, (place, value, _) in enumerate(contract_queries.FAULTS)] + [("none", None), ("blank", "")]
    got = {r["doc_id"]: r["errors"] for r in extraction.schema_errors(spark.createDataFrame(rows, "doc_id string, answer string")).collect()}
    assert got.pop("none") == got.pop("blank") == ["not JSON"]
    assert got == {str(i): want for i, (_, _, want) in enumerate(contract_queries.FAULTS)}
    assert extraction.schema_errors(spark.createDataFrame([], "doc_id string, answer string")).count() == 0


META = {"view": "movers", "domain": "d", "rank_window_days": 7, "exportedAt": "2024-01-30T00:00:00Z", "dateRange": {"start": None, "end": "2024-01-30"}, "scoring": {"novelty_decay_lambda": 0.05, "min_mentions_for_velocity": 3}}
MOVER = "entity_id string, label string, type string, current_rank int, rank_prior int, rank_delta int, is_new boolean, velocity_raw double, velocity_ci_lower double, sustained boolean, bridge_delta double, mention_count_7d long, mention_count_30d long, first_seen string, days_since_first_seen int, distinct_sources_7d long, in_trending_view boolean, trend_score double"


def test_movers_are_written_only_if_they_fit(spark, tmp_path):
    good = ("a", "A", "Org", 1, None, None, True, None, 0.5, False, None, 3, 9, "2024-01-02", 28, 2, True, 0.7)
    path = str(tmp_path / "good")
    files.write_movers(spark.createDataFrame([good, good], MOVER), path, META)
    assert files.read_lines(spark, f"{path}/rows", MOVER).collect() == [good, good]
    assert json.loads((spark.read.text(f"{path}/meta").first())[0])["rowCount"] == 2
    for i, value in ((0, None), (2, ""), (3, 0), (8, -0.1), (11, -1), (17, None)):
        bad = list(good)
        bad[i] = value
        with pytest.raises(ValueError, match=MOVER.split(", ")[i].split()[0]):
            files.write_movers(spark.createDataFrame([good, tuple(bad)], MOVER), str(tmp_path / f"bad{i}"), META)
        assert not (tmp_path / f"bad{i}").exists()
    with pytest.raises(ValueError, match="required"):
        files.write_movers(spark.createDataFrame([good], MOVER).drop("label"), str(tmp_path / "less"), META)
    with pytest.raises(ValueError, match="view: const"):
        files.write_movers(spark.createDataFrame([good], MOVER), str(tmp_path / "head"), META | {"view": "trending"})
    assert not (tmp_path / "head" / "meta").exists()
    files.write_movers(spark.createDataFrame([], MOVER), str(tmp_path / "none"), META)


def drawn_mentions(spark, seed, n=400):
    r = random.Random(seed)
    rows = [(f"e{r.randint(0, 12)}", f"d{i}", f"2024-0{r.randint(1, 3)}-{r.randint(1, 28):02}", r.choice("abc")) for i in range(n)]
    return spark.createDataFrame(rows, "entity_id string, doc_id string, published string, source string"), rows


def test_history_from_the_cube_equals_a_run_at_a_time(spark):
    m, _ = drawn_mentions(spark, 1)
    runs = ["2024-01-01", "2024-01-20", "2024-02-10", "2024-03-28"]
    got = sorted(map(tuple, trend.history(m, runs, P).collect()))
    want = []
    for run in runs:
        x = trend.scores(m.where(F.col("published") <= run), run, P).where("c30 > 0")
        want += x.select("entity_id", F.lit(run), "c7", "c30", "velocity", F.round("novelty", 6), "velocity_gated", F.when(F.col("c7") >= P.min_mentions, F.round("trend_score", 6)).otherwise(0.0)).collect()
    assert got == sorted(map(tuple, want)) and len(got) > 30
    plan = trend.history_of(trend.day_counts(m), runs, P)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert trend.history(m.limit(0), runs, P).count() == 0


def test_a_batch_merged_into_the_cube_equals_a_new_cube(spark):
    (a, _), (b, _) = drawn_mentions(spark, 2), drawn_mentions(spark, 3, 50)
    rows = lambda d: sorted(map(tuple, d.select("entity_id", "published", "source", "n").collect()))
    assert rows(trend.merge_counts(trend.day_counts(a), b)) == rows(trend.day_counts(a.union(b)))


def test_values_by_index(spark):
    r = random.Random(5)
    rows = [(g, r.choice([None, *range(9)])) for g in ("x", "x", "x", "y") for _ in range(40)] + [("z", 1), ("w", None), (None, 4), (None, 5)]
    d = spark.createDataFrame(rows, "g string, v int").repartition(3)
    got = {x["g"]: (x["low"], x["mid"], x["high"]) for x in trend.by_index(d, "g", "v", low="0", mid="n div 2", high="cast(floor(n * 0.95) as int)").collect()}
    for g in ("x", "y", "z"):
        v = sorted(b for a, b in rows if a == g and b is not None)
        assert got[g] == (v[0], v[len(v) // 2], v[int(len(v) * 0.95)])
    assert "w" not in got and trend.by_index(d, "g", "v", 2, mid="0").where("g = 'z'").count() == 0
