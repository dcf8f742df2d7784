"""Tool-call linking (operator 7): calls and results joined by identifier, ordered and validated.

DataFrame functions only; JSON is parsed to and written from variants, whose objects keep
their keys in order, which makes the written form canonical.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

#: Schemas of tools by name: JSON Schema objects with type, properties, required, additionalProperties, items and enum.
#: A tool that isn't listed is unknown.
Schemas = dict[str, dict]
#: The tool that plain turns stand for: a user turn asks, the next assistant turn is the result.
PLAIN: Schemas = {"reply": {"type": "object", "properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["prompt", "turn"]}}
_TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*",
    "object": "^OBJECT.*",
    "null": "^VOID$",
}


def _field(v: Column, key: str) -> Column:
    """A field of a variant, null if there is none; a key with both kinds of quotes has no path and is looked up in a map."""
    for quote in "'\"":
        if quote not in key:
            return F.try_variant_get(v, f"$[{quote}{key}{quote}]", "variant")
    return F.try_element_at(F.try_variant_get(v, "$", "map<string, variant>"), F.lit(key))


def _wrong(v: Column, schema: dict, at: Column) -> Column:
    """array<string> of what is wrong with the variant v, which isn't null; at names its place."""
    none = F.array().cast("array<string>")
    # the text of a variant's type lists its fields in full; only its beginning is looked at
    kind, wanted = F.schema_of_variant(v), schema.get("type")
    parts = []
    if "enum" in schema:
        allowed = F.array(*(F.lit(json.dumps(x, separators=(",", ":"), ensure_ascii=False)) for x in schema["enum"]))
        parts.append(F.when(~F.array_contains(allowed, F.to_json(v)), F.array(F.concat(at, F.lit(": not one of the listed")))).otherwise(none))
    required = schema.get("required", [])
    for key, inner in sorted({**{k: {} for k in required}, **schema.get("properties", {})}.items()):
        here = F.concat(at, F.lit("." + key))
        x = _field(v, key)
        missing = F.array(F.concat(here, F.lit(": missing"))) if key in required else none
        parts.append(F.when(x.isNull(), missing).otherwise(_wrong(x, inner, here)))
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.try_variant_get(v, "$", "map<string, variant>"))
        more = F.array_sort(F.array_except(keys, F.array(*(F.lit(k) for k in schema.get("properties", {}))).cast("array<string>")))
        parts.append(F.coalesce(F.transform(more, lambda k: F.concat(at, F.lit("."), k, F.lit(": not expected"))), none))
    if "items" in schema:
        items = F.try_variant_get(v, "$", "array<variant>")
        each = F.transform(items, lambda x, i: _wrong(x, schema["items"], F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))))
        parts.append(F.coalesce(F.flatten(each), none))
    inside = F.concat(*parts) if parts else none
    return F.when(~kind.rlike(_TYPES[wanted]), F.array(F.concat(at, F.lit(f": not {wanted}")))).otherwise(inside) if wanted else inside


def _errors(schemas: Schemas) -> Column:
    """array<string> of what is wrong with the parsed arguments `args` of tool `name`."""
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("null"))))
    for tool, schema in sorted(schemas.items()):
        of = F.when(F.col("args").isNull(), F.array(F.lit("arguments: not JSON"))).otherwise(_wrong(F.col("args"), {"type": "object"} | schema, F.lit("arguments")))
        out = F.when(F.col("name") == tool, of).otherwise(out)
    return out


def _followed(needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, anchor, hops): where each call that needs one other gets to, by ever longer jumps.

    needs (conv_id, call_id, need, hop) has one row per call. An anchor is a call without a
    row. Jumps double in each round, so a chain of n calls takes log2(n) rounds; calls that
    don't get to an anchor then are on, or behind, a cycle, and have no row.
    """
    key = ["conv_id", "call_id"]
    jumps = materialise(needs.select(*key, F.col("need").alias("anchor"), F.col("hop").cast("long").alias("hops")), "jumps")
    n = jumps.count()
    for _ in range(n.bit_length()):
        onward = jumps.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("then"), F.col("hops").alias("more"))
        longer = jumps.join(onward, ["conv_id", "anchor"], "left")
        if longer.where("then is not null").isEmpty():
            break
        jumps = materialise(longer.select(*key, F.coalesce("then", "anchor").alias("anchor"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops")), "jumps")
    return jumps.join(jumps.select("conv_id", F.col("call_id").alias("anchor")), ["conv_id", "anchor"], "left_anti")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, turn, needs); (level, turn, call_id) is a topological order.

    A level is how many steps back in (turn, call_id) the worst chain of needs takes: 0 for a
    call all of whose needs, and theirs, come earlier. Needs that aren't calls of the
    conversation don't count. Calls on or behind a cycle get no row.

    Where all needs of a conversation come earlier its calls are in order as they stand, and
    nothing is computed. In the others, chains of calls with one need are jumped over (see
    `_followed`), and the calls with several needs are set free in rounds: one per step of
    the longest chain of such calls, each written to the shared folder.
    """
    key = ["conv_id", "call_id"]
    keys = calls.select(*key, "turn")
    wanted = calls.select(*key, "turn", F.explode(F.array_distinct("needs")).alias("need"))
    found = wanted.join(keys.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("at")), ["conv_id", "need"])
    back = F.struct("at", "need") >= F.struct("turn", "call_id")
    needs = materialise(found.select(*key, "need", back.cast("int").alias("hop")), "needs")
    mixed = materialise(needs.where("hop = 1").select("conv_id").distinct(), "mixed")
    if mixed.isEmpty():
        return keys.select(*key, F.lit(0).alias("level"))
    needs = needs.join(mixed, "conv_id", "left_semi")
    n = materialise(needs.groupBy(*key).agg(F.count("*").alias("n")), "wants")
    single = needs.join(n.where("n = 1").select(*key), key, "left_semi")
    reach = materialise(_followed(single), "reach")
    several = needs.join(n.where("n > 1").select(*key), key, "left_semi")
    # needs of calls with several, as anchors: those that lead to a cycle have none, and keep their call waiting
    to = reach.select("conv_id", F.col("call_id").alias("need"), "anchor", "hops")
    alone = n.where("n = 1").select("conv_id", F.col("call_id").alias("need"))
    direct = several.join(alone, ["conv_id", "need"], "left_anti").select(*key, F.col("need").alias("anchor"), F.col("hop").cast("long").alias("hops"))
    over = several.join(to, ["conv_id", "need"]).select(*key, "anchor", (F.col("hop") + F.col("hops")).alias("hops"))
    waits = materialise(direct.union(over), "waits")
    rest = keys.join(mixed, "conv_id", "left_semi").select(*key)
    done = materialise(rest.join(n, key, "left_anti").select(*key, F.lit(0).cast("long").alias("level")), "level")
    fresh, met = done, None
    while not waits.isEmpty() and not fresh.isEmpty():
        now = waits.join(fresh.withColumnRenamed("call_id", "anchor"), ["conv_id", "anchor"]).select(*key, (F.col("level") + F.col("hops")).alias("level"), F.lit(1).alias("k"))
        met = now if met is None else met.union(now)
        met = materialise(met.groupBy(*key).agg(F.max("level").alias("level"), F.sum("k").alias("k")), "met")
        ready = met.join(n, key).where("k = n").select(*key, "level")
        fresh = materialise(ready, "level")
        met = met.join(n, key).where("k < n").select(*key, "level", "k")
        done = done.union(fresh)
    behind = reach.join(done.withColumnRenamed("call_id", "anchor"), ["conv_id", "anchor"]).select(*key, (F.col("level") + F.col("hops")).alias("level"))
    placed = done.union(behind).select(*key, F.col("level").cast("int").alias("level"))
    return keys.join(mixed, "conv_id", "left_anti").select(*key, F.lit(0).alias("level")).union(placed)


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call, and one per identifier that only results have.

    calls: conv_id, call_id, turn, name, arguments (JSON text), needs (array of call ids), and
    maybe faults (array of texts), which make a call invalid.
    results: conv_id, call_id, turn, content. Identifiers belong to a conversation. Of calls
    with the same identifier the first by (turn, name, arguments) counts, and of results the
    first by (turn, content); n_calls and n_results tell how many there were, counted before
    the join, so a repeated identifier never multiplies. Null ids link nothing and have no row.

    status: linked, no_result, orphan_result, invalid (see errors) or cycle. level: see
    `levels`; (level, turn, call_id) is a topological order in a conversation. json is the
    canonical JSON of call and result. Empty tables give no rows; other columns are ignored.
    """
    has = "conv_id is not null and call_id is not null"
    if "faults" not in calls.columns:
        calls = calls.withColumn("faults", F.array().cast("array<string>"))
    first_call = F.min(F.struct("turn", "name", "arguments", "needs", "faults")).alias("c")
    c = calls.where(has).groupBy("conv_id", "call_id").agg(first_call, F.count("*").alias("n_calls"))
    c = materialise(c.select("conv_id", "call_id", "c.*", "n_calls"), "calls")
    r = results.where(has).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    r = materialise(r.select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), "r.content", "n_results"), "results")
    key = ["conv_id", "call_id"]
    c = c.join(levels(c), key, "left").withColumn("args", F.expr("try_parse_json(arguments)"))
    errors = F.concat(F.when(F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(F.array()), F.col("faults"), _errors(schemas))
    linked = c.withColumn("errors", errors).join(r, key, "left").withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    linked = linked.withColumn(
        "status",
        F.when(F.col("level").isNull(), "cycle")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("n_results") == 0, "no_result")
        .otherwise("linked"),
    )
    orphans = r.join(c, key, "left_anti").select(
        *key, F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("level"),
        "result_turn", F.lit(0).cast("long").alias("n_calls"), "n_results", F.lit("orphan_result").alias("status"), F.lit("").alias("errors"),
        _json(args=False).alias("json"),
    )
    return linked.select(
        *key, "name", F.col("turn").cast("long").alias("turn"), "level", "result_turn", "n_calls", "n_results", "status",
        F.array_join("errors", "; ").alias("errors"), _json(args=True).alias("json"),
    ).union(orphans)


def _json(args: bool):
    """Keys in order at the top as in variants; absent parts are left out."""

    def text(x):
        return F.to_json(F.struct(F.col(x).alias("v")), {"ignoreNullFields": "false"})

    plain = lambda x: F.regexp_replace(text(x), r'(?s)^\{"v":(.*)\}$', "$1")
    parts = []
    if args:
        parts.append(F.concat(F.lit('"arguments":'), F.coalesce(F.expr("to_json(args)"), plain("arguments"))))
    parts.append(F.concat(F.lit('"id":'), plain("call_id")))
    if args:
        parts.append(F.concat(F.lit('"name":'), plain("name")))
    parts.append(F.when(F.col("n_results") > 0, F.concat(F.lit('"result":'), plain("content"))))
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, others) in turns (conv_id, turn, role, text).

    A turn whose text is a JSON object with a list `tool_calls` ({id, name, arguments, needs}
    each) holds calls, one with `tool_call_id` (and `content`) a result. A call without an id
    gets `call-<turn>-<place>` for one. faults, a column of calls, lists what is wrong with it
    as a call: no object, no id, or needs that aren't a list of texts (those of its items that
    are texts still count). Any other user turn k
    stands for the call `turn-k` of the tool `reply`, and any other assistant turn k + 1 for
    its result. Turns of any other role, null included, and those whose list of calls is empty,
    are others (conv_id, turn, role, text). Turns without conv_id or turn give nothing; a null text is empty.
    """
    t = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id is not null and turn is not null")
    t = t.withColumn("v", F.when(F.col("text").rlike(r"^\s*\{"), F.expr("try_parse_json(text)")))
    t = t.withColumn("listed", F.expr("try_variant_get(v, '$.tool_calls', 'array<variant>')")).withColumn("answers", F.expr("try_variant_get(v, '$.tool_call_id', 'string')"))
    none, texts = F.array().cast("array<string>"), "^(STRING|BIGINT|DECIMAL.*)$"
    embedded = t.where("listed is not null").select("conv_id", "turn", F.posexplode("listed").alias("i", "x"))
    embedded = embedded.withColumn("needs", F.expr("try_variant_get(x, '$.needs', 'variant')")).withColumn("id", F.expr("try_variant_get(x, '$.id', 'string')"))
    embedded = embedded.withColumn("items", F.expr("try_variant_get(needs, '$', 'array<variant>')"))
    named = F.filter(F.coalesce("items", F.array().cast("array<variant>")), lambda e: F.coalesce(F.schema_of_variant(e).rlike(texts), F.lit(False)))
    given = F.col("needs").isNotNull() & ~F.schema_of_variant("needs").eqNullSafe("VOID")
    faults = F.array(
        F.when(~F.schema_of_variant("x").startswith("OBJECT"), F.lit("call: not object")), F.when(F.col("id").isNull(), F.lit("id: missing")),
        F.when(given & (F.col("items").isNull() | (F.size(named) < F.size("items"))), F.lit("needs: not a list of texts")),
    )
    embedded = embedded.select(
        "conv_id", F.coalesce("id", F.concat_ws("-", F.lit("call"), F.col("turn"), F.col("i"))).alias("call_id"), "turn", F.expr("try_variant_get(x, '$.name', 'string')").alias("name"),
        F.expr("if(schema_of_variant(try_variant_get(x, '$.arguments', 'variant')) = 'STRING', try_variant_get(x, '$.arguments', 'string'), to_json(try_variant_get(x, '$.arguments', 'variant')))").alias("arguments"),
        F.transform(named, lambda e: F.try_variant_get(e, "$", "string")).alias("needs"), F.array_compact(faults).alias("faults"),
    )
    other = t.where("listed is null and answers is null")
    asked = other.where("role = 'user'").select(
        "conv_id", F.concat(F.lit("turn-"), F.col("turn")).alias("call_id"), "turn", F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"), none.alias("needs"), none.alias("faults"),
    )
    told = t.where("answers is not null").select(
        "conv_id", F.col("answers").alias("call_id"), "turn", F.coalesce(F.expr("try_variant_get(v, '$.content', 'string')"), F.lit("")).alias("content")
    )
    said = other.where("role = 'assistant'").select("conv_id", F.concat(F.lit("turn-"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    silent = t.where("size(listed) = 0 and answers is null")
    rest = other.where("role is null or role not in ('user', 'assistant')").union(silent).select("conv_id", "turn", "role", "text")
    return embedded.union(asked), told.union(said), rest


def spoken(others: DataFrame) -> DataFrame:
    """Rows like those of link for turns that are neither call nor result: status other_turn, one per conversation, turn and role.

    Of several with the same key the smallest text counts; n_calls tells how many there were.
    """
    t = others.groupBy("conv_id", "turn", "role").agg(F.min("text").alias("content"), F.count("*").alias("n_calls"))
    t = t.withColumn("call_id", F.concat_ws("-", F.lit("other"), F.coalesce("role", F.lit("null")), F.col("turn")))
    plain = lambda x: F.regexp_replace(F.to_json(F.struct(F.col(x).alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1")
    parts = [F.concat(F.lit(f'"{name}":'), plain(x)) for name, x in (("content", "content"), ("id", "call_id"))]
    role = F.when(F.col("role").isNotNull(), F.concat(F.lit('"role":'), plain("role")))
    null = lambda kind: F.lit(None).cast(kind)
    return t.select(
        "conv_id", "call_id", null("string").alias("name"), F.col("turn").cast("long").alias("turn"), null("int").alias("level"), null("long").alias("result_turn"),
        "n_calls", F.lit(0).cast("long").alias("n_results"), F.lit("other_turn").alias("status"), F.lit("").alias("errors"),
        F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts, role)), ","), F.lit("}")).alias("json"),
    )


def link_conversations(conversations: DataFrame, schemas: Schemas) -> DataFrame:
    """Every call, orphan result and other turn of conversations; see link and spoken."""
    calls, results, others = from_conversations(conversations)
    return link(calls, results, schemas).union(spoken(others))


def op7_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per call, orphan result or other turn of all conversations."""
    return link_conversations(table(spark, sf_dir, "conversations"), PLAIN)


OP7_SQL = """
with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations where conv_id is not null and turn is not null),
c as (
  select conv_id, 'turn-' || turn as call_id, min(turn) as turn, min(text) as text, count(*) as n_calls
  from t where role = 'user' group by conv_id, turn
),
r as (
  select conv_id, 'turn-' || (turn - 1) as call_id, min(turn) as result_turn, min(text) as content, count(*) as n_results
  from t where role = 'assistant' group by conv_id, turn
)
select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.call_id, r.call_id) as call_id,
  case when c.call_id is not null then 'reply' end as name, c.turn, case when c.call_id is not null then 0 end as level, r.result_turn,
  coalesce(c.n_calls, 0) as n_calls, coalesce(r.n_results, 0) as n_results,
  case when c.call_id is null then 'orphan_result' when r.call_id is null then 'no_result' else 'linked' end as status, '' as errors,
  '{' || case when c.call_id is not null then '"arguments":{"prompt":' || to_json(c.text)::varchar || ',"turn":' || c.turn || '},' else '' end
  || '"id":' || to_json(coalesce(c.call_id, r.call_id))::varchar || case when c.call_id is not null then ',"name":"reply"' else '' end
  || case when r.call_id is not null then ',"result":' || to_json(r.content)::varchar else '' end || '}' as json
from c full join r on c.conv_id = r.conv_id and c.call_id = r.call_id
union all
select conv_id, concat_ws('-', 'other', coalesce(role, 'null'), turn), null, turn, null, null, count(*), 0, 'other_turn', '',
  '{"content":' || to_json(min(text))::varchar || ',"id":' || to_json(concat_ws('-', 'other', coalesce(role, 'null'), turn))::varchar
  || case when role is not null then ',"role":' || to_json(role)::varchar else '' end || '}'
from t where role is null or role not in ('user', 'assistant') group by conv_id, turn, role
"""
