"""Model answers as data: parsing, normalization, validation and quality gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegraph.functions import contracts, schema
from tidegraph.functions.text import collapse

SCHEMA = (
    "docId string, entities array<struct<name string, type string, aliases array<string>>>, "
    "relations array<struct<source string, rel string, target string, kind string, confidence double, "
    "evidence array<struct<docId string, snippet string>>>>, techTerms array<variant>"
)
KINDS = ("asserted", "inferred", "hypothesis")


def parse(answers: DataFrame) -> DataFrame:
    """answers (doc_id, answer): the JSON in a code fence or the whole text; `x` is null if unreadable.

    Each answer is read once: only one that doesn't fit the schema is looked at again, for whether it is JSON at all.
    """
    read = bodies(answers).withColumn("_x", F.from_json("_body", SCHEMA + ", _unfit string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unfit"}))
    fits = F.col("_x").isNotNull() & F.col("_x._unfit").isNull()
    own = F.struct(*(F.col(f"_x.{name}").alias(name) for name in ("docId", "entities", "relations", "techTerms")))
    return read.withColumn("x", F.when(fits, own).when(F.get_json_object("_body", "$").isNotNull(), F.when(F.col("_x").isNotNull(), own))).drop("_body", "_x")


def bodies(answers: DataFrame) -> DataFrame:
    """answers with `_body`, the JSON of each: what stands in its code fence, or all of it. Columns in steps, so that each is made once."""
    d = answers.withColumn("_parts", F.when(F.contains("answer", F.lit("```")), F.split("answer", "```", 3)))
    inner = F.when(F.size("_parts") == 3, F.regexp_replace(F.substring(F.get("_parts", F.lit(1)), 1, 4), "^json$", ""))
    d = d.withColumn("_fence", F.ltrim(F.concat(inner, F.substring(F.get("_parts", F.lit(1)), 5, 2**31 - 1)), F.lit(" \t\n\x0b\f\r")))
    return d.withColumn("_body", F.trim(F.when(F.col("_fence") != "", F.col("_fence")).otherwise(F.col("answer")))).drop("_parts", "_fence")


def schema_errors(answers: DataFrame, rules: dict | None = None) -> DataFrame:
    """(doc_id, errors) of answers (doc_id, answer) under a JSON schema (by default that of extractions): an answer
    without errors has none, one that can't be read has `not JSON`."""
    x = bodies(answers).select("doc_id", F.try_parse_json("_body").alias("x"))
    return x.select("doc_id", F.coalesce(schema.errors(rules or contracts.extraction(), F.col("x")), F.array(F.lit("not JSON"))).alias("errors"))


def normalize_rel(rel: Column, mapping: dict[str, str], canonical: tuple[str, ...]) -> Column:
    """Mapped upper form, else kept if canonical, else mapped with - and space as _, else itself."""
    up = F.upper(rel)
    m = F.create_map(*(F.lit(x) for kv in (mapping or {"": ""}).items() for x in kv))
    snake = F.regexp_replace(up, "[- ]", "_")
    return F.coalesce(F.try_element_at(m, up), F.when(up.isin(*canonical), rel), F.try_element_at(m, snake), rel)


def tech_terms(terms: Column) -> Column:
    """array<variant> to array<string>: texts as they are, of objects their term, else name, else their JSON; empty ones go."""

    def one(v):
        written = F.coalesce(*(F.when(F.try_variant_get(v, f"$.{k}", "string") != "", F.try_variant_get(v, f"$.{k}", "string")) for k in ("term", "name")), F.to_json(v))
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).when(F.schema_of_variant(v).startswith("OBJECT"), written)

    return F.filter(F.transform(terms, one), lambda x: x.isNotNull() & (x != ""))


def validate(parsed: DataFrame, *others) -> DataFrame:
    """doc_id, an array of errors, and other columns that go along: required fields, listed kinds, confidences from 0 to 1; asserted relations need evidence."""
    r, e = F.col("x.relations"), F.col("x.entities")
    none = lambda v: F.coalesce(F.trim(v), F.lit("")) == ""
    bad = lambda name, of, test: F.when(F.exists(of, test), F.lit(name))
    evidence = F.flatten(F.transform(r, lambda v: F.coalesce(v["evidence"], F.array().cast("array<struct<docId string, snippet string>>"))))
    errors = F.array_compact(
        F.array(
            F.when(F.col("x").isNull(), F.lit("not JSON")),
            F.when(F.col("x.docId").isNull(), F.lit("docId missing")),
            F.when(e.isNull(), F.lit("entities missing")),
            F.when(r.isNull(), F.lit("relations missing")),
            bad("entity without name", e, lambda v: none(v["name"])),
            bad("entity without type", e, lambda v: none(v["type"])),
            bad("relation without end", r, lambda v: none(v["source"]) | none(v["target"]) | none(v["rel"])),
            bad("kind", r, lambda v: ~F.coalesce(v["kind"].isin(*KINDS), F.lit(False))),
            bad("confidence", r, lambda v: ~F.coalesce(v["confidence"].between(0, 1), F.lit(False))),
            bad("asserted without evidence", r, lambda v: (v["kind"] == "asserted") & (F.coalesce(F.size(v["evidence"]), F.lit(0)) <= 0)),
            bad("evidence without document", evidence, lambda v: none(v["docId"])),
        )
    )
    return parsed.select("doc_id", errors.alias("errors"), *others)


def evidence_fidelity(snippets: DataFrame, texts: DataFrame, least: float = 0.7) -> DataFrame:
    """Gate A: share of non-blank snippets found in their document; none passes with 1."""
    s = snippets.select("doc_id", collapse(F.col("snippet")).alias("s"))
    t = texts.select("doc_id", collapse(F.col("text")).alias("t"))
    j = t.join(s.where("s <> ''"), "doc_id", "left")
    agg = j.groupBy("doc_id").agg(F.count("s").alias("snippets"), F.count_if(F.col("t").contains(F.col("s"))).alias("found"))
    rate = F.when(F.col("snippets") > 0, F.col("found") / F.col("snippets")).otherwise(1.0)
    return agg.select("doc_id", "snippets", "found", F.round(rate, 6).alias("rate"), (rate >= least).cast("int").alias("passed"))


def _orphans(parsed: DataFrame, *others: str) -> DataFrame:
    """doc_id, `ends` and `orphans` (null without relations), and other columns. Names are columns of their own, so that they are made once an answer, not once an end."""
    d = parsed.select("doc_id", *others, F.transform("x.entities", lambda e: F.lower(e["name"])).alias("_names"), F.flatten(F.transform("x.relations", lambda r: F.array(F.lower(r["source"]), F.lower(r["target"])))).alias("_ends"))
    lost = F.when(F.col("_names").isNull(), F.size("_ends")).otherwise(F.size(F.filter("_ends", lambda e: ~F.coalesce(F.array_contains("_names", e), F.lit(False)))))
    return d.select("doc_id", *others, F.size("_ends").alias("ends"), lost.alias("orphans"))


def orphan_share() -> Column:
    return F.coalesce(F.when(F.col("ends") > 0, F.col("orphans") / F.col("ends")), F.lit(0.0))


def orphan_rate(parsed: DataFrame, most: float = 0.3) -> DataFrame:
    """Gate B: relation ends that name no entity, over all ends, regardless of case."""
    rate = orphan_share()
    return _orphans(parsed).select("doc_id", F.coalesce("orphans", F.lit(0)).alias("orphans"), rate.alias("rate"), (rate <= most).cast("int").alias("passed"))


def zero_value(n_chars: Column, entities: Column, relations: Column) -> Column:
    """Gate C: 1 passes; short texts are not looked at."""
    return F.when(n_chars < 500, 1).when(entities == 0, 0).when((entities > 3) & (relations == 0), 0).otherwise(1)


def bare_count(sure: float = 0.8) -> Column:
    hit = lambda r: (
        (r["kind"] == "asserted") & (r["confidence"] >= sure) & ((F.coalesce(F.size(r["evidence"]), F.lit(0)) <= 0) | F.exists(r["evidence"], lambda e: F.coalesce(F.trim(e["snippet"]), F.lit("")) == ""))
    )
    return F.coalesce(F.size(F.filter("x.relations", hit)), F.lit(0))


def bare_assertions(parsed: DataFrame, sure: float = 0.8) -> DataFrame:
    """Gate D: sure asserted relations without a full set of snippets, once per relation."""
    return parsed.select("doc_id", bare_count(sure).alias("bare")).withColumn("passed", (F.col("bare") == 0).cast("int"))


def verdict(parsed: DataFrame, texts: DataFrame, least: float = 0.7, most: float = 0.3) -> DataFrame:
    """(doc_id, passed, reasons): all four gates of every readable answer, with the reasons of those that fail.

    texts: doc_id, text, n_chars. An answer that can't be read fails with one reason. Answers are
    read once: what the gates need of them is made beside each other, and the texts join that.
    """
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    snippets = F.flatten(F.transform(F.filter("x.relations", lambda r: r["evidence"].isNotNull()), lambda r: F.transform(r["evidence"], lambda e: e["snippet"])))
    given = parsed.select(
        "doc_id", F.col("x"), F.transform(snippets, collapse).alias("said"), bare_count().alias("bare"), size("x.entities").alias("entities"), size("x.relations").alias("relations"), F.col("x").isNull().alias("unread")
    )
    given = _orphans(given, "said", "bare", "entities", "relations", "unread").withColumn("said", F.filter("said", lambda s: s != ""))
    j = given.join(texts.select("doc_id", F.lit(True).alias("there"), collapse(F.col("text")).alias("t"), "n_chars"), "doc_id", "left")
    found = F.when(F.col("t").isNull(), 0).otherwise(F.coalesce(F.size(F.filter("said", lambda s: F.contains("t", s))), F.lit(0)))  # two uses of t keep it a column
    j = j.withColumn("snippets", F.coalesce(F.size("said"), F.lit(0))).withColumn("found", found)
    rate = F.when(F.col("snippets") > 0, F.col("found") / F.col("snippets")).otherwise(1.0)
    c = zero_value(F.coalesce("n_chars", F.lit(0)), F.col("entities"), F.col("relations"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("there") & (rate < least), F.concat(F.lit("evidence_fidelity: "), "found", F.lit(" of "), "snippets")),
            F.when(orphan_share() > most, F.concat(F.lit("orphan_endpoints: "), "orphans", F.lit(" orphans"))),
            F.when(c == 0, F.concat(F.lit("zero_value: "), F.when(F.col("entities") == 0, "no entities").otherwise("no relations"))),
            F.when(F.col("bare") > 0, F.concat(F.lit("high_conf_bad_evidence: "), "bare", F.lit(" flagged"))),
        )
    )
    out = j.select("doc_id", F.when(F.col("unread"), F.array(F.lit("not JSON"))).otherwise(reasons).alias("reasons"))
    return out.select("doc_id", (F.size("reasons") == 0).cast("int").alias("passed"), F.array_join("reasons", "; ").alias("reasons"))


VERDICTS = ("merge", "keep_separate", "uncertain")


def pair_verdicts(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """(batch, i, a, b, verdict, confidence, reason) of every pair that was asked about.

    pairs: batch, i (from 0), a, b. answers: batch, answer: a JSON array of verdicts in the
    pairs' order, or one object, bare, in a code fence or inside other text. Unlisted verdicts,
    missing ones and answers that can't be read leave a pair uncertain, with the reason.
    """
    body = F.regexp_replace(F.regexp_replace(F.trim("answer"), "^```(?:json)?\\s*", ""), "\\s*```$", "")
    v = F.coalesce(F.try_parse_json(body), F.try_parse_json(F.regexp_extract(body, r"(?s)\[.*\]", 0)))
    listed = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v)))
    j = pairs.join(answers.select("batch", listed.alias("listed")), "batch", "left")
    own = F.try_element_at("listed", F.col("i") + 1)
    said = F.lower(F.trim(F.try_variant_get(own, "$.verdict", "string")))
    lost = F.when(F.col("listed").isNull(), "answer can't be read").when(own.isNull(), "no verdict for this pair")
    return j.select(
        "batch", "i", "a", "b", F.when(said.isin(*VERDICTS), said).otherwise("uncertain").alias("verdict"),
        F.coalesce(F.try_variant_get(own, "$.confidence", "double"), F.lit(0.0)).alias("confidence"),
        F.coalesce(lost, F.try_variant_get(own, "$.reason", "string"), F.lit("")).alias("reason"),
    )


def import_answers(parsed: DataFrame, ids: DataFrame, documents: DataFrame, key: Callable[[Column], Column] = lambda name: name) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(relations, evidence, states) of parsed answers.

    ids: name, entity_id (one per name); documents: doc_id, url. Relation ends are resolved by
    name; a relation with an end that isn't known is dropped, and counted. Every known entity
    of an answer gets a MENTIONS relation from its document (asserted, confidence 1).
    Evidence takes the document's url before its own. states: doc_id, status (extracted, or
    error for an answer that can't be read), relations, dropped.
    key: makes what doc_ids, names in ids and entity_ids are from a name's text; null for a text that no name there has.
    """
    # Each of the three reads the answers once: outer explodes, as others put filters in front that read them again.
    # Keys are made after explodes, in the rows that are dealt. Sources are met first, so that what they drop is dealt once.
    found = lambda end: ids.select(F.col("name").alias(end), F.col("entity_id").alias(f"{end}_id"))
    own = F.col("doc_id")  # stands where there is no name, so that such rows are not dealt to one task
    links = _links(parsed, key).join(found("source"), "source", "left").where("source_id is not null or tells_target").drop("source")
    links = links.join(found("target"), "target", "left")
    link = lambda source, rel, target, kind, confidence: F.struct(F.col(source).alias("source_id"), rel.alias("rel"), F.col(target).alias("target_id"), kind.alias("kind"), confidence.alias("confidence"))
    mention = lambda end: F.when(F.col(f"tells_{end}") & F.col(f"{end}_id").isNotNull(), link("doc_id", F.lit("MENTIONS"), f"{end}_id", F.lit("asserted"), F.lit(1.0)))
    told = F.when(F.col("linked") & F.col("source_id").isNotNull() & F.col("target_id").isNotNull(), link("source_id", F.col("rel"), "target_id", F.col("kind"), F.col("confidence")))
    relations = links.select("doc_id", F.explode(F.array_compact(F.array(told, mention("source"), mention("target")))).alias("r")).select("doc_id", "r.*")

    r = parsed.select("doc_id", F.posexplode_outer("x.relations").alias("i", "r")).where("i is not null")
    named = r.select("doc_id", "i", key(F.col("r.source")).alias("source"), key(F.col("r.target")).alias("target"), F.col("r.evidence").alias("evidence"))
    solved = named.join(found("source").drop("source_id"), "source", "left_semi").drop("source").join(found("target").drop("target_id"), "target", "left_semi")
    evidence = solved.select("doc_id", "i", F.explode("evidence").alias("e")).join(documents.select("doc_id", "url"), "doc_id", "left").select("doc_id", "i", F.coalesce("url", "e.docId").alias("url"), F.col("e.snippet").alias("snippet"))

    ends = parsed.select("doc_id", F.col("x").isNull().alias("unread"), F.posexplode_outer("x.relations").alias("i", "r"))
    ends = ends.select("doc_id", "unread", F.col("i").isNotNull().alias("one"), key(F.col("r.source")).alias("source"), key(F.col("r.target")).alias("target"))
    ends = ends.select("doc_id", "unread", "one", (F.col("source").isNotNull() & F.col("target").isNotNull()).alias("whole"), F.coalesce("source", own).alias("source"), F.coalesce("target", own).alias("target"))
    known = lambda end: ids.select(F.col("name").alias(end), F.lit(True).alias(f"{end}_known"))
    ends = ends.join(known("source"), "source", "left").select("doc_id", "unread", "one", (F.col("whole") & F.coalesce("source_known", F.lit(False))).alias("whole"), "target")
    ends = ends.join(known("target"), "target", "left").select("doc_id", "unread", "one", (F.col("whole") & F.coalesce("target_known", F.lit(False))).alias("met"))
    states = ends.groupBy("doc_id").agg(
        F.when(F.bool_and("unread"), "error").otherwise("extracted").alias("status"), F.count_if(F.col("one") & F.col("met")).alias("relations"), F.count_if(F.col("one") & ~F.col("met")).alias("dropped")
    )
    return relations, evidence, states


def _links(parsed: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """doc_id, source, target (keys, never null), rel, kind, confidence, linked, tells_source, tells_target: the relations that have
    both ends. An entity that is an end of a relation is told by the first one, with which it is dealt; one that is no end has a
    row of its own, not linked, as has a relation with an end that has no key.
    """
    d = parsed.select("doc_id", F.filter("x.relations", lambda r: r["source"].isNotNull() & r["target"].isNotNull()).alias("r"), F.array_compact(F.array_distinct("x.entities.name")).alias("named"))
    d = d.select("doc_id", F.coalesce("r", F.array().cast(d.schema["r"].dataType)).alias("r"), F.coalesce("named", F.array().cast("array<string>")).alias("named"))
    d = d.withColumn("sources", F.col("r.source")).withColumn("targets", F.col("r.target"))
    row = lambda source, target, linked, tells_source, tells_target, r=None: F.struct(
        source.alias("source"), target.alias("target"), *((r[c] if r is not None else F.lit(None).cast(kind)).alias(c) for c, kind in (("rel", "string"), ("kind", "string"), ("confidence", "double"))),
        F.lit(linked).alias("linked"), tells_source.alias("tells_source"), tells_target.alias("tells_target"),
    )
    first = lambda end, i, n: (F.array_position(end, n) == i + 1) & F.array_contains("named", n)
    linked = F.transform("r", lambda r, i: row(r["source"], r["target"], True, first("sources", i, r["source"]), first("targets", i, r["target"]) & ~F.array_contains("sources", r["target"]), r))
    alone = F.transform(F.array_except("named", F.concat("sources", "targets")), lambda n: row(n, n, False, F.lit(True), F.lit(False)))
    d = d.select("doc_id", F.explode(F.concat(linked, alone)).alias("l")).select("doc_id", "l.*").withColumns({end: key(F.col(end)) for end in ("source", "target")})
    known = {end: F.col(end).isNotNull() for end in ("source", "target")}
    return d.where(known["source"] | known["target"]).select(
        "doc_id", F.coalesce("source", "target").alias("source"), F.coalesce("target", "source").alias("target"), "rel", "kind", "confidence",
        (F.col("linked") & known["source"] & known["target"]).alias("linked"), *((F.col(f"tells_{end}") & known[end]).alias(f"tells_{end}") for end in known),
    )
