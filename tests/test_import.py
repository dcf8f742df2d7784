"""Answers that are imported: what is found in them, and how many rows move for it."""

import json
import random
from collections import Counter

import pytest

from tidegraph.operators import extraction
from tidegraph.plans.registry import QUERIES
from tidegraph.sources import testdata as t

SF = "/root/testdata/sf0.001"


def slow_import(answers, ids, urls):
    """The same, answer by answer."""
    links, evidence, states = [], [], {}
    for doc, answer in answers:
        try:
            x = json.loads(answer)
        except ValueError:
            states.setdefault(doc, ["error", 0, 0])
            continue
        state = states.setdefault(doc, ["extracted", 0, 0])
        state[0] = "extracted"
        for i, r in enumerate(x.get("relations") or []):
            source, target = ids.get(r.get("source")), ids.get(r.get("target"))
            state[1 if source and target else 2] += 1
            if source and target:
                links.append((doc, source, r["rel"], target, r.get("kind"), r.get("confidence")))
                evidence += [(doc, i, urls.get(doc) or e["docId"], e["snippet"]) for e in r.get("evidence") or []]
        links += [(doc, doc, "MENTIONS", ids[n], "asserted", 1.0) for n in {e.get("name") for e in x.get("entities") or []} if n in ids]
    return Counter(links), Counter(evidence), {k: tuple(v) for k, v in states.items()}


def drawn(r, names):
    def one(kinds):
        return {k: r.choice(kinds[k]) for k in kinds if r.random() < 0.9}

    ends = [*names, None]
    relations = [one({"source": ends, "target": ends, "kind": ["asserted", "guess", None], "confidence": [0.5, 0.93, None]}) | {"rel": r.choice("RS")} for _ in range(r.randint(0, 5))]
    for x in relations:
        if r.random() < 0.7:
            x["evidence"] = [{"docId": r.choice("pq"), "snippet": r.choice("st")} for _ in range(r.randint(0, 2))]
    x = {"docId": "d", "entities": [one({"name": ends, "type": ["T"]}) for _ in range(r.randint(0, 5))], "relations": relations}
    for k in ("entities", "relations"):
        if r.random() < 0.1:
            x[k] = None
    return json.dumps(x) if r.random() < 0.95 else "{"


@pytest.mark.parametrize("coded", [False, True])
def test_drawn_answers_are_imported_as_one_by_one(spark, coded):
    r = random.Random(7)
    names = ["part:1", "part:2", "supplier:1", "supplier:01", "customer:9", "part:", ":3", "doc:1", "doc:2", "no one", "part:99999999999999999999", "part:2305843009213693953", "Part:1"]
    texts = {n: n for n in ("part:1", "part:2", "supplier:1", "doc:1", "doc:2", "doc:3")} | ({} if coded else {"no one": "part:7", "Part:1": "part:1"})
    answers = [(f"doc:{r.randint(1, 60)}", drawn(r, names)) for _ in range(150)]  # several of a document
    urls = {f"doc:{i}": None if i % 3 else f"u{i}" for i in range(1, 50)}
    parsed = extraction.parse(spark.createDataFrame(answers, "doc_id string, answer string"))
    ids = spark.createDataFrame(list(texts.items()), "name string, entity_id string")
    docs = spark.createDataFrame(list(urls.items()), "doc_id string, url string")
    if coded:
        code = {c: t.code_of(ids[c]) for c in ids.columns}
        ids, docs, parsed = ids.withColumns(code), docs.withColumn("doc_id", t.code_of(docs["doc_id"])), parsed.withColumn("doc_id", t.code_of(parsed["doc_id"]))
        links, evidence, states = extraction.import_answers(parsed, ids, docs, t.code_of)
        links, evidence, states = t.texts(links, "doc_id", "source_id", "target_id"), t.texts(evidence, "doc_id"), t.texts(states, "doc_id")
    else:
        links, evidence, states = extraction.import_answers(parsed, ids, docs)
    want = slow_import(answers, texts, urls)
    assert Counter(tuple(x) for x in links.select("doc_id", "source_id", "rel", "target_id", "kind", "confidence").collect()) == want[0]
    assert Counter(tuple(x) for x in evidence.collect()) == want[1]
    assert {x["doc_id"]: (x["status"], x["relations"], x["dropped"]) for x in states.collect()} == want[2]


def test_only_texts_of_codes_have_one(spark):
    good = ["doc:0", "part:17", "region:5", f"customer:{2**60 - 1}"]
    bad = ["", ":", "doc", "doc:", "doc:01", "doc:+1", "doc: 1", "doc:1.0", "dog:1", "doc:1:2", "a:doc:1", f"doc:{2**60}", "doc:9223372036854775808", None]
    d = spark.createDataFrame([(x,) for x in good + bad], "id string").select("id", t.code_of(t.F.col("id")).alias("code")).withColumn("back", t.text("code"))
    assert {x["id"]: x["back"] for x in d.collect()} == {x: x for x in good} | dict.fromkeys(bad)


@pytest.mark.parametrize("name, most", [("e12_import_links", 7), ("e12_import_states", 10), ("e12_import_evidence", 10)])
def test_rows_that_imports_move_have_numbers_and_are_few(spark, name, most):
    """At most so many rows a line, lines and ids included, none dealt by texts."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark._jvm.java.util.ArrayList()

    def moved():
        stages = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before, made = moved(), QUERIES[name](spark, SF)
        made.write.format("noop").mode("overwrite").save()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        dealt = made._jdf.queryExecution().executedPlan().toString()
        rows = (moved() - before) / t.table(spark, SF, "lineitem").count()
        assert rows < most, rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [x.split("hashpartitioning(")[1].split(",")[0] for x in dealt.splitlines() if "Exchange hashpartitioning(" in x]
    assert keys and all(k.endswith("L") for k in keys), keys
