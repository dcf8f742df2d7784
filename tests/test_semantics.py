"""Rules of the model on small tables: windows, scores, views, selection, resolution, gates."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidegraph.functions import scoring as s
from tidegraph.functions import text as x
from tidegraph.operators import extraction, graph, resolve, selection, tables, trend
from tidegraph.streaming import jobs

P = s.Profile()
AS_OF = "2024-03-01"


def ago(n):
    return (date.fromisoformat(AS_OF) - timedelta(days=n)).isoformat()


def mentions(spark, days, source="a"):
    rows = [(e, f"d{e}{i}", ago(d), source) for e, ds in days.items() for i, d in enumerate(ds)]
    return spark.createDataFrame(rows, "entity_id string, doc_id string, published string, source string")


def test_windows_are_closed_at_both_ends(spark):
    m = mentions(spark, {"a": range(0, 20, 2), "b": range(0, 50, 5), "c": [7, 8]})
    got = {r["entity_id"]: r for r in trend.mention_windows(m, AS_OF, P).collect()}
    assert got["a"]["c7"] == 4 and got["b"]["c30"] == 7
    assert (got["c"]["c7"], got["c"]["p7"]) == (1, 2)
    late = spark.createDataFrame([("a", "d", AS_OF + "T10:00Z", "s")], "entity_id string, doc_id string, published string, source string")
    assert trend.mention_windows(late, AS_OF, P).first()["c7"] == 0


@pytest.mark.parametrize(("r", "p", "want"), [(0, 0, 0.0), (2, 9, 1.0), (4, 0, 4.0), (9, 0, 5.0), (12, 2, 6.0), (0, 3, 0.0)])
def test_velocity(spark, r, p, want):
    got = spark.createDataFrame([(r, p)], "r int, p int").select(s.velocity(F.col("r"), F.col("p"), P).alias("v"))
    assert got.first()["v"] == pytest.approx(want)


def test_velocity_floor(spark):
    d = spark.createDataFrame([(0, 0), (3, 1), (30, 10), (12, 0), (1, 0), (2, 10)], "r int, p int")
    v = [r["v"] for r in d.select(s.velocity_floor(F.col("r"), F.col("p")).alias("v")).collect()]
    assert v[0] is None and v[1] < v[2] < 3 and 1 < v[3] < 12 and v[4] < 1 and v[5] < 1


def test_novelty_without_a_first_day(spark):
    d = spark.createDataFrame([(None, 1, 10), ("bad", 1, 10), (AS_OF, 0, 10)], "f string, m int, n int")
    v = [r["v"] for r in d.select(s.novelty(F.col("f"), F.col("m"), F.col("n"), AS_OF, P).alias("v")).collect()]
    assert v[:2] == [0.5, 0.5] and v[2] == pytest.approx(1.0)


EDGES = "relation_id long, source_id string, rel string, target_id string, kind string, confidence double, doc_id string, snippet string"


def test_edge_aggregation(spark):
    r = spark.createDataFrame(
        [(1, "a", "X", "b", "asserted", 0.9, "d1", "s"), (2, "a", "X", "b", "asserted", 0.95, "d2", "t"), (3, "a", "X", "b", "inferred", 0.7, "d3", "s"), (4, "a", "X", "c", "odd", 0.5, "d1", "s")], EDGES
    )
    got = {r["edge_id"]: r for r in graph.aggregate_edges(r).collect()}
    e = got["e:a:X:b"]
    assert (e["confidence"], e["kind"], e["relation_id"], e["doc_count"], e["doc_id"], e["snippets"]) == (0.95, "asserted", 2, 3, None, 2)
    assert got["e:a:X:c"]["doc_id"] == "d1"
    assert sorted(x["relation_id"] for x in graph.edge_evidence(r).collect()) == [1, 2, 4]


def test_region_tags_reach_two_hops(spark):
    e = spark.createDataFrame([("prod", "city"), ("person", "prod"), ("far", "person"), ("other", "town")], "source_id string, target_id string")
    tags = graph.region_tags(e, spark.createDataFrame([("city", "north")], "entity_id string, tag string"))
    assert {r["entity_id"] for r in tags.collect()} == {"city", "prod", "person"}


def test_bridges(spark):
    e = spark.createDataFrame([("t1", "t2"), ("t3", "b"), ("b", "t1"), ("t3", "lone"), ("t4", "z"), ("z", "q")], "source_id string, target_id string")
    t = spark.createDataFrame([(f"t{i}",) for i in range(1, 5)], "entity_id string")
    assert [(r["bridge"], r["touched"]) for r in graph.bridges(e, t).collect()] == [("b", 2)]


def test_islands_and_orphans(spark):
    e = spark.createDataFrame([(1, "a", "X", "b"), (2, "c", "MENTIONS", "d")], "relation_id long, source_id string, rel string, target_id string")
    n = spark.createDataFrame([(k,) for k in "abcd"], "entity_id string")
    assert sorted(r[0] for r in graph.islands(n, e).collect()) == ["c", "d"]
    assert graph.strip_orphans(e, n.where("entity_id <> 'b'")).count() == 1


def test_inference_over_a_table_of_rules(spark):
    """Types, loops, known edges, one order over all rules, and the cap."""
    r = spark.createDataFrame(
        [(1, "a", "P", "b", 0.5), (2, "b", "Q", "c", 0.5), (3, "b", "Q", "a", 0.9), (4, "z", "P", "b", 1.0), (5, "z", "N", "c", 1.0), (6, "b", "Q", "y", 1.0), (7, "a", "P", "y", 0.5)],
        "relation_id long, source_id string, rel string, target_id string, confidence double",
    )
    e = spark.createDataFrame([(k, "T" if k != "y" else "Y") for k in "abcyz"], "entity_id string, type string")
    rules = [([("P", "T", "T"), ("Q", "T", "T")], "N", 0.8), ([("Q", "T", "T")], "N", 1.0), ([("P", "Y", "T")], "M", 1.0), ([("P", "T", "T"), ("Q", "T", "T"), ][:2], "M", 0.5)]
    got = [tuple(x) for x in graph.infer(r, e, rules).collect()]
    assert got == [("a", "N", "c", 0, 1, 2, 0.2), ("z", "N", "a", 0, 4, 3, 0.72), ("b", "N", "c", 1, 2, None, 0.5), ("b", "N", "a", 1, 3, None, 0.9), ("a", "M", "c", 3, 1, 2, 0.125), ("z", "M", "c", 3, 4, 2, 0.25), ("z", "M", "a", 3, 4, 3, 0.45)]
    assert [tuple(x) for x in graph.infer(r, e, rules, 2).collect()] == got[:2]
    c = spark.createDataFrame([("a", "P", "b"), ("a", "P", "c"), ("a", "P", "c"), ("a", "Q", "b")], "source_id string, rel string, target_id string")
    assert sorted(map(tuple, graph.new_edges(c, r).collect())) == [("a", "P", "c"), ("a", "Q", "b")]


def test_trending_view(spark):
    rows = [("t1", "t2"), ("t3", "b"), ("b", "t1"), ("t3", "lone"), ("t4", "z"), ("z", "q"), ("b", "b2"), ("b2", "t3"), ("b2", "t2")]
    r = spark.createDataFrame([(i, a, "X", b, "asserted", 0.5, f"d{i}", "s") for i, (a, b) in enumerate(rows)], "relation_id long, source_id string, rel string, target_id string, kind string, confidence double, doc_id string, snippet string")
    nodes, edges = graph.trending_view(r, spark.createDataFrame([(f"t{i}", float(i)) for i in range(1, 5)], "entity_id string, trend_score double"))
    assert {tuple(x) for x in nodes.collect()} == {*((f"t{i}", float(i), False) for i in range(1, 5)), ("b", 0.0, True), ("b2", 0.0, True)}
    assert {x["edge_id"] for x in edges.collect()} == {"e:t1:X:t2", "e:t3:X:b", "e:b:X:t1", "e:b2:X:t3", "e:b2:X:t2"}
    steps = {x["entity_id"]: x["hops"] for x in graph.hops(r, spark.createDataFrame([("q", "x")], "entity_id string, tag string"), 2).collect()}
    assert steps == {"q": 0, "z": 1, "t4": 2}


def slow_select(rows, budget, stretch):
    rows = sorted((r for r in rows if r[2] >= 0.2), key=lambda r: (-r[2], r[0]))
    if len(rows) <= budget:
        return {r[0] for r in rows}
    best = {}
    for r in rows:
        best.setdefault(r[1], r)
    chosen = list(best.values())[:stretch]
    for r in rows:
        if len(chosen) < budget and r not in chosen:
            chosen.append(r)
    for r in rows:
        if len(chosen) < stretch and r not in chosen and r[2] >= 0.55:
            chosen.append(r)
    return {r[0] for r in chosen}


@pytest.mark.parametrize("seed", range(4))
def test_selection_is_the_loop(spark, seed):
    r = random.Random(seed)
    rows = [(i, f"f{r.randint(0, 12)}", round(r.random(), 2)) for i in range(r.choice([8, 60]))]
    d = spark.createDataFrame(rows, "doc_id int, source string, combined_score double")
    got = selection.select(d, 10, 15)
    assert {x["doc_id"] for x in got.where("outcome = 'selected'").collect()} == slow_select(rows, 10, 15)
    assert got.count() == len(rows)


def slow_similarity(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if a.replace(" ", "").replace("-", "") == b.replace(" ", "").replace("-", ""):
        return 1.0
    if a in b or b in a:
        return min(len(a), len(b)) / max(len(a), len(b))
    p, q = set(a.split(" ")), set(b.split(" "))
    j = len(p & q) / len(p | q)
    return max(j, 0.7) if len(p & q) >= min(len(p), len(q)) else j


def test_blocked_pairs_and_greedy_pass(spark):
    r = random.Random(7)
    words = "open ai gpt 4 turbo deep mind lab x y ab a-b".split()
    names = [(f"e{i}", "T" if i % 4 else "U", i, " ".join(r.choice(words) for _ in range(r.randint(1, 3)))) for i in range(60)]
    d = spark.createDataFrame(names, "id string, type string, ord int, name string")
    want = {(a[0], b[0]) for a in names for b in names if a[2] < b[2] and a[1] == b[1] and slow_similarity(a[3], b[3]) >= 0.6}
    pairs = resolve.similar_pairs(d, 0.6)
    assert {(p["a"], p["b"]) for p in pairs.collect()} == want
    # aliases count against names, not against each other; decided pairs go
    aliases = [(f"e{i}", " ".join(r.choice(words) for _ in range(2))) for i in range(0, 60, 3)]
    kind, place, of = {n[0]: n[1] for n in names}, {n[0]: n[2] for n in names}, {}
    for e, _, _, n in names:
        for f, m in [(n[0], n[3]) for n in names] + aliases:
            if e != f and kind[e] == kind[f]:
                key = (e, f) if place[e] < place[f] else (f, e)
                of[key] = max(of.get(key, 0), slow_similarity(n, m))
    decided = sorted(k for k, v in of.items() if v >= 0.5)[:5]
    got = resolve.similar_pairs(d, 0.5, 0.9, spark.createDataFrame(aliases, "id string, name string"), spark.createDataFrame([(b, a) for a, b in decided], "a string, b string"))
    assert {(p["a"], p["b"]): p["similarity"] for p in got.collect()} == {k: round(v, 6) for k, v in of.items() if 0.5 <= v < 0.9 and k not in decided}
    canon = {}
    for i, _, _, _ in names:
        if i not in canon:
            canon[i] = i
            for a, b in sorted(want):
                if a == i and b not in canon:
                    canon[b] = i
    assert {x["id"]: x["canonical"] for x in resolve.assign(d, pairs).collect()} == canon


def test_names(spark):
    d = spark.createDataFrame([("  Café  (X) ", "GPT-4"), ("", "")], "a string, b string")
    assert [r[0] for r in d.select(x.normalize_name(F.col("a"))).collect()] == ["café x", ""]
    assert [r[0] for r in d.select(x.slugify(F.col("b"))).collect()] == ["gpt_4", "source"]


def test_merge(spark):
    r = spark.createDataFrame([(1, "a", "X", "c", "k", "d"), (2, "b", "X", "c", "k", "d"), (3, "b", "X", "c", "k", "e"), (4, "a", "X", "b", "k", None)], "relation_id long, source_id string, rel string, target_id string, kind string, doc_id string")
    m = spark.createDataFrame([("b", "a"), ("a", "a"), ("c", "c")], "id string, canonical string")
    got = sorted((x["relation_id"], x["source_id"], x["target_id"], x["merged"]) for x in resolve.merge_relations(r, m).collect())
    assert got == [(1, "a", "c", 2), (3, "a", "c", 1), (4, "a", "a", 1)]


def test_answers(spark):
    good = '{"docId":"1","entities":[{"name":"A","type":"T"},{"name":"B","type":"T"}],"relations":[{"source":"a","rel":"R","target":"B","kind":"asserted","confidence":0.9,"evidence":[{"docId":"1","snippet":"x"}]}],"techTerms":["t",{"term":"u"},{"name":"v"},{"z":1},""]}'
    bad = '{"docId":"2","entities":[],"relations":[{"source":"a","rel":"R","target":"Z","kind":"maybe","confidence":95,"evidence":[]},{"source":"a","rel":"R","target":"Z","kind":"asserted","confidence":0.9,"evidence":[]}]}'
    p = extraction.parse(spark.createDataFrame([(1, f"```json\n{good}\n```"), (2, bad), (3, "sorry")], "doc_id int, answer string"))
    e = {r["doc_id"]: r["errors"] for r in extraction.validate(p).collect()}
    assert e[1] == [] and set(e[2]) == {"kind", "confidence", "asserted without evidence"} and "not JSON" in e[3]
    texts = spark.createDataFrame([(1, "some X here", 900), (2, "y", 900), (3, "z", 9)], "doc_id int, text string, n_chars int")
    v = {r["doc_id"]: (r["passed"], r["reasons"]) for r in extraction.verdict(p, texts).collect()}
    assert v == {1: (1, ""), 2: (0, "orphan_endpoints: 4 orphans; zero_value: no entities; high_conf_bad_evidence: 1 flagged"), 3: (0, "not JSON")}
    assert [r[0] for r in p.where("doc_id = 1").select(extraction.tech_terms(F.col("x.techTerms"))).collect()] == [["t", "u", "v", '{"z":1}']]
    b = {r["doc_id"]: (r["bare"], r["passed"]) for r in extraction.bare_assertions(p).collect() if r["doc_id"] < 3}
    assert b == {1: (0, 1), 2: (1, 0)}


def test_tables(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, tables.replace(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, tables.insert_ignore(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]


def test_stream_equals_batch(spark, tmp_path):
    d = spark.createDataFrame([(f"e{i % 3}", f"2024-01-0{1 + i % 5} 00:00:00", f"u{i % 7}") for i in range(20)], "entity_id string, ts string, url string")
    d.repartition(3).write.json(str(tmp_path / "in"))
    stream = jobs.read_json(spark, str(tmp_path / "in"), "entity_id string, ts timestamp, url string", 1)
    jobs.run_available(jobs.first_last(stream), str(tmp_path / "out"), str(tmp_path / "c"), "complete")
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, d.select("entity_id", F.col("ts").cast("timestamp").alias("ts")).groupBy("entity_id").agg(F.min("ts"), F.max("ts")).collect()))
    assert got == want
    jobs.run_available(jobs.dedup(stream, late="30 days"), str(tmp_path / "out2"), str(tmp_path / "c2"))
    assert spark.read.parquet(str(tmp_path / "out2")).select("url").distinct().count() == spark.read.parquet(str(tmp_path / "out2")).count() == 7


def test_entry_without_llm():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100


def slow_inference(relations, kinds, rules, cap):
    have = {(s, r, t) for _, s, r, t, _ in relations}
    ends = lambda x, a: (x[2], kinds.get(x[1]), kinds.get(x[3])) == a
    best = {}
    for i, (a, new, discount) in enumerate(rules):
        ways = [(x, y) for x in relations for y in relations if ends(x, a[0]) and ends(y, a[1]) and x[3] == y[1]] if len(a) > 1 else [(x, None) for x in relations if ends(x, a[0])]
        for x, y in ways:
            c = (y or x)[3]
            if x[1] != c and (x[1], new, c) not in have:
                key = (i, x[0], y[0] if y else None)
                at = (x[1], new, c)
                if at not in best or key < best[at][0]:
                    best[at] = (key, int(min(1.0, x[4] * (y[4] if y else 1) * discount) * 1000 + 0.5) / 1000)  # halves go up
    out = sorted(best.items(), key=lambda z: z[1][0])[:cap]
    return [(*at, *key, conf) for at, (key, conf) in out]


@pytest.mark.parametrize("cap", [1, 3, 1000])
def test_inference_equals_all_pairs(spark, cap):
    """Hubs, equal steps, known edges and loops, with caps below and above what there is."""
    rng = random.Random(cap)
    rel = [(i, rng.choice("abcdefgh"), rng.choice("PPPQQN"), rng.choice("hhhabcdefg"), rng.randint(1, 8) / 8) for i in range(120)]
    kinds = {k: "T" for k in "abcdefgh"}
    rules = [([("P", "T", "T"), ("Q", "T", "T")], "N", 0.5), ([("P", "T", "T")], "M", 0.5), ([("Q", "T", "T"), ("P", "T", "T")], "M", 1.0)]
    r = spark.createDataFrame(rel, "relation_id long, source_id string, rel string, target_id string, confidence double")
    e = spark.createDataFrame(list(kinds.items()), "entity_id string, type string")
    assert [tuple(x) for x in graph.infer(r, e, rules, cap).collect()] == slow_inference(rel, kinds, rules, cap)


def slow_clusters(ents, size, least, most):
    order = sorted(ents, key=lambda d: (-len(ents[d]), d))
    out, used = [], set()
    for seed in order:
        if seed in used:
            continue
        group, union = [seed], set(ents[seed])
        for d in order:
            if len(group) < size and d not in used and d != seed and len(union & ents[d]) >= least:
                group.append(d)
                union |= ents[d]
        if len(group) > 1:
            used |= set(group)
            out.append((group, len(union)))
        if len(out) >= most:
            break
    return [(k, i, d, n) for k, (group, n) in enumerate(out) for i, d in enumerate(group)]


@pytest.mark.parametrize(("size", "least", "most"), [(3, 1, 2), (4, 2, 9)])
def test_clusters_equal_the_loop(spark, size, least, most):
    rng = random.Random(size)
    ents = {f"d{i:02}": {rng.randint(0, 30) for _ in range(rng.randint(1, 5))} for i in range(18)}
    rows = [(d, f"e{x}") for d, xs in ents.items() for x in xs]
    m = spark.createDataFrame(rows + rows[:3] + [(None, "e1"), ("d99", None)], "doc_id string, entity_id string")
    got = sorted(map(tuple, graph.clusters(m, size, least, most).select("cluster", "place", "doc_id", "entities").collect()))
    assert got == slow_clusters(ents, size, least, most) and got
    assert graph.clusters(m.limit(0)).count() == 0


def test_style_of_nodes_and_edges(spark):
    n = spark.createDataFrame([("a", 1, None, "2024-02-28", None), ("b", 8, 9.0, "2024-02-16", "2024-02-01"), ("c", 0, 0.8, None, "x"), ("d", None, 0.0, "2023-01-01", "2023-12-10")], "id string, degree int, velocity double, first_seen string, last_seen string")
    got = {r["id"]: (r["size"], r["opacity"], r["labelled"]) for r in graph.node_style(n, AS_OF).collect()}
    assert got == {"a": (45.0, 0.5, False), "b": (80.0, 0.8, True), "c": (pytest.approx(42.0), 0.5, True), "d": (30.0, 0.6, False)}
    w = spark.createDataFrame([(None,), (0.0,), (1.0,), (2.0,), (-1.0,)], "c double").select(graph.edge_width(F.col("c")))
    assert [r[0] for r in w.collect()] == [2.25, 2.25, 4.0, 4.0, 0.5]
