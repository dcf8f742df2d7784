"""Graph views, edge aggregation, neighbourhoods, region tags, bridges and inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegraph.functions.scoring import bridge_score
from tidegraph.operators.trend import places
from tidegraph.sources.shared import materialise

RANK = {"asserted": 0, "inferred": 1, "hypothesis": 2}


def kind_rank():
    return F.coalesce(F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))[F.col("kind")], F.lit(9))


def aggregate_edges(relations: DataFrame, text=F.col) -> DataFrame:
    """One edge per (source, rel, target): best confidence, strongest kind, number of rows, representative.

    The representative is the row with the strongest kind, then the highest confidence, then
    the lowest relation_id; its doc_id shows only when the edge has a single row. text: makes
    texts of the ids of ends and documents, if those are codes.
    """
    first = F.struct(kind_rank().alias("rank"), (-F.col("confidence")).alias("less"), "relation_id", "kind", "doc_id")
    return (
        relations.groupBy("source_id", "rel", "target_id")
        .agg(F.max("confidence").alias("confidence"), F.min(first).alias("m"), F.count("*").alias("doc_count"), F.count_distinct("snippet").alias("snippets"))
        .select(
            F.concat_ws(":", F.lit("e"), text("source_id"), "rel", text("target_id")).alias("edge_id"), text("source_id").alias("source_id"), "rel", text("target_id").alias("target_id"),
            "m.kind", "confidence", "m.relation_id", "doc_count", F.when(F.col("doc_count") == 1, text("m.doc_id")).alias("doc_id"), "snippets",
        )
    )


def edge_evidence(relations: DataFrame) -> DataFrame:
    """Evidence of every edge, one row per snippet (the first by relation_id)."""
    w = Window.partitionBy("source_id", "rel", "target_id", "snippet").orderBy("relation_id")
    return relations.withColumn("n", F.row_number().over(w)).where("n = 1").select("source_id", "rel", "target_id", "snippet", "relation_id", "doc_id")


def document(relations: DataFrame) -> Column:
    """The document of a relation, a null counting as empty; a code stays null."""
    return (F.coalesce("doc_id", F.lit("")) if dict(relations.dtypes)["doc_id"] == "string" else F.col("doc_id")).alias("doc")


def dedup(relations: DataFrame, *also: str) -> DataFrame:
    """Lowest relation_id per (source, rel, target, kind, doc), a null doc counting as empty; `dropped` tells how many went.

    also: columns that the document fixes. Rows that are dealt by them stay where they are.
    """
    key = ["source_id", "rel", "target_id", "kind", document(relations), *also]
    return relations.groupBy(*key).agg(F.min("relation_id").alias("relation_id"), (F.count("*") - 1).alias("dropped"))


def endpoints(relations: DataFrame) -> DataFrame:
    """Both ends of every edge, in one scan."""
    return relations.select("*", F.explode(F.array("source_id", "target_id")).alias("entity_id"))


def strip_orphans(edges: DataFrame, nodes: DataFrame, parts: int | None = None) -> DataFrame:
    """Edges with both ends among the nodes. parts: into how many parts they are dealt by either end, where nodes are many."""
    ids = nodes.select("entity_id").distinct()
    for end in ("source_id", "target_id"):
        edges = (edges.repartition(parts, end) if parts else edges).join(ids.withColumnRenamed("entity_id", end), end, "left_semi")
    return edges


def view(relations: DataFrame, documents: DataFrame | None = None, start: str | None = None, end: str | None = None, include=None, exclude=None, kinds=None) -> DataFrame:
    """Relations of a view: by relation and kind, and by publication day of their document (no document fails)."""
    r = relations
    if include is not None:
        r = r.where(F.col("rel").isin(*include))
    if exclude is not None:
        r = r.where(~F.col("rel").isin(*exclude))
    if kinds is not None:
        r = r.where(F.col("kind").isin(*kinds))
    if documents is not None:
        d = documents
        if start is not None:
            d = d.where(F.col("published_at") >= start)
        if end is not None:
            d = d.where(F.col("published_at") <= end)
        r = r.join(d.select("doc_id"), "doc_id", "left_semi")
    return r


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("source_id").alias("a"), F.col("target_id").alias("b")), F.struct(F.col("target_id").alias("a"), F.col("source_id").alias("b")))).alias("e")).select("e.a", "e.b")


def hops(edges: DataFrame, seeds: DataFrame, most: int) -> DataFrame:
    """(entity_id, tag, hops) for all within `most` undirected steps of a seed (entity_id, tag), with the fewest steps.

    Each round goes on from what the last one found first, and is written to the shared folder;
    it reads the edges, of which only those at that front are looked at further.
    """
    e = both_ways(edges)
    fresh = materialise(seeds.select("entity_id", "tag").distinct().withColumn("hops", F.lit(0)), "hops")
    reached = fresh
    for k in range(1, most + 1):
        further = fresh.join(e.withColumnRenamed("a", "entity_id"), "entity_id").select(F.col("b").alias("entity_id"), "tag").distinct()
        fresh = further.join(reached.select("entity_id", "tag"), ["entity_id", "tag"], "left_anti").withColumn("hops", F.lit(k))
        fresh = materialise(fresh, "hops")
        reached = reached.union(fresh)
    return reached


def spread(edges: DataFrame, seeds: DataFrame, most: int = 2) -> DataFrame:
    """(entity_id, tag) for all within `most` undirected steps of a seed (entity_id, tag)."""
    return hops(edges, seeds, most).select("entity_id", "tag")


def region_tags(edges: DataFrame, seeds: DataFrame, most: int = 2) -> DataFrame:
    return spread(edges, seeds, most).groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("regions"))


def neighbours(relations: DataFrame, base: str = "MENTIONS") -> DataFrame:
    """Distinct out- and in-neighbours of every entity beside the base relation, and the bridge score."""
    r = relations.where(F.col("rel") != base)
    out = r.groupBy(F.col("source_id").alias("entity_id")).agg(F.count_distinct("target_id").alias("out_n"))
    into = r.groupBy(F.col("target_id").alias("entity_id")).agg(F.count_distinct("source_id").alias("in_n"))
    j = out.join(into, "entity_id", "full").fillna(0, ["out_n", "in_n"])
    return j.withColumn("bridge_score", F.round(bridge_score(F.col("out_n"), F.col("in_n")), 6))


def bridges(relations: DataFrame, trending: DataFrame) -> DataFrame:
    """Outside nodes that join an isolated trending node to at least one other trending node."""
    t = trending.select("entity_id").distinct()
    src = t.select(F.col("entity_id").alias("source_id"), F.lit(True).alias("s_in"))
    tgt = t.select(F.col("entity_id").alias("target_id"), F.lit(True).alias("t_in"))
    # edges between others drop out before equal ones are put together
    r = relations.select("source_id", "target_id").join(src, "source_id", "left").join(tgt, "target_id", "left").fillna(False, ["s_in", "t_in"]).where("s_in or t_in").distinct()
    inside = endpoints(r.where("s_in and t_in").select("source_id", "target_id")).select("entity_id").distinct()
    isolated = t.join(inside, "entity_id", "left_anti").withColumn("lone", F.lit(1))
    touch = r.where("s_in <> t_in").select(
        F.when(F.col("s_in"), F.col("target_id")).otherwise(F.col("source_id")).alias("bridge"),
        F.when(F.col("s_in"), F.col("source_id")).otherwise(F.col("target_id")).alias("entity_id"),
    )
    return (
        touch.distinct().join(isolated, "entity_id", "left").groupBy("bridge").agg(F.count("*").alias("touched"), F.count("lone").alias("isolated"))
        .where("isolated > 0 and touched >= 2")
    )


def trending_view(relations: DataFrame, trending: DataFrame, text=F.col) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the trending view.

    Nodes are the trending entities (entity_id, trend_score) and the bridges that reconnect
    isolated ones, which have score 0. Edges join two trending entities, or a bridge and a
    trending one, and are aggregated over documents; text as in aggregate_edges.
    """
    t = materialise(trending.select("entity_id", "trend_score"), "trending")
    b = materialise(bridges(relations, t).select(F.col("bridge").alias("entity_id")), "bridges")
    nodes = t.withColumn("is_bridge", F.lit(False)).union(b.select("entity_id", F.lit(0.0), F.lit(True)))
    ends = nodes.select("entity_id", "is_bridge")
    side = lambda end, name: ends.select(F.col("entity_id").alias(end), F.col("is_bridge").alias(name))
    inside = relations.join(side("source_id", "sb"), "source_id").join(side("target_id", "tb"), "target_id").where("not (sb and tb)")
    return nodes, aggregate_edges(inside.drop("sb", "tb"), text)


#: A rule: its antecedents, one or two of (relation, type of source, type of target), the new relation and its discount.
#: Of two, the first's target is the second's source; the new edge joins the ends of the chain.
Rule = tuple[list[tuple[str, str, str]], str, float]


def infer(relations: DataFrame, entities: DataFrame, rules: list[Rule], cap: int = 500) -> DataFrame:
    """New edges of all rules: source_id, rel, target_id, rule, r0, r1, confidence.

    Ends must have the types that a rule names. Loops and edges that exist, of any kind, are
    left out; of several ways to one edge the first by (rule, relation ids) counts, over all
    rules. confidence is the product of the antecedents' times the discount, 1 at most. The
    first `cap` by (rule, relation ids) stay. Rules are a table: all are matched in one pass.

    Of equal steps the one with the lowest relation_id counts. Of the edges that lead on from
    an entity a chain takes the first cap + 1 and as many more as its start has known edges:
    the rest can't be among the first `cap`, as one loop and the known edges are all that may
    drop out. They come in blocks, which split an entity of very many edges over the tasks.
    """
    spark = relations.sparkSession
    rows = [(i, *a[0], *(a[1] if len(a) > 1 else (None, None, None)), new, float(discount)) for i, (a, new, discount) in enumerate(rules)]
    of = F.broadcast(spark.createDataFrame(rows, "rule int, rel0 string, s0 string, t0 string, rel1 string, s1 string, t1 string, new string, discount double"))  # a row per rule
    steps = [step for a, _, _ in rules for step in a]
    # names of rules are known here, so filters on them reach the scans, and whole branches of a union drop out
    kinds = entities.where(F.col("type").isin(sorted({x for _, s, t in steps for x in (s, t)}))).select("entity_id", "type")
    kind = lambda end, name: kinds.select(F.col("entity_id").alias(end), F.col("type").alias(name))
    used = relations.where(F.col("rel").isin(sorted({r for r, _, _ in steps}))).select("relation_id", "source_id", "rel", "target_id", "confidence")
    typed = materialise(used.join(kind("source_id", "s"), "source_id").join(kind("target_id", "t"), "target_id"), "typed")
    first = typed.join(of, (F.col("rel") == F.col("rel0")) & (F.col("s") == F.col("s0")) & (F.col("t") == F.col("t0"))).select(
        "rule", "rel1", "t1", "new", "discount", F.col("source_id").alias("a"), F.col("target_id").alias("b"), F.col("relation_id").alias("r0"), F.col("confidence").alias("c0")
    )
    first = materialise(first.groupBy("rule", "rel1", "t1", "new", "discount", "a", "b").agg(F.min(F.struct("r0", "c0")).alias("m")).select("rule", "rel1", "t1", "new", "discount", "a", "b", "m.*"), "first")
    have = relations.where(F.col("rel").isin(sorted({new for _, new, _ in rules}))).select(F.col("source_id").alias("a"), F.col("rel").alias("new"), F.col("target_id").alias("c")).distinct()
    alone = first.where("rel1 is null").select("rule", "new", "discount", "a", F.col("b").alias("c"), "r0", F.lit(None).cast("long").alias("r1"), "c0", F.lit(1.0).alias("c1"))
    # the second antecedent's source is the first one's target, so its type needs no second look
    onto = [a[1] for a, _, _ in rules if len(a) > 1]
    second = typed.where(F.col("rel").isin(sorted({r for r, _, _ in onto})) & F.col("t").isin(sorted({t for _, _, t in onto})))
    second = second.groupBy(F.struct(F.col("rel").alias("rel1"), F.col("t").alias("t1"), F.col("source_id").alias("b")).alias("hub"), F.col("target_id").alias("c")).agg(F.min(F.struct(F.col("relation_id").alias("r1"), F.col("confidence").alias("c1"))).alias("m"))
    # places by ranges: the edges of a hub are not put in order by one task
    second = places(second.select("hub", "c", "m.*"), "hub", "r1").select("hub.*", "c", "r1", "c1", F.floor(F.col("place") / (cap + 1)).alias("block"))
    known = have.groupBy("a", "new").agg(F.count("*").alias("known"))
    blocks = F.sequence(F.lit(0).cast("long"), F.ceil(F.coalesce("known", F.lit(0)) / (cap + 1)))
    onward = first.where("rel1 is not null").join(known, ["a", "new"], "left").withColumn("block", F.explode(blocks))
    chains = onward.join(second, ["rel1", "t1", "b", "block"]).select("rule", "new", "discount", "a", "c", "r0", "r1", "c0", "c1")
    found = alone.union(chains).where("a <> c").join(have, ["a", "new", "c"], "left_anti")
    once = found.groupBy("a", "new", "c").agg(F.min(F.struct("rule", "r0", "r1", "c0", "c1", "discount")).alias("m"))
    return (
        once.orderBy("m.rule", "m.r0", "m.r1").limit(cap)
        .select(
            F.col("a").alias("source_id"), F.col("new").alias("rel"), F.col("c").alias("target_id"), "m.rule", "m.r0", "m.r1",
            F.round(F.least(F.lit(1.0), F.col("m.c0") * F.col("m.c1") * F.col("m.discount")), 3).alias("confidence"),
        )
    )


def clusters(mentions: DataFrame, size: int = 5, least: int = 1, most: int = 10) -> DataFrame:
    """(cluster, place, doc_id, entities): greedy groups of documents that share entities.

    mentions: doc_id, entity_id; rows with a null count for nothing, repeats once. Documents
    are taken by number of entities, then doc_id. Each that is still free starts a group; one
    pass over the free documents in that order adds those that share at least `least` entities
    with the group's so far, up to `size`. Groups of one are dropped and leave their document
    free; `most` groups are made. entities counts the different entities of a group.

    Groups grow side by side: a round is one query that gives every open group its next
    document, and the driver holds no more than the starts in hand and their groups. Earlier
    groups go first, so when one takes (or gives back) a document that a later one has, the later
    one goes back to that step, and those after it to their starts. Rounds depend on `size` and
    on how often that happens, not on the number of groups. Starts are taken in portions, which
    grow up to 256 while they find no partners. No rows in, no rows out.
    """
    m = materialise(mentions.select(F.col("doc_id").cast("string").alias("doc_id"), "entity_id").dropna().distinct(), "mentions")
    n = m.groupBy("doc_id").agg((-F.count("*")).alias("n"))
    links = m.join(m.groupBy("entity_id").count().where("count > 1"), "entity_id", "left_semi")
    links = materialise(links.join(n, "doc_id").select("entity_id", "doc_id", "n"), "links")
    groups: list[_Group] = []
    seen, portion, more = None, most, True
    while True:
        if more and sum(g.open or len(g.members) > 1 for g in groups) < most:
            front = _front(links, seen, portion)
            more, seen = len(front) == portion, front[-1] if front else seen
            groups += [_Group(doc) for doc in front]
            portion = min(portion * 4, 256)
        told = [g for g in groups if g.open or len(g.members) > 1][:most]
        if not any(g.open for g in told) and (len(told) == most or not more):
            break
        steps = _next_members(links, groups, least)
        for i, g in enumerate(groups):
            if g.open and i in steps:
                g.members.append(steps[i])
            g.open = g.open and i in steps and len(g.members) < size
        groups = _settled(groups)
    rows = [(c, i, doc[1]) for c, g in enumerate(told) for i, doc in enumerate(g.members)]
    chosen = mentions.sparkSession.createDataFrame(rows, "cluster int, place int, doc_id string")
    size_of = m.join(F.broadcast(chosen), "doc_id").groupBy("cluster").agg(F.count_distinct("entity_id").alias("entities"))  # size x most rows
    return chosen.join(size_of, "cluster")


class _Group:
    """A group in the making: members as (-entities, doc_id), the start first. alone: it has been found to have no partner."""

    def __init__(self, start: tuple):
        self.members, self.open, self.alone = [start], True, False

    def back_to(self, step: int) -> None:
        self.members, self.open, self.alone = self.members[:step], True, False


def _front(links: DataFrame, seen: tuple | None, portion: int) -> list[tuple]:
    """The next documents in order, behind `seen`."""
    after = F.struct("n", "doc_id") > F.struct(F.lit(seen[0]).cast("long").alias("n"), F.lit(seen[1]).alias("doc_id")) if seen else F.lit(True)
    return [tuple(r) for r in links.where(after).select("n", "doc_id").distinct().orderBy("n", "doc_id").limit(portion).collect()]


def _next_members(links: DataFrame, groups: list[_Group], least: int) -> dict[int, tuple]:
    """By the number of each open group the first document behind its last one that shares enough entities and belongs to no group before it, or itself."""
    spark = links.sparkSession
    rows = [(i, doc[1], *(g.members[-1] if len(g.members) > 1 else (None, None))) for i, g in enumerate(groups) if g.open for doc in g.members]
    if not rows:
        return {}
    inside = F.broadcast(spark.createDataFrame(rows, "g int, doc_id string, last_n long, last_id string"))  # size x 256 rows at most, like the next
    owner = F.broadcast(spark.createDataFrame([(doc[1], i) for i, g in enumerate(groups) if not g.alone for doc in g.members] or [("", -1)], "doc_id string, owner int"))
    own = links.select("doc_id", "entity_id").join(inside, "doc_id").select("g", "last_n", "last_id", "entity_id").distinct()
    met = links.join(own, "entity_id").where("last_id is null or n > last_n or (n = last_n and doc_id > last_id)")
    shared = met.groupBy("g", "n", "doc_id").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    free = shared.join(owner, "doc_id", "left").where("owner is null or owner > g")
    return {r["g"]: (r["m"]["n"], r["m"]["doc_id"]) for r in free.groupBy("g").agg(F.min(F.struct("n", "doc_id")).alias("m")).collect()}


def _settled(groups: list[_Group]) -> list[_Group]:
    """The groups, without those whose start an earlier one has, and without steps that earlier ones have made impossible."""
    taken: set[tuple] = set()
    out: list[_Group] = []
    for g in groups:
        if g.members[0] in taken:  # what it held is free again
            changed = len(g.members) > 1
        else:
            lost = next((i for i, doc in enumerate(g.members) if doc in taken), None)
            changed = lost is not None
            if changed:
                g.back_to(lost)
            if not g.open and len(g.members) == 1 and not g.alone:
                g.alone = changed = True
            if not g.alone:
                taken.update(g.members)
            out.append(g)
        if changed:
            for later in groups[groups.index(g) + 1 :]:
                later.back_to(1)
    return out


def document_node(doc_id: Column, title: Column, url: Column, source: Column, published_at: Column) -> Column:
    """A document as JSON node; its id is its label where it has no title, and empty fields are left out."""
    some = lambda c: F.when(c.cast("string") != "", c.cast("string"))
    return F.to_json(
        F.struct(
            F.concat(F.lit("doc:"), doc_id).alias("id"), F.coalesce(some(title), doc_id.cast("string")).alias("label"), F.lit("Document").alias("type"),
            some(url).alias("url"), some(source).alias("source"), some(published_at).alias("publishedAt"),
        )
    )


def edge_object() -> Column:
    """A relation as JSON edge; null fields are left out."""
    name = F.concat(F.lit("e:"), "relation_id", F.lit(":"), "source_id", F.lit("->"), "target_id")
    return F.to_json(F.struct(name.alias("id"), F.col("source_id").alias("source"), F.col("target_id").alias("target"), "rel", "kind", "confidence", F.col("doc_id").alias("docId")))


# Sizes and steps of how nodes and edges are drawn.
BASE_SIZE, LEAST_SIZE, MOST_SIZE = 30, 20, 80
BOOST = ((7, 1.5), (14, 1.3), (30, 1.15))
OPACITY = ((7, 1.0), (14, 0.9), (30, 0.8), (60, 0.7), (90, 0.6))
THINNEST, THICKEST = 0.5, 4.0


def by_age(day: Column, as_of: str, steps, rest: float) -> Column:
    """The value of the first step (days, value) that an age reaches; `rest` for older and for unknown days."""
    age = F.datediff(F.lit(as_of).cast("date"), day.try_cast("date"))
    return F.coalesce(*(F.when(age <= days, F.lit(value)) for days, value in steps), F.lit(rest))


def node_style(nodes: DataFrame, as_of: str) -> DataFrame:
    """nodes (degree, velocity, first_seen, last_seen and more) with size, opacity and labelled (when zoomed out).

    A null velocity counts as 0, a null or zero degree as 1; an unknown day as long ago.
    """
    v, d = F.coalesce("velocity", F.lit(0.0)), F.greatest(F.coalesce("degree", F.lit(1)), F.lit(1))
    size = BASE_SIZE * (1 + F.least(v, F.lit(3.0)) * 0.5) * by_age(F.col("first_seen"), as_of, BOOST, 1.0) * (1 + F.log2(d) * 0.5)
    return nodes.select(
        "*", F.least(F.greatest(size, F.lit(float(LEAST_SIZE))), F.lit(float(MOST_SIZE))).alias("size"), by_age(F.col("last_seen"), as_of, OPACITY, 0.5).alias("opacity"),
        ((d > 5) | (v > 0.7)).alias("labelled"),
    )


def edge_width(confidence: Column) -> Column:
    """Width by confidence in 0 to 1; null and 0 count as one half."""
    c = F.when(F.coalesce(confidence, F.lit(0.0)) == 0, F.lit(0.5)).otherwise(confidence)
    return THINNEST + F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) * (THICKEST - THINNEST)


def new_edges(candidates: DataFrame, relations: DataFrame) -> DataFrame:
    """Candidates (source_id, rel, target_id) that no relation has, of any kind, each once."""
    key = ["source_id", "rel", "target_id"]
    return candidates.select(*key).distinct().join(relations.select(*key), key, "left_anti")


def islands(entities: DataFrame, relations: DataFrame, base: str = "MENTIONS") -> DataFrame:
    """Entities without any edge beside the base relation."""
    ends = endpoints(relations.where(F.col("rel") != base).select("source_id", "target_id")).select("entity_id").distinct()
    return entities.join(ends, "entity_id", "left_anti")


def stats(edges: DataFrame) -> DataFrame:
    """Nodes, edges and average degree of a graph."""
    n = endpoints(edges.select("source_id", "target_id")).agg(F.count_distinct("entity_id").alias("nodes"))
    m = edges.agg(F.count("*").alias("edges"))
    return n.crossJoin(m).withColumn("avg_degree", 2 * F.col("edges") / F.greatest("nodes", F.lit(1)))  # one row each
