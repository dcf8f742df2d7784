"""Entity resolution: blocked similarity pairs, greedy assignment, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegraph.functions.text import compact, name_similarity, normalize_name
from tidegraph.operators.graph import document, endpoints
from tidegraph.sources.shared import materialise


def qgrams(name: Column, q: int) -> Column:
    """Every run of q characters as "q=run"; transform would take a second lambda parameter for the index."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(name) - (q - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(f"{q}="), F.substring(name, i, F.lit(q))))


def keys(names: DataFrame) -> DataFrame:
    """names (type, name) with all their keys: c, the compact form; words; grams, the runs of 1 to 3 characters."""
    n = F.col("name")
    words = F.array_distinct(F.transform(F.filter(F.split(n, " "), lambda w: w != ""), lambda w: F.concat(F.lit("w="), w)))
    grams = F.array_distinct(F.concat(*(qgrams(n, q) for q in (1, 2, 3))))
    return names.where(n != "").select("type", "name", F.array(F.concat(F.lit("c="), compact(n))).alias("c"), words.alias("words"), grams.alias("grams"))


def probes(keyed: DataFrame, low: float) -> DataFrame:
    """(type, name, key): the few keys of a name under which everything at least `low` alike is found.

    Its compact form; its rarest words, as many as can't all be missing from a name that
    shares enough of them (the rarest one suffices where one name's words are all in the
    other); and the rarest of its longest runs, which a name that holds it has, too. A
    frequent word is thus looked under by those names alone that have nothing rarer.
    """
    every = keyed.select("type", "name", F.explode(F.concat("words", "grams")).alias("key"))
    common = every.groupBy("type", "key").agg(F.count("*").alias("n"))
    size = F.least(F.length("name"), F.lit(3)).cast("string")
    own = every.where(F.col("key").startswith("w=") | F.col("key").startswith(F.concat(size, F.lit("="))))
    rare = own.join(common, ["type", "key"]).groupBy("type", "name").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("all"))
    words = F.filter("all", lambda x: x["key"].startswith("w="))
    some = F.size(words) - F.ceil(low * F.size(words) - 1e-9).cast("int") + 1
    grams = F.filter("all", lambda x: ~x["key"].startswith("w="))
    taken = F.concat(F.slice(words, F.lit(1), F.greatest(some, F.lit(1))), F.slice(grams, 1, 1))
    found = rare.select("type", "name", F.explode(F.transform(taken, lambda x: x["key"])).alias("key"))
    return found.union(keyed.select("type", "name", F.explode("c").alias("key")))


def candidates(left: DataFrame, right: DataFrame, low: float) -> DataFrame:
    """(type, n1, n2): every pair of a left and a right name (type, name) with similarity of `low` and more, and some others.

    Either side's probes meet all keys of the other, except that runs only meet those of a
    name that is not too long to hold it at such a similarity.
    """
    a, b = keys(left), keys(right)
    every = lambda k: k.select("type", "name", F.explode(F.concat("c", "words", "grams")).alias("key"))
    as_ = lambda d, n: d.select("type", "key", F.col("name").alias(n))
    near = F.col("key").rlike("^[cw]=") | (F.least(F.length("n1"), F.length("n2")) >= low * F.greatest(F.length("n1"), F.length("n2")) - 1e-9)
    pairs = as_(probes(a, low), "n1").join(as_(every(b), "n2"), ["type", "key"])
    pairs = pairs.union(as_(probes(b, low), "n2").join(as_(every(a), "n1"), ["type", "key"]).select("type", "key", "n2", "n1").select("type", "key", "n1", "n2"))
    return pairs.where(near).select("type", "n1", "n2").distinct()


def similar_pairs(names: DataFrame, low: float, high: float | None = None, aliases: DataFrame | None = None, decided: DataFrame | None = None) -> DataFrame:
    """(a, b, type, similarity) of the pairs of one type, a before b, with low <= similarity (< high).

    names: id, type, name (as given), ord (place in the order). aliases (id, name): a name is
    also compared with the aliases of the other entity, and the best counts. Pairs in decided
    (a, b, either way round) are left out. Names are compared once per distinct normalized
    name, so equal names never multiply the candidates. low is above 0.
    """
    n = names.select("id", "type", "ord", normalize_name(F.col("name")).alias("name"), F.lit(False).alias("alias"))
    if aliases is not None:
        n = n.union(aliases.select("id", normalize_name(F.col("name")).alias("name")).join(names.select("id", "type", "ord"), "id").select("id", "type", "ord", "name", F.lit(True)))
    distinct = n.select("type", "name").distinct()
    good = candidates(distinct, distinct, low).withColumn("similarity", name_similarity(F.col("n1"), F.col("n2"))).where(F.col("similarity") >= low)
    both = good.union(good.select("type", F.col("n2"), F.col("n1"), "similarity")).distinct()
    side = lambda e, o, m, al: n.select(F.col("id").alias(e), "type", F.col("ord").alias(o), F.col("name").alias(m), F.col("alias").alias(al))
    found = both.join(side("a", "oa", "n1", "x"), ["type", "n1"]).join(side("b", "ob", "n2", "y"), ["type", "n2"]).where("oa < ob and not (x and y)")
    best = found.groupBy("a", "b", "oa", "ob", "type").agg(F.max("similarity").alias("similarity"))
    if high is not None:
        best = best.where(F.col("similarity") < high)
    if decided is not None:
        known = decided.select("a", "b").union(decided.select("b", "a")).distinct()
        best = best.join(known, ["a", "b"], "left_anti")
    return best.select("a", "b", "oa", "ob", "type", F.round("similarity", 6).alias("similarity"))


def assign(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, canonical): the greedy pass in order, without transitive closure.

    An entity is canonical when all its earlier matches are absorbed, and absorbed when an
    earlier match is canonical; it goes to the earliest canonical match.

    What is open is kept as claims (x, a, s): one of x's earlier matches is canonical just if a
    is canonical (s) or is not (not s); x is absorbed if a claim holds, canonical if none does.
    An entity with one claim has the role of a, or the opposite, so chains of them are jumped
    over by doubling, and claims on them move to where the chain ends. A round decides all
    whose claims are decided: rounds count entities with several claims one behind the other,
    not the length of chains.
    """
    e = materialise(pairs.select("a", "b", "oa").distinct(), "matches")
    claims = materialise(e.select(F.col("b").alias("x"), "a", F.lit(True).alias("s")), "claims")
    done = materialise(names.select("id").join(claims.select(F.col("x").alias("id")), "id", "left_anti").select("id", F.lit(True).alias("role")), "roles")
    while True:
        known = claims.join(done.select(F.col("id").alias("a"), "role"), "a", "left")
        both = F.min("s") != F.max("s")  # a is canonical or it isn't: one of the two claims holds
        per = known.groupBy("x", "a").agg(F.coalesce(both | F.bool_or(F.col("role") == F.col("s")), both).alias("holds"), F.first("role").isNull().alias("open"))
        fresh = per.groupBy("x").agg(F.bool_or("holds").alias("holds"), F.bool_or("open").alias("open")).where("holds or not open").select(F.col("x").alias("id"), (~F.col("holds")).alias("role"))
        fresh = materialise(fresh, "fresh")
        if fresh.isEmpty():
            break
        done = materialise(done.union(fresh), "roles")
        left = known.where("role is null").select("x", "a", "s").join(fresh.select(F.col("id").alias("x")), "x", "left_anti").distinct()
        claims = _shortened(materialise(left, "claims"))
    canon = done.where("role").select(F.col("id").alias("a"))
    to = e.join(canon, "a").join(done.where("not role").select(F.col("id").alias("b")), "b").groupBy("b").agg(F.min_by("a", F.struct("oa", "a")).alias("canonical"))
    return names.select("id").join(to.withColumnRenamed("b", "id"), "id", "left").select("id", F.coalesce("canonical", "id").alias("canonical"))


def _shortened(claims: DataFrame) -> DataFrame:
    """The claims, moved along entities with a single one to the end of their chains."""
    many = materialise(claims.groupBy("x").agg(F.count("*").alias("n")), "claimed")
    chain = materialise(claims.join(many.where("n = 1").select("x"), "x", "left_semi"), "chain")
    onward = lambda c: c.select(F.col("x").alias("a"), F.col("a").alias("a2"), F.col("s").alias("s2"))
    moved = lambda d: d.select("x", F.coalesce("a2", "a").alias("a"), F.when(F.col("s2").isNull(), F.col("s")).otherwise(F.col("s") != F.col("s2")).alias("s"))
    while True:
        longer = materialise(chain.join(onward(chain), "a", "left"), "chain")
        if longer.where("a2 is not null").isEmpty():
            break
        chain = moved(longer)
    several = claims.join(many.where("n > 1").select("x"), "x", "left_semi")
    return materialise(moved(several.join(onward(chain), "a", "left")).distinct().union(chain), "claims")


def resolve_names(names: DataFrame, low: float) -> DataFrame:
    """(id, canonical) of names (id, type, name, ord): the greedy pass over all matches of at least `low`.

    Entities of one type and normalized name match each other and the same others, so the
    first of them goes through the pass alone, and the others go where it goes: a row each, and
    no pairs among them. Names without any letter match nothing.
    """
    n = names.select("id", "type", "ord", "name", normalize_name(F.col("name")).alias("plain"))
    n = n.withColumn("plain", F.when(F.col("plain") == "", F.concat(F.lit("\0"), F.col("id").cast("string"))).otherwise(F.col("plain")))
    first = n.groupBy("type", "plain").agg(F.min(F.struct("ord", "id", "name")).alias("f"))
    first = materialise(first.select("type", "plain", "f.*"), "first")
    own = first.select("id", "type", "name", "ord")
    to = assign(own, similar_pairs(own, low))
    of = materialise(first.join(to, "id").select("type", "plain", "canonical"), "of")
    return n.join(of, ["type", "plain"]).select("id", "canonical")


def merge_relations(relations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Ends moved to their canonical entity; of rows that then agree the lowest relation_id stays, `merged` counts them."""
    m = mapping.where("id <> canonical")
    r = relations.join(m.select(F.col("id").alias("source_id"), F.col("canonical").alias("s")), "source_id", "left")
    r = r.join(m.select(F.col("id").alias("target_id"), F.col("canonical").alias("t")), "target_id", "left")
    return merged(r)


def merged(moved: DataFrame, *also: str) -> DataFrame:
    """The same for relations with the canonical ends of those that move beside them, as s and t. also: columns that the
    document fixes; rows that are dealt by them stay where they are."""
    return moved.groupBy(
        F.coalesce("s", "source_id").alias("source_id"), "rel", F.coalesce("t", "target_id").alias("target_id"), "kind", document(moved), *also
    ).agg(F.min("relation_id").alias("relation_id"), F.count("*").alias("merged"))


def merge_entities(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical entities with the earliest and latest days and all names as sorted aliases."""
    e = entities.join(mapping.select(F.col("id").alias("entity_id"), "canonical"), "entity_id")
    return e.groupBy(F.col("canonical").alias("entity_id")).agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.array_join(F.array_sort(F.collect_set("name")), "|").alias("aliases"), F.count("*").alias("members")
    )


def canonical_ids(entities: DataFrame) -> DataFrame:
    """prefix:slug ids, with _2, _3 ... for those that collide (by entity_id)."""
    from tidegraph.functions.text import slugify

    e = entities.withColumn("base", F.concat(F.lower("type"), F.lit(":"), slugify(F.col("name"))))
    n = F.row_number().over(Window.partitionBy("base").orderBy("entity_id"))
    return e.withColumn("n", n).select("entity_id", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("n"))).alias("canonical_id"))


def prefer_connected(pairs: DataFrame, relations: DataFrame) -> DataFrame:
    """Of each pair (a, b) the one with more relations is kept; ties go to a."""
    n = endpoints(relations.select("source_id", "target_id")).groupBy("entity_id").agg(F.count("*").alias("n"))
    p = pairs.join(n.select(F.col("entity_id").alias("a"), F.col("n").alias("na")), "a", "left").join(n.select(F.col("entity_id").alias("b"), F.col("n").alias("nb")), "b", "left").fillna(0, ["na", "nb"])
    return p.select("a", "b", F.when(F.col("nb") > F.col("na"), F.col("b")).otherwise(F.col("a")).alias("canonical"))


def resolve_or_create(batch: DataFrame, entities: DataFrame, aliases: DataFrame, low: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(entities, mapping) after a batch of names: each is found among the entities, or gets a new one.

    batch: name, type, day, ord (place in the batch). entities: entity_id, name, type,
    first_seen, last_seen. aliases: alias, entity_id. mapping: name, type, entity_id, created,
    once per name and type. Null names or types get nothing.

    An alias that equals the name decides; else the most similar entity of the type from `low`
    on, ties to the smaller id. What is left goes through the greedy pass (see resolve_names):
    its first names become entities, the others go to those. New ids are prefix:slug, or with
    the smallest _2, _3, ... that neither an entity nor another new one has, in the order of
    the batch. A matched entity's last_seen rises to the batch's last day for it; first_seen
    stays. A new one has the day of its first name as first, and the last day of all of its
    names as last.
    """
    from tidegraph.functions.text import slugify
    from tidegraph.operators.cleanup import lookup

    b = batch.where("name is not null and type is not null").groupBy("name", "type").agg(F.min(F.struct("ord", "day")).alias("f"), F.max("day").alias("last"))
    b = materialise(b.select("name", "type", F.col("f.ord").alias("ord"), F.col("f.day").alias("first"), "last"), "batch")
    known = entities.select(F.col("entity_id").alias("id"), "type", "name")
    hits = lookup(b.select(F.col("name").alias("query"), "type"), known, aliases.select("alias", F.col("entity_id").alias("id")), low)
    best = hits.groupBy("query", "type").agg(F.min(F.struct(-F.col("similarity"), "id")).alias("m")).select(F.col("query").alias("name"), "type", F.col("m.id").alias("entity_id"))
    matched = materialise(best, "matched")
    rest = materialise(b.join(matched, ["name", "type"], "left_anti"), "rest")
    keyed = rest.select(F.struct("type", "name").alias("key"), "type", "name", "ord")
    to = resolve_names(keyed.select(F.to_json("key").alias("id"), "type", "name", "ord"), low)
    placed = materialise(rest.withColumn("id", F.to_json(F.struct("type", "name"))).join(to, "id"), "placed")
    made = placed.where("id = canonical").withColumn("base", F.concat(F.lower("type"), F.lit(":"), slugify(F.col("name"))))
    made = made.withColumn("n", F.row_number().over(Window.partitionBy("base").orderBy("ord", "id")))
    # the n-th number of a base that is free: numbers in use below it push it on
    split = F.regexp_extract("entity_id", r"^(.*?)(?:_([0-9]+))?$", 2)
    used = entities.select(F.explode(F.array(F.struct(F.col("entity_id").alias("base"), F.lit(1).alias("k")), F.struct(F.regexp_extract("entity_id", r"^(.*)_([0-9]{1,9})$", 1).alias("base"), F.try_to_number(split, F.lit("999999999")).cast("int").alias("k")))).alias("u"))
    taken = used.select("u.*").where("k is not null and base <> ''").join(made.select("base").distinct(), "base", "left_semi").groupBy("base").agg(F.collect_set("k").alias("taken"))
    made = made.join(taken, "base", "left").withColumn("taken", F.coalesce("taken", F.array().cast("array<int>")))
    number = F.element_at(F.array_except(F.sequence(F.lit(1), F.col("n") + F.size("taken")), "taken"), F.col("n"))
    made = materialise(made.withColumn("number", number).select(F.col("id").alias("canonical"), F.when(F.col("number") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", "number")).alias("entity_id"), F.col("name").alias("new_name"), F.col("type").alias("new_type"), F.col("first").alias("first_seen")), "made")
    mapping = matched.withColumn("created", F.lit(False)).union(placed.join(made, "canonical").select("name", "type", "entity_id", F.lit(True)))
    mapping = materialise(mapping, "mapping")
    days = b.join(mapping.select("name", "type", "entity_id"), ["name", "type"]).groupBy("entity_id").agg(F.max("last").alias("last"))
    old = entities.join(days, "entity_id", "left").select("entity_id", "name", "type", "first_seen", F.greatest("last_seen", "last").alias("last_seen"))
    new = made.join(days, "entity_id").select("entity_id", "new_name", "new_type", "first_seen", "last")
    return old.union(new), mapping
