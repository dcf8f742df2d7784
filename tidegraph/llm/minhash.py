"""b-bit MinHash near-duplicate grouping (operator 12): bands of minima, packed low bits, full sets at last."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table
from tidegraph.llm.components import connected_components

SHINGLE, PERCENT = 2, 80
#: 45 bands of five minima: a pair at the threshold shares none of them once in 60 million times.
BANDS, WIDTH = 45, 5
MINIMA = BANDS * WIDTH
#: Low bits kept of each minimum, sixteen minima to a word of 64 bits.
BITS, WORDS = 4, -(-MINIMA // 16)
#: The estimate from the low bits may be so far below the threshold: over five standard errors.
MARGIN = 0.15
#: Signatures of a crowded bucket in a block, how many of them are compared with another block at a time, and shingles in a
#: block of full sets, for each signature in the other kind.
BLOCK, STRIP, FULL = 1024, 64, 128
#: Shingles that buckets may move: finding gangs takes rounds, which for so small a move take longer.
FEW = 1 << 25
#: Smallest classes of its buckets that a class is first held against.
HUBS = 4
#: Shingles whose minima are taken together.
CHUNK = 1024
_ODD = np.random.default_rng(12).integers(1, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(21).integers(0, 1 << 63, MINIMA, np.uint64)


def shingles(data: bytes | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; fewer words than SHINGLE make one."""
    words = (data or b"").lower().split()  # bytes: A-Z only, and exactly \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    grams = {b" ".join(words)} if len(words) < SHINGLE else set(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)))
    h = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((h(g) for g in grams), np.uint64, len(grams)))


def minima(hashes: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), CHUNK):
        np.minimum(low, (_ODD[:, None] * hashes[None, i : i + CHUNK] + _ADD[:, None]).min(axis=1), out=low)
    return low


def pack(low: np.ndarray) -> np.ndarray:
    """The low BITS of every minimum, packed; places behind the last hold zeros."""
    kept = np.zeros(WORDS * 16, np.uint64)
    kept[:MINIMA] = low & np.uint64((1 << BITS) - 1)
    return np.bitwise_or.reduce(kept.reshape(WORDS, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The estimated similarity of packed signatures along the last axis, corrected for chance agreement."""
    z = x ^ y
    differ = (z | z >> np.uint64(1) | z >> np.uint64(2) | z >> np.uint64(3)) & np.uint64(0x1111111111111111)
    same = 1 - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64) / MINIMA
    chance = 0.5**BITS
    return (same - chance) / (1 - chance)


def _hopeful(x, y, nx, ny):
    """Whether a pair may be linked, by its estimate and by what the sizes allow."""
    return (likeness(x, y) >= PERCENT / 100 - MARGIN) & (100 * np.minimum(nx, ny) >= PERCENT * np.maximum(nx, ny))


def _name(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _rows(batches):
    for b in batches:
        n, names, packed, keys = [], [], [], []
        for text in b.column(1).cast(pa.binary()).to_pylist():
            hashes = shingles(text)
            low = minima(hashes)
            n.append(len(hashes))
            names.append(_name(hashes))
            packed.append(pack(low).tobytes())
            keys += [xxhash.xxh3_64_intdigest(band.tobytes(), i) - (1 << 63) for i, band in enumerate(low.reshape(BANDS, WIDTH))] if len(hashes) else [0] * BANDS
        keys = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(keys, pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(packed, pa.binary()), keys], names=["doc_id", "n", "name", "packed", "keys"])


def _sets(batches):
    for b in batches:
        made = [shingles(t) for t in b.column(0).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(map(_name, made), pa.binary()), pa.array([x.tobytes() for x in made], pa.binary())], names=["name", "hashes"])


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, WORDS)


def _estimated(batches):
    """Reads (a, b, x, y, nx, ny); gives (a, b, near) of the pairs that may be linked."""
    for b in batches:
        x, y, nx, ny = _words(b.column(2)), _words(b.column(3)), b.column(4).to_numpy(), b.column(5).to_numpy()
        near = likeness(x, y)
        keep = pa.array(_hopeful(x, y, nx, ny))
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(near).filter(keep)], names=["a", "b", "near"])


def _strips(left, right):
    """(from, likeness) for STRIP sets of the left block at a time: their likeness to all of the right one, -9 where roots agree or the pair can't be linked."""
    one, two = left.values, right.values
    roots = [np.array(v.field("root").to_pylist(), object) for v in (one, two)]
    x, y = _words(one.field("packed")), _words(two.field("packed"))
    nx, ny = one.field("n").to_numpy(), two.field("n").to_numpy()
    for i in range(0, len(x), STRIP):
        open_ = _hopeful(x[i : i + STRIP, None], y[None], nx[i : i + STRIP, None], ny[None]) & (roots[0][i : i + STRIP, None] != roots[1][None])
        yield i, np.where(open_, likeness(x[i : i + STRIP, None], y[None]), -9)


def _likeliest(batches):
    """Reads two blocks (lists of name, root, n, packed) a row; gives (a, b, near, more): for each set a of the left one the
    likeliest set b of another root in the right one, if any may be linked, and whether there are more."""
    for batch in batches:
        a, b, near, more = [], [], [], []
        for left, right in zip(batch.column(0), batch.column(1), strict=True):
            for i, like in _strips(left, right):
                hopeful = np.flatnonzero(like.max(axis=1) > -9)
                best = like[hopeful].argmax(axis=1)
                a += left.values.field("name").take(pa.array(i + hopeful)).to_pylist()
                b += right.values.field("name").take(pa.array(best)).to_pylist()
                near += like[hopeful, best].tolist()
                more += ((like[hopeful] > -9).sum(axis=1) > 1).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(near, pa.float64()), pa.array(more, pa.bool_())], names=["a", "b", "near", "more"])


def _partners(batches):
    """Reads two blocks and their key a row; gives (key, name, root, n, left, chief): the sets that may be linked with one of
    another root in the other block. Sets that such pairs join, over others too, have one chief, a set of the right block."""
    for batch in batches:
        out = {c: [] for c in ("key", "name", "root", "n", "left", "chief")}
        for left, right, key in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
            chief, met, mine, first = np.arange(len(right.values)), np.zeros(len(right.values), bool), [], []
            for i, like in _strips(left, right):
                open_ = like > -9
                met |= open_.any(axis=0)
                for j in np.flatnonzero(open_.any(axis=1)):
                    at = np.flatnonzero(open_[j])
                    chiefs = chief[at]
                    if (chiefs != chiefs[0]).any():
                        chief[np.isin(chief, chiefs)] = chiefs.min()
                    mine.append(i + j)
                    first.append(at[0])
            theirs = np.flatnonzero(met)
            for side, at, to in ((left, np.array(mine, np.int64), chief[np.array(first, np.int64)]), (right, theirs, chief[theirs])):
                for c in ("name", "root", "n"):
                    out[c] += side.values.field(c).take(pa.array(at)).to_pylist()
                out["chief"] += right.values.field("name").take(pa.array(to)).to_pylist()
                out["left"] += [side is left] * len(at)
            out["key"] += [key] * (len(out["name"]) - len(out["key"]))
        types = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))


def _linked(batches):
    """Reads two blocks (lists of name, root, hashes) a row; gives (a, b): for each set a of the left one, and each other root
    in the right one, one set b of that root that it is linked with, by exact counts of common shingles."""
    for batch in batches:
        a, b = [], []
        for left, right in zip(batch.column(0), batch.column(1), strict=True):
            one, two = left.values, right.values
            names, roots = [v.field("name").to_pylist() for v in (one, two)], [np.array(v.field("root").to_pylist(), object) for v in (one, two)]
            sets = [np.frombuffer(h.as_buffer(), np.uint64) for h in two.field("hashes")]
            sizes = np.array([len(x) for x in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            every = np.concatenate(sets)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            for i, h in enumerate(one.field("hashes")):
                x = np.frombuffer(h.as_buffer(), np.uint64)
                start, end = np.searchsorted(every, x), np.searchsorted(every, x, "right")
                runs = end - start
                at = np.repeat(end - np.cumsum(runs), runs) + np.arange(runs.sum())  # the places of all equal hashes
                both = np.bincount(owner[at], minlength=len(sets))
                good = np.flatnonzero((100 * both >= PERCENT * (len(x) + sizes - both)) & (roots[1] != roots[0][i]))
                first = {roots[1][j]: j for j in good}
                a += [names[0][i]] * len(first)
                b += [names[1][j] for j in first.values()]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _confirmed(batches):
    """Reads (a, b, full set of a, full set of b); gives the pairs that are linked, by exact counts."""
    for b in batches:
        good = []
        for x, y in zip(b.column(2), b.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])


class _FullSets:
    """The full sets of classes, read from the texts again when a pair first asks for them, and written."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes, self.known = docs, classes, None

    def of(self, names: DataFrame) -> DataFrame:
        """(name, hashes) of classes that hold those of names, and maybe more."""
        if self.known is not None:
            names = names.join(self.known.select("name"), "name", "left_anti")
        wanted = materialise(self.classes.join(names, "name").select("name", F.col("low").alias("id")), "wanted")
        if self.known is None or not wanted.isEmpty():
            texts = self.docs.join(wanted.select("id").distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
            sets = texts.mapInArrow(_sets, "name binary, hashes binary").where("name is not null")
            sets = materialise(sets.join(wanted.select("name"), "name", "left_semi").dropDuplicates(["name"]), "sets")
            self.known = sets if self.known is None else self.known.union(sets)
        return self.known

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, b) of names whose full sets are similar enough."""
        sets = self.of(pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct())
        full = pairs.join(sets.select(F.col("name").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("name").alias("b"), F.col("hashes").alias("y")), "b")
        return materialise(full.select("a", "b", "x", "y").mapInArrow(_confirmed, "a binary, b binary"), "links")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(name, root), after links have joined the components of their ends."""
    if links.isEmpty():
        return roots
    end = lambda name: roots.select(F.col("name").alias(name), F.col("root").alias("r" + name))
    edges = links.join(end("a"), "a").join(end("b"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    to = connected_components(edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return materialise(roots.join(to, "root", "left").select("name", F.coalesce("to", "root").alias("root")), "roots")


def _open(members: DataFrame, roots: DataFrame, active: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, name, n, root) of the classes outside the largest component of their bucket, and of all in these buckets; buckets without any of `active` are left out."""
    if active is not None:
        members = members.join(members.join(active, "name", "left_semi").select("key").distinct(), "key", "left_semi")
    now = materialise(members.join(roots, "name"), "now")
    parts = now.groupBy("key", "root").agg(F.count("*").alias("count"))
    mains = parts.groupBy("key").agg(F.max(F.struct("count", "root")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    now = materialise(now.join(mains.select("key", F.col("main.root").alias("main")), "key"), "mixed")
    rest = materialise(now.where("root <> main"), "rest")
    return rest, now.join(rest.select("key").distinct(), "key", "left_semi")


def _blocks(rows: DataFrame, name: str, weight, most: int, *columns: str) -> DataFrame:
    """The rows of each bucket in lists, dealt by a hash so that their weights sum up to about `most`."""
    sums = rows.groupBy("key").agg(F.ceil(F.sum(weight) / most).cast("long").alias("blocks"))
    dealt = rows.join(sums, "key").withColumn("block", F.expr("pmod(xxhash64(name), blocks)"))
    return dealt.groupBy("key", "block").agg(F.collect_list(F.struct("name", "root", *columns)).alias(name)).select("key", name)


def _tests(partners: DataFrame, full: DataFrame, most: int) -> DataFrame:
    """(left, right): blocks of full sets of about `most` shingles, in which all partners that may be linked meet.

    Sets that pairs join are a gang. They often share many buckets, so where buckets would move more than FEW shingles, a
    gang is dealt by itself, each full set once, if that compares no more than its buckets would; a gang that fits a block
    needs no second one. Other gangs, larger than their buckets, are dealt by these.
    """
    rows = partners.select("key", "name", "root", "n", "left").distinct()

    def sides(dealt: DataFrame) -> DataFrame:
        left, right = (_blocks(dealt.where(F.col("left") == own).drop("left").join(full, "name"), name, F.col("n"), most, "hashes") for own, name in ((True, "left"), (False, "right")))
        return left.join(right, "key").select("left", "right")

    if (rows.agg(F.sum("n")).first()[0] or 0) <= FEW:
        return sides(rows)
    gangs = connected_components(partners.select("name", "chief"), "name", "chief").select(F.col("node").alias("name"), F.col("root").alias("gang"))
    dealt = materialise(rows.join(gangs, "name"), "dealt")
    compared = F.col("w") * F.ceil(F.col("w") / most)
    buckets = dealt.select("gang", "key", "name", "n").distinct().groupBy("gang", "key").agg(F.sum("n").alias("w")).groupBy("gang").agg(F.sum(compared).alias("apart"))
    whole = dealt.select("gang", "name", "n").distinct().groupBy("gang").agg(F.sum("n").alias("w"))
    how = whole.join(buckets, "gang").select("gang", F.when(F.col("w") <= most, "one").when(compared <= F.col("apart"), "gang").otherwise("bucket").alias("how"))
    dealt = materialise(dealt.join(how, "gang"), "dealt")
    members = dealt.select("gang", "name", "root", "n", "how").distinct()
    large = members.where("how = 'gang'").select(F.xxhash64("gang").alias("key"), "name", "root", "n", F.explode(F.array(F.lit(True), F.lit(False))).alias("left"))
    one = members.where("how = 'one'").join(full, "name").groupBy("gang").agg(F.collect_list(F.struct("name", "root", "hashes")).alias("left"))
    return sides(large.union(dealt.where("how = 'bucket'").select(large.columns))).union(one.select("left", F.col("left").alias("right")))


def group(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    A row's set: the distinct two-word shingles of its text, A-Z lower-cased, words between
    white space; a single word is a set of its own, a text without words (or null) has an
    empty one, which is linked with nothing. Rows are linked when their sets have a Jaccard
    similarity of PERCENT or more; component_id is the smallest doc_id that links reach, the
    row's own included (null ids take no part in the minimum). Repeated rows give repeated
    rows, an empty table none; other columns are ignored.

    Equal sets are one class. Classes that share a band of minima are candidates. First each
    class is held against HUBS smallest classes of its buckets, and the likeliest pair is
    confirmed on the full sets: most groups are few components then. What remains are buckets
    that hold several components. Block by block, their classes outside the bucket's largest
    component find the likeliest class of another component, which is confirmed. Where one had
    more candidates, those still outside are at last held against the full sets of all others
    that their signatures leave open, block by block again; each gives one link to a component at most. There the full sets
    move once for all the buckets that they share, see _tests. So no bucket hands on all its pairs, and no candidate is
    left untested.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialise(docs.mapInArrow(_rows, "doc_id long, n long, name binary, packed binary, keys array<long>"), "minima")
    classes = rows.where("name is not null").groupBy("name").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("packed").alias("packed"), F.first("keys").alias("keys"))
    classes = materialise(classes, "classes")
    # short ids while every key is on its way; should two classes share one, both come back as candidates
    short = F.xxhash64("name").alias("short")
    keyed = classes.select(short, F.explode("keys").alias("key"))
    buckets = materialise(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"), "buckets")
    members = keyed.join(buckets, "key").join(classes.select(short, "name", "n"), "short").select("key", "name", "n")
    members = materialise(members, "members")
    signed = classes.select("name", "packed")
    sets, roots = _FullSets(docs, classes), classes.select("name", F.col("name").alias("root"))

    hubs = members.join(members.groupBy("key").agg(F.min("name").alias("hub")), "key").where("name <> hub").groupBy("name").agg(F.slice(F.array_sort(F.collect_set("hub")), 1, HUBS).alias("hubs"))
    stars = hubs.select(F.explode("hubs").alias("a"), F.col("name").alias("b"))
    signs = lambda name, n, packed: classes.select(F.col("name").alias(name), F.col("n").alias(n), F.col("packed").alias(packed))
    likely = stars.join(signs("a", "nx", "x"), "a").join(signs("b", "ny", "y"), "b").select("a", "b", "x", "y", "nx", "ny").mapInArrow(_estimated, "a binary, b binary, near double")
    best = likely.groupBy("b").agg(F.max(F.struct("near", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    tested = materialise(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "tested")
    roots = _joined(roots, sets.confirm(tested))

    def met(rest: DataFrame, others: DataFrame) -> DataFrame:
        left, right = (_blocks(d.join(signed, "name"), name, F.lit(1), block, "n", "packed") for d, name in ((rest, "left"), (others, "right")))
        return left.join(right, "key").select("left", "right", "key")

    likely = met(*_open(members, roots)).mapInArrow(_likeliest, "a binary, b binary, near double, more boolean")
    likely = likely.groupBy("a").agg(F.max(F.struct("near", "b")).alias("best"), F.min(F.col("b")).alias("least"), F.max("b").alias("most"), F.max("more").alias("more"))
    likely = materialise(likely, "likely")
    best = likely.select("a", F.col("best.b").alias("b"))
    best = materialise(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti"), "tested")
    roots = _joined(roots, sets.confirm(best))

    rest, others = _open(members, roots, likely.where("more or least <> most").select(F.col("a").alias("name")))
    partners = materialise(met(rest, others).mapInArrow(_partners, "key long, name binary, root binary, n long, left boolean, chief binary").distinct(), "partners")
    links = _tests(partners, sets.of(partners.select("name").distinct()), block * FULL).mapInArrow(_linked, "a binary, b binary")
    roots = _joined(roots, materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"))

    rooted = materialise(classes.select("name", "low").join(roots, "name"), "rooted")
    lows = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    of = materialise(rooted.join(lows, "root").select("name", "component_id"), "of")
    linked = rows.where("name is not null").select("doc_id", "n", "name").join(of, "name").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.where("name is null").select("doc_id", "n", "doc_id"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: n_shingles, component_id, and whether the document stands for its component."""
    return group(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


OP12_SQL = rf"""
with recursive split as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from split),
said as (select doc_id, len(s) as n, unnest(s) as gram from sets),
shared as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as c from said a join said b on a.gram = b.gram and a.doc_id <> b.doc_id
  and 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n) group by all),
links as (select a, b from shared where 100 * c >= {PERCENT} * (na + nb - c)),
reach as (select doc_id, doc_id as other from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a),
lows as (select doc_id, min(other) as component_id from reach group by 1)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, component_id, s.doc_id = component_id as kept from sets s join lows using (doc_id)
"""
