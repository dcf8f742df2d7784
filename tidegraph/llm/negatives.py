"""Hard-negative mining (operator 11): exact searches over one-dimensional distance keys.

Largest inner products become smallest distances: with M the largest norm, every row x gets one
more component sqrt(M^2 - |x|^2) and every anchor q a zero, so that the squared distance is
|q|^2 + M^2 - 2 q.x. Rows are stored in blocks, sorted by (pivot, distance to the pivot). A
distance d to an anchor needs a key within d of the anchor's own distance to the pivot, so
that a search reads the cells of keys around it, farther ones round by round, until no cell
left can hold a row that is near enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

SCALE, ANCHOR_EVERY, RELABEL_EVERY, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80
#: Components of a larger size count as this.
LARGEST = 1 << 27
#: Pivots at most, rows for each, and rows (by the smallest hash) that they are fitted on.
PIVOTS, ROWS_A_PIVOT, SAMPLE = 64, 4096, 8192
#: Cells of keys in the largest norm; a search widens by four from one cell on.
CELLS, WIDEN = 16, 4
#: Rows of a block, anchors of a chunk, and slots that a cell's blocks are dealt to.
BLOCK, CHUNK, SLOTS = 1024, 256, 8
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max

ROW = "vec_id long, label long, vec binary"
BLOCKS = "pivot int, cell int, slot int, low double, high double, ids binary, labels binary, copies binary, rows binary"
CHUNKS = "chunk long, ids binary, labels binary, copies binary, rows binary, owner binary, most binary, least binary"


def _vectors(batches):
    """Rows with finite vectors, scaled and floored to integers of 32 bits."""
    for b in batches:
        keep, packed = [], []
        for v in b.column(2).to_pylist():
            x = np.array([], float) if v is None or None in v else np.array(v, float)
            keep.append(v is not None and None not in v and bool(np.isfinite(x).all()))
            packed.append(np.clip(np.floor(SCALE * x), -LARGEST, LARGEST).astype(np.int32).tobytes() if keep[-1] else None)
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(packed, pa.binary()).filter(keep)], names=["vec_id", "label", "vec"])


def _matrix(vectors: list[bytes], size: int) -> np.ndarray:
    """Rows of int32; short vectors end in zeros."""
    return np.frombuffer(b"".join(v.ljust(4 * size, b"\0") for v in vectors), np.int32).reshape(len(vectors), size)


def _augmented(rows: np.ndarray, norm2: float) -> np.ndarray:
    x = rows.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(0, norm2 - (x * x).sum(axis=1)))])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * x @ pivots.T))


def fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of a few rounds of k-means over a sample, from its first rows."""
    centres = sample[:count].copy()
    for _ in range(8):
        near = _distances(sample, centres).argmin(axis=1)
        for i in range(len(centres)):
            if (near == i).any():
                centres[i] = sample[near == i].mean(axis=0)
    return centres


def _keys(pivots, norm2, size):
    """(pivot, key) of each row: its nearest pivot, and the distance to it."""

    def run(batches):
        for b in batches:
            d = _distances(_augmented(_matrix(b.column(2).to_pylist(), size), norm2), pivots) if b.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d.argmin(axis=1), pa.int32()), pa.array(d.min(axis=1))], names=[*b.schema.names, "pivot", "key"])

    return run


def _bytes(values, kind=np.int64) -> bytes:
    return np.asarray(values, kind).tobytes()


def _blocks(cell: float, size: int, block: int):
    """Reads sorted rows; gives blocks of neighbours in one cell of one pivot."""

    def packed(rows, number):
        keys = [r["key"] for r in rows]
        return {
            "pivot": rows[0]["pivot"], "cell": rows[0]["cell"], "slot": number % SLOTS, "low": keys[0], "high": keys[-1],
            "ids": _bytes([r["vec_id"] for r in rows]), "labels": _bytes([r["label"] for r in rows]), "copies": _bytes([r["copies"] for r in rows]), "rows": _matrix([r["vec"] for r in rows], size).tobytes(),
        }

    def run(batches):
        held, number = [], 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                r["cell"] = int(r["key"] // cell)
                if held and (len(held) >= block or (r["pivot"], r["cell"]) != (held[0]["pivot"], held[0]["cell"])):
                    out.append(packed(held, number))
                    held, number = [], number + 1
                held.append(r)
            yield from _batch(out, BLOCKS)
        yield from _batch([packed(held, number)] if held else [], BLOCKS)

    return run


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[dict], schema: str):
    fields = [x.split() for x in schema.split(", ")]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], _KINDS[k]) for n, k in fields], names=[n for n, _ in fields])


def _chunks(size: int):
    """Reads anchors; gives chunks of them, each anchor with one search over all scores."""

    def run(batches):
        start, number = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            rows = b.to_pylist()
            for i in range(0, len(rows), CHUNK):
                some = rows[i : i + CHUNK]
                n = len(some)
                yield from _batch([{
                    "chunk": start + number, "ids": _bytes([r["vec_id"] for r in some]), "labels": _bytes([r["label"] for r in some]), "copies": _bytes([r["copies"] for r in some]),
                    "rows": _matrix([r["vec"] for r in some], size).tobytes(), "owner": _bytes(range(n), np.int32), "most": _bytes([_HIGH] * n), "least": _bytes([_LOW] * n),
                }], CHUNKS)
                number += 1

    return run


def least_score(positive: int) -> int:
    """The smallest score that is LEAST_PERCENT of a positive's at least."""
    return -((-LEAST_PERCENT * positive) // 100)


def _windows(batches):
    """Reads chunks with their positives; gives the chunks with one search for each positive."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            found = sorted((f["search"], -f["score"], f["id"]) for f in r["found"])
            out.append(r | {"owner": _bytes([f[0] for f in found], np.int32), "most": _bytes([-f[1] for f in found]), "least": _bytes([min(least_score(-f[1]), _HIGH) for f in found])})
        yield from _batch(out, CHUNKS)


def _named(batches):
    """Reads chunks with their positives; names the searches that _windows gives them."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            ids, copies = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["copies"], np.int64)
            found = sorted((f["search"], -f["score"], f["id"]) for f in r["found"])
            out += [{"chunk": r["chunk"], "search": i, "anchor_id": ids[q], "copies": copies[q], "positive_id": p, "positive_score": -s} for i, (q, s, p) in enumerate(found)]
        yield from _batch(out, NAMED)


NAMED = "chunk long, search int, anchor_id long, copies long, positive_id long, positive_score long"
PLAN = "chunk long, pivot int, cell int, now boolean, searches binary, floors binary"


def _plan(pivots, norm2, size, cells, top, covered, reach):
    """Reads chunks with what their searches have found; gives the cells that each search must still read.

    cells: (pivot, cell, low, high) of the keys in the index. A cell is read now if its keys
    come nearer than reach to the anchor's; those nearer than covered were read before.
    """
    pivot, cell, low, high = (np.array(c) for c in zip(*cells, strict=True))

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                owner, most, least = np.frombuffer(r["owner"], np.int32), np.frombuffer(r["most"], np.int64), np.frombuffer(r["least"], np.int64).copy()
                if not len(owner):
                    continue
                seen = {}
                for f in r["found"] or []:
                    seen.setdefault(f["search"], []).append(f["score"])
                for i, scores in seen.items():
                    if len(scores) >= top:
                        least[i] = max(least[i], min(scores))
                q = np.frombuffer(r["rows"], np.int32).reshape(len(r["ids"]) // 8, size).astype(float)
                lengths = (q * q).sum(axis=1)
                d = _distances(np.column_stack([q, np.zeros(len(q))]), pivots)[owner][:, pivot]
                gap = np.maximum(0, np.maximum(low[None] - d, d - high[None]))
                slack = 1e-9 * (lengths[owner] + norm2) + 1e-3
                whole = lengths[owner] + norm2
                near = gap * gap <= (whole - 2.0 * least + slack)[:, None]  # some row may score `least`
                far = (d + high[None]) ** 2 >= (whole - 2.0 * most - slack)[:, None]  # some row may score no more than `most`
                left = near & far & (gap >= covered) & (least <= most)[:, None]
                for c in np.flatnonzero(left.any(axis=0)):
                    now = left[:, c] & (gap[:, c] < reach)
                    some = np.flatnonzero(now if now.any() else left[:, c])
                    out.append({"chunk": r["chunk"], "pivot": pivot[c], "cell": cell[c], "now": bool(now.any()), "searches": _bytes(some, np.int32), "floors": _bytes(least[some])})
            yield from _batch(out, PLAN)

    return run


FOUND = "chunk long, search int, score long, id long, copies long"


def _products(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as int64; those beyond are held at its ends."""
    x, y = q.astype(float), rows.astype(float)
    if len(x) and len(y) and (x * x).sum(axis=1).max() * (y * y).sum(axis=1).max() >= 2.0**104:
        return np.clip(q.astype(object) @ rows.astype(object).T, _LOW, _HIGH).astype(np.int64)
    return (x @ y.T).astype(np.int64)  # every partial sum is below 2^52


def _scan(size: int, same: bool, top: int):
    """Reads pairs of a chunk and a block; gives what each search finds there: its best rows of the label wanted."""

    def run(batches):
        for b in batches:
            columns = [[], [], [], [], []]
            for r in b.to_pylist():
                ids, labels, copies = (np.frombuffer(r[n], np.int64) for n in ("block_ids", "block_labels", "block_copies"))
                rows = np.frombuffer(r["block_rows"], np.int32).reshape(len(ids), size)
                own_ids, own_labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                q = np.frombuffer(r["rows"], np.int32).reshape(len(own_ids), size)
                searches, floors = np.frombuffer(r["searches"], np.int32), np.frombuffer(r["floors"], np.int64)
                owner, most = np.frombuffer(r["owner"], np.int32)[searches], np.frombuffer(r["most"], np.int64)[searches]
                anchors, at = np.unique(owner, return_inverse=True)
                scores = _products(q[anchors], rows)
                for i, search in enumerate(searches):
                    o, s, n = owner[i], scores[at[i]], copies
                    wanted = (labels == own_labels[o]) == same
                    if same:
                        me = (ids == own_ids[o]) & wanted
                        if me.any():  # one of the anchor's own rows is the anchor
                            n = copies - (me & (rows == q[o]).all(axis=1))
                            wanted &= n > 0
                    found = np.flatnonzero(wanted & (s >= floors[i]) & (s <= most[i]))
                    if len(found) > top:
                        found = found[np.lexsort((ids[found], -s[found]))[:top]]
                    for c, v in zip(columns, ([r["chunk"]] * len(found), [search] * len(found), s[found], ids[found], np.minimum(n[found], top)), strict=True):
                        c.extend(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[f.split()[1]]) for c, f in zip(columns, FOUND.split(", "), strict=True)], names=[f.split()[0] for f in FOUND.split(", ")])

    return run


def _search(chunks: DataFrame, blocks: DataFrame, cells: list, pivots, norm2: float, size: int, same: bool, top: int) -> DataFrame:
    """(chunk, search, score, id, rank): the first rows of every search. Rounds read rings of cells of growing distance."""
    rank = F.row_number().over(Window.partitionBy("chunk", "search").orderBy(F.desc("score"), "id"))
    found = chunks.sparkSession.createDataFrame([], "chunk long, search int, score long, id long, rank int")
    covered, reach = 0.0, max(1e-9, norm2**0.5 / CELLS)
    slots = F.explode(F.array(*map(F.lit, range(SLOTS))))
    while cells:
        state = found.groupBy("chunk").agg(F.collect_list(F.struct("search", "score")).alias("found"))
        plan = chunks.join(state, "chunk", "left").mapInArrow(_plan(pivots, norm2, size, cells, top, covered, reach), PLAN)
        plan = materialise(plan, "plan")
        if plan.isEmpty():
            break
        here = plan.where("now").withColumn("slot", slots).join(
            blocks.select("pivot", "cell", "slot", *(F.col(c).alias("block_" + c) for c in ("ids", "labels", "copies", "rows"))), ["pivot", "cell", "slot"]
        )
        read = here.join(chunks, "chunk").select(*chunks.columns, "searches", "floors", "block_ids", "block_labels", "block_copies", "block_rows").mapInArrow(_scan(size, same, top), FOUND)
        each = read.withColumn("_", F.explode(F.expr("sequence(1, cast(copies as int))"))).select("chunk", "search", "score", "id")
        found = materialise(found.drop("rank").union(each).withColumn("rank", rank).where(F.col("rank") <= top), "found")
        covered, reach = reach, reach * WIDEN
    return found


def hard_negatives(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a table (vec_id, embedding, label).

    Rows with a null id, label or vector, or a component that is null or not finite, take no
    part. Where vec_id is divisible by RELABEL_EVERY, label becomes (label + 1) % LABELS.
    Components become floor(256 x), at most LARGEST in size; scores are exact inner products of
    these (beyond a long they count as its ends), a shorter vector ends in zeros. Anchors are the rows
    whose vec_id is divisible by ANCHOR_EVERY; an anchor's positives are its POSITIVES best
    other rows of its label, larger scores first, then smaller vec_ids; for each of them the
    first NEGATIVES rows of other labels that score from LEAST_PERCENT percent of the positive
    up to the positive itself. A positive without such rows, and an anchor without positives,
    give none. Repeated rows count each, as positives, as negatives and as anchors. An empty
    table gives no rows; other columns are ignored.

    Rows with one vector and label are one class for the index: as they score alike, its first
    six ids are all that a search can return.
    """
    spark = rows.sparkSession
    label = F.expr(f"case when vec_id % {RELABEL_EVERY} = 0 then (cast(label as bigint) + 1) % {LABELS} else cast(label as bigint) end")
    plain = rows.where("vec_id is not null and label is not null").select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    counted = materialise(plain.mapInArrow(_vectors, ROW).groupBy("vec", "label", "vec_id").agg(F.count("*").alias("copies")), "vectors")
    total, size = counted.agg(F.count("*"), F.max(F.length("vec"))).first()
    size = (size or 0) // 4
    own = Window.partitionBy("vec", "label").orderBy("vec_id")
    first = counted.withColumn("at", F.row_number().over(own)).where(F.col("at") <= max(POSITIVES, NEGATIVES) + 1).select("vec_id", "label", "vec", "copies")
    sample = _matrix([bytes(r["vec"]) for r in counted.select("vec").orderBy(F.xxhash64("vec_id", "vec")).limit(SAMPLE).collect()], size)
    norm2 = float(counted.select("vec").mapInArrow(_norms, "norm2 double").agg(F.max("norm2")).first()[0] or 0.0)
    pivots = fit_pivots(_augmented(sample, norm2), max(1, min(PIVOTS, total // ROWS_A_PIVOT))) if total else np.zeros((1, size + 1))
    cell = max(1e-9, norm2**0.5 / CELLS)

    keyed = materialise(first.mapInArrow(_keys(pivots, norm2, size), "vec_id long, label long, vec binary, copies long, pivot int, key double"), "keys")
    order = ["pivot", "key", "vec_id"]
    blocks = materialise(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(cell, size, block), BLOCKS), "blocks")
    #: at most PIVOTS x 3 CELLS rows: a key is at most the distance of two points within the largest norm
    cells = [tuple(r) for r in blocks.groupBy("pivot", "cell").agg(F.min("low"), F.max("high")).collect()]
    anchors = counted.where(f"vec_id % {ANCHOR_EVERY} = 0").select("vec_id", "label", "vec", "copies")
    chunks = materialise(anchors.mapInArrow(_chunks(size), CHUNKS), "chunks")

    search = lambda of, same, top: _search(of, blocks, cells, pivots, norm2, size, same, top)
    positives = search(chunks, True, POSITIVES)
    listed = materialise(chunks.join(positives.groupBy("chunk").agg(F.collect_list(F.struct("search", "score", "id")).alias("found")), "chunk"), "positives")
    windows = materialise(listed.mapInArrow(_windows, CHUNKS), "windows")
    negatives = search(windows, False, NEGATIVES)
    named = listed.mapInArrow(_named, NAMED).withColumn("_", F.explode(F.expr("sequence(1, cast(copies as int))")))
    return named.join(negatives, ["chunk", "search"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _norms(batches):
    for b in batches:
        x = [np.frombuffer(v, np.int32).astype(float) for v in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([float(v @ v) for v in x], pa.float64())], names=["norm2"])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor of embeddings and each of its positives."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
with rows as (select vec_id, case when vec_id % {RELABEL_EVERY} = 0 then (label::bigint + 1) % {LABELS} else label end as label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as s
  from rows a join rows b on a.vec_id % {ANCHOR_EVERY} = 0 and a.vec_id <> b.vec_id),
positives as (select anchor_id, vec_id as positive_id, s as positive_score from scored where same qualify row_number() over (partition by anchor_id order by s desc, vec_id) <= {POSITIVES})
select p.anchor_id, p.positive_id, cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.s desc, n.vec_id) as int) as rank, n.vec_id as negative_id, p.positive_score, n.s as negative_score
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same and {LEAST_PERCENT} * p.positive_score <= 100 * n.s and n.s <= p.positive_score qualify rank <= {NEGATIVES}
"""
