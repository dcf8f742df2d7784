"""Approximate nearest neighbours (operator 8) with learned partitions.

A neighbour graph of a bounded sample is cut into parts of equal size; a small classifier
learns to tell a vector's part; it gives every row of the index its part, and sends each
query to its several most probable parts, whose rows are ranked by exact distance. A part
that is still large is cut again in the same way, from a sample of its own, so parts keep
their size however many rows there are. Every fit and every search is a task of its own.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

#: Rows (about) of a node that its parts are learned from; and how many of them tune the number of parts that a query sees.
SAMPLE, TUNE = 8_192, 512
NEIGHBOURS, TOP = 10, 10
#: A whole index of more than FIRST vectors and any part of more than LEAF are cut, into parts of PART_ROWS at least, FAN at most.
FIRST, LEAF, PART_ROWS, FAN = 256, 1_536, 256, 64
#: Cuts one below the other: 64^6 parts. What can't be cut by then is searched in blocks.
DEPTH = 6
#: Share of the sample's true neighbours that the parts which a query sees must hold, at each cut.
AIM = 0.975
#: Rows and queries that one task compares at once, and rows that one task routes at once.
BLOCK, QUERIES, CHUNK = 4_096, 4_096, 8_192


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, step: int = 128) -> np.ndarray:
    """Indices of the k nearest rows of each query, by blocks."""
    out = []
    norm = (rows**2).sum(1)
    for i in range(0, len(queries), step):
        d = norm - 2 * queries[i : i + step] @ rows.T
        out.append(np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """A balanced cut of the neighbour graph.

    Starts from halvings at the median of the widest direction (equal sizes), then nodes move
    to the part that most of their neighbours are in, best gain first, while it has room.
    """
    label = np.zeros(len(x), np.int64)
    n = 1
    while n < parts:
        for p in range(n):
            own = np.flatnonzero(label == p)
            if len(own) > 1:
                c = x[own] - x[own].mean(0)
                axis = np.linalg.svd(c[:: max(1, len(c) // 1024)], full_matrices=False)[2][0]
                order = np.argsort(c @ axis, kind="stable")
                label[own[order[len(own) // 2 :]]] = p + n
        n *= 2
    room = int(slack * len(x) / n) + 1
    both = np.concatenate([np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()]), np.stack([graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])])], axis=1)
    for _ in range(rounds):
        votes = np.bincount(both[0] * n + label[both[1]], minlength=len(x) * n).reshape(len(x), n)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        size, moved = np.bincount(label, minlength=n), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if moved < len(x) // 200:
            break
    return label


class Router:
    """Softmax over one hidden layer: the probability of each part."""

    def __init__(self, mean: np.ndarray, scale: float, w: list[np.ndarray]):
        self.mean, self.scale, self.w = mean, scale, w

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, hidden: int = 64, epochs: int = 40, seed: int = 5) -> Router:
        r = np.random.default_rng(seed)
        own = cls(x.mean(0), float(x.std()) + 1e-9, [])
        z = (x - own.mean) / own.scale
        own.w = w = [r.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), r.normal(0, hidden**-0.5, (hidden, target.shape[1])), np.zeros(target.shape[1])]
        m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(z))
            for i in range(0, len(z), 256):
                b = order[i : i + 256]
                h = np.maximum(z[b] @ w[0] + w[1], 0)
                d = (own._soft(h @ w[2] + w[3]) - target[b]) / len(b)
                e = (d @ w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((z[b].T @ e, e.sum(0), h.T @ d, d.sum(0))):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    w[k] -= 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return own

    @staticmethod
    def _soft(a: np.ndarray) -> np.ndarray:
        a = np.exp(a - a.max(1, keepdims=True))
        return a / a.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return self._soft(np.maximum(z @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, the most probable first."""
        return np.argsort(-self(x), axis=1, kind="stable")

    def written(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, self.mean, np.array(self.scale), *self.w)
        return out.getvalue()

    @classmethod
    def read(cls, data: bytes) -> Router:
        a = list(np.load(io.BytesIO(data)).values())
        return cls(a[0], float(a[1]), a[2:])


def parts_of(n: int) -> int:
    """How many parts a node of n vectors is cut into: a power of two."""
    return min(FAN, max(2, 1 << max(0, (n // PART_ROWS).bit_length() - 1)))


def fit(sample: np.ndarray, parts: int) -> tuple[Router, int]:
    """The router of a cut into parts, and how many of them a query must see to meet AIM.

    That number is tuned on sample rows that the router was not trained on.
    """
    graph = nearest(sample, sample, min(NEIGHBOURS + 1, len(sample)))
    label = balanced_parts(sample, graph, parts)
    n = parts
    target = np.zeros((len(sample), n))
    np.add.at(target, (np.repeat(np.arange(len(sample)), graph.shape[1]), label[graph].ravel()), 1)
    target /= target.sum(1, keepdims=True)
    every = max(2, len(sample) // TUNE)
    tune = np.arange(len(sample)) % every == 0
    router = Router.fit(sample[~tune], target[~tune])
    given = router(sample).argmax(1)
    order = router.order(sample[tune])
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[None].repeat(len(order), 0), 1)
    need = np.take_along_axis(rank, given[graph[tune]], 1).ravel()
    share = np.array([(need < k).mean() for k in range(1, n + 1)])
    return router, int(np.searchsorted(share, AIM) + 1)


def clean(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    ok = (
        F.col("vec_id").isNotNull()
        & x.isNotNull()
        & (F.size(x) > 0)
        & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.exists(x, lambda v: v != 0)
    )
    return rows.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def classes(x: DataFrame, k: int) -> DataFrame:
    """(cls, x, ids, node): one row per different vector, with its k + 1 smallest vec_ids.

    Other copies of the vector are as near as those and have larger ids, so that none of them
    can be among the k nearest of anything. The root node of a vector is its number of components.
    """
    at = F.dense_rank().over(Window.partitionBy("x").orderBy("vec_id"))
    kept = x.withColumn("at", at).where(F.col("at") <= k + 1)
    own = kept.groupBy("x").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    return own.select(F.monotonically_increasing_id().alias("cls"), "x", "ids", F.size("x").cast("string").alias("node"))


def _chunks(rows: DataFrame, sizes: DataFrame, chunk: int) -> DataFrame:
    """rows of the nodes in sizes (node, n), dealt to chunks of about so many."""
    return rows.join(sizes.select("node", F.ceil(F.col("n") / chunk).alias("of")), "node").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("of"))).drop("of")


def _for_chunks(routers: DataFrame, sizes: DataFrame, chunk: int) -> DataFrame:
    of = sizes.select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / chunk) - 1)).alias("chunk"))
    return routers.join(of, "node")


def _fit_node(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("low", kind="stable")
    router, seen = fit(np.stack(pdf["x"].to_numpy()), parts_of(int(pdf["n"].iloc[0])))
    return pd.DataFrame({"node": [key[0]], "net": [router.written()], "seen": [seen]})


def _place(key: tuple, rows: pd.DataFrame, net: pd.DataFrame) -> pd.DataFrame:
    """Every index row goes to its most probable part."""
    if len(rows):
        part = Router.read(net["net"].iloc[0])(np.stack(rows["x"].to_numpy())).argmax(1)
        rows["node"] = [f"{key[0]}/{p}" for p in part]
    return rows[["cls", "x", "ids", "node"]]


def _send(k: int):
    """Every query goes to its `seen` most probable parts, and to more while those have too few vectors."""

    def run(key: tuple, rows: pd.DataFrame, net: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            size = dict(zip(net["parts"].iloc[0], net["sizes"].iloc[0], strict=True))
            seen = int(net["seen"].iloc[0])
            for cls, x, order in zip(rows["cls"], rows["x"], Router.read(net["net"].iloc[0]).order(np.stack(rows["x"].to_numpy())), strict=True):
                held = 0
                for i, p in enumerate(order):
                    if i >= seen and held > k:
                        break
                    node = f"{key[0]}/{p}"
                    if node in size:
                        held += size[node]
                        out.append((cls, x, node))
        return pd.DataFrame(out, columns=["cls", "x", "node"])

    return run


def descend(index: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """index (cls, x, ids, node) with the part of every vector, and queries (cls, x, node) with all parts that they see.

    One round per level of the tree, over the nodes that are too large. Nodes are counted,
    fitted, filled and asked by Spark; the driver only learns whether any is left to cut.
    """
    for depth in range(DEPTH):
        sizes = materialise(index.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > (LEAF if depth else FIRST)), "nodes")
        if sizes.isEmpty():
            break
        inside = index.join(sizes, "node")
        low = F.col("ids")[0]
        chosen = F.pmod(F.xxhash64(F.lit(depth), low, "x"), F.lit(1 << 30)) < F.least(F.lit(1.0), SAMPLE / F.col("n")) * (1 << 30)
        sample = inside.where(chosen).select("node", "n", "x", low.alias("low"))
        routers = materialise(sample.groupBy("node").applyInPandas(_fit_node, "node string, net binary, seen int"), "routers")
        key = ["node", "chunk"]
        mine = _chunks(index, sizes, CHUNK).groupBy(*key).cogroup(_for_chunks(routers, sizes, CHUNK).groupBy(*key))
        placed = mine.applyInPandas(_place, "cls long, x array<double>, ids array<long>, node string")
        index = materialise(index.join(sizes, "node", "left_anti").select("cls", "x", "ids", "node").union(placed), "index")
        children = index.groupBy("node").count().withColumn("parent", F.regexp_replace("node", "/[^/]*$", ""))
        children = children.groupBy(F.col("parent").alias("node")).agg(F.collect_list("node").alias("parts"), F.collect_list("count").alias("sizes"))
        asks = queries.groupBy("node").agg(F.count("*").alias("n")).join(sizes.select("node"), "node", "left_semi")
        theirs = _chunks(queries, asks, CHUNK).groupBy(*key).cogroup(_for_chunks(routers.join(children, "node"), asks, CHUNK).groupBy(*key))
        sent = theirs.applyInPandas(_send(k), "cls long, x array<double>, node string")
        queries = materialise(queries.join(sizes, "node", "left_anti").select("cls", "x", "node").union(sent), "queries")
    return index, queries


def _rank(k: int):
    """The k + 1 nearest (vector, id) of each query in one block of a part."""

    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(r):
            own, m, ids = r["cls"].to_numpy(), np.stack(r["x"].to_numpy()), r["ids"].to_numpy()
            for cls, v in zip(q["cls"], q["x"], strict=True):
                d = np.sqrt(((m - v) ** 2).sum(1))
                few = np.flatnonzero(d <= np.partition(d, k)[k]) if len(d) > k + 1 else np.arange(len(d))
                near = sorted((d[i], vec, own[i]) for i in few for vec in ids[i])[: k + 1]
                out += [(cls, *x) for x in near]
        return pd.DataFrame(out, columns=["query", "score", "vec_id", "cls"]).astype({"query": "int64", "score": "float64", "vec_id": "int64", "cls": "int64"})

    return run


def ranked(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, best): the k + 1 nearest (score, vec_id, cls) over all parts that a query sees.

    A part is searched in blocks of about BLOCK rows, by up to QUERIES queries at once.
    """
    count = lambda rows, name, step: rows.groupBy("node").agg(F.ceil(F.count("*") / step).cast("int").alias(name))
    sizes = materialise(count(index, "blocks", BLOCK).join(count(queries, "chunks", QUERIES), "node"), "parts")
    other = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    own = lambda name: F.pmod(F.xxhash64("cls"), F.col(name)).cast("int")
    asked = queries.join(sizes, "node").select("node", "cls", "x", own("chunks").alias("chunk"), other("blocks").alias("block"))
    held = index.join(sizes, "node").select("node", "cls", "x", "ids", own("blocks").alias("block"), other("chunks").alias("chunk"))
    key = ["node", "block", "chunk"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(_rank(k), "query long, score double, vec_id long, cls long")
    return found.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id", "cls"))), 1, k + 1).alias("best"))


def search(rows: DataFrame, every: int = 100, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of each row whose vec_id is divisible by `every`.

    Candidates are all other rows whose vector has the same number of components. Vectors
    that are null, empty, zero, or hold null or non-finite components take no part. Rows that
    repeat both vec_id and vector count once; one vec_id with several vectors is several rows,
    each a candidate and, if asked for, a query. score is the Euclidean distance in double
    precision; ties go to the smaller vec_id. An empty table gives no rows; other columns are ignored.

    Equal vectors are searched for and indexed once (see `classes`), which is exact, and keeps
    a vector with many copies from filling a part. Parts are learned from about SAMPLE rows of
    each node, chosen by a hash; every vector is indexed. A query always sees more than k vectors, if there are any.
    """
    x = clean(rows)
    of = materialise(classes(x, k), "classes")
    asked = x.where(F.col("vec_id") % every == 0).distinct().join(of.select("x", "cls"), "x").select(F.col("vec_id").alias("query_id"), F.col("cls").alias("query"))
    asked = materialise(asked, "asked")
    queries = materialise(of.join(asked.select(F.col("query").alias("cls")).distinct(), "cls", "left_semi").select("cls", "x", "node"), "queries")
    best = ranked(*descend(of, queries, k), k)
    mine = lambda b: (b["vec_id"] == F.col("query_id")) & (b["cls"] == F.col("query"))
    others = asked.join(best, "query").select("query_id", F.slice(F.filter("best", lambda b: ~mine(b)), 1, k).alias("best"))
    return others.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")


def op8_ann_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows (at most) for each query."""
    return search(table(spark, sf_dir, "embeddings"))
