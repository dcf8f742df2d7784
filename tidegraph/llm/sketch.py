"""Document fingerprints (operator 3): a threshold-scaled sketch of word shingles.

The sketch of a text is the set of its shingle hashes below a fixed fraction of the hash
space. As the threshold is the same everywhere, sketches of parts can be united, and the
likeness and containment of very unequal documents can be read from two sketches.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import table

SHINGLE = 5
#: One hash in SCALE is kept. Hashes have 48 bits and are written as twelve hex digits each.
SCALE = 4
LIMIT = np.uint64((1 << 48) // SCALE)
#: Rows that a run of neighbouring documents has on average, and the most runs.
RUN_ROWS, MOST_RUNS = 64, 32_768
#: Ids of the sample for each run.
SAMPLED = 32
#: An id with more rows than this many runs, or than one in HEAVY of all rows, is cut into runs by a hash of the text.
HEAVY_RUNS, HEAVY = 8, 4_096
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def sketch(text: str) -> np.ndarray:
    """Sorted distinct kept hashes. The smallest hash is always kept, so only blank texts have none.

    Words are lower-cased (A-Z) stretches without ASCII white space; a text of fewer than
    five words is one shingle.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)
    k = min(SHINGLE, len(h))
    x = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        x += h[i : len(h) - k + 1 + i] * _ODD[i]
    x ^= x >> np.uint64(32)
    x *= _ODD[0]
    x ^= x >> np.uint64(29)
    x *= _ODD[1]
    x >>= np.uint64(16)
    kept = np.unique(x[x < LIMIT])
    return kept if len(kept) else x.min(keepdims=True)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness: 1 for two blank texts, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts together."""
    both = np.union1d(a, b)
    return both if both[-1:] < LIMIT else both[: max(1, np.searchsorted(both, LIMIT))]


def to_string(a: np.ndarray) -> str:
    return a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex() if len(a) else ""


def from_string(s: str) -> np.ndarray:
    return np.array([int(s[i : i + 12], 16) for i in range(0, len(s), 12)], np.uint64)


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches):
    """Rows come sorted by run; a run ends with a copy of the row that follows it."""
    names = [x.split()[0] for x in OUT.split(", ")]
    held = None  # run, id, text, sketch
    for b in batches:
        out = []
        for run, copy, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            text = text or ""
            if held is None and copy:
                continue
            own = sketch(text)
            if held is not None and held[0] == run:
                _, was_id, was, its = held
                half = len(was) // 2
                edited = was[: len(was) - half] + text[:half]
                e = sketch(edited)
                out.append((was_id, len(was), sha256(edited.encode()).hexdigest(), to_string(its), to_string(e), likeness(its, e), likeness(its, own)))
            held = None if copy else (run, doc_id, text, own)
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_ARROW)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(x, pa.string()) for x in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _cuts(rows: DataFrame, n: int, runs: int) -> np.ndarray:
    """Ids that cut the rows into runs of about one size: quantiles of a sample by hash, SAMPLED rows for each run."""
    if runs == 1:
        return np.array([], np.int64)
    share = min(1.0, SAMPLED * runs / n)
    own = rows.where(F.col("doc_id").isNotNull()).where(F.pmod(F.xxhash64(F.lit(3), "doc_id", "h"), F.lit(1 << 32)) < int(share * (1 << 32)))
    ids = np.sort(own.select("doc_id").toArrow().column(0).to_numpy())
    return ids[np.arange(1, runs) * len(ids) // runs] if len(ids) else np.array([], np.int64)


def fingerprint_with_next(docs: DataFrame) -> DataFrame:
    """Each document's sketch, that of its edited text, and its likeness to that and to the next document.

    The next document is that with the next larger doc_id (repeated ids: by a hash of the text,
    then by text; null ids come first); after the last comes the first, and a single document
    follows itself. Null texts are empty: empty fingerprints, likeness 1 to another empty one.
    An empty table gives no rows; other columns are ignored.

    The ids are cut into runs at quantiles of a sample, and an id of very many rows (null, say) into runs
    by the hash; the texts are shuffled once by run, together with a copy of the first document
    of each run for the run before it, and each run is read in order as a stream. The sample,
    heavy ids and first ids (a few numbers a run, about MOST_RUNS at most) are all that the
    driver and the broadcasts hold.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))
    n = rows.count()
    runs = max(1, min(MOST_RUNS, n // RUN_ROWS))
    cuts = _cuts(rows, n, runs)
    many = rows.groupBy("doc_id").count().where(F.col("count") > max(HEAVY_RUNS * RUN_ROWS, n // HEAVY)).collect()
    pieces = {r["doc_id"]: -(-r["count"] // max(RUN_ROWS, n // MOST_RUNS)) for r in many}
    nulls = pieces.pop(None, 1)
    heavy = np.array(sorted(pieces), np.int64)
    cut = np.array([1, *(pieces[i] for i in heavy.tolist())], np.int64)
    edges = np.unique(np.concatenate([cuts, heavy, heavy + 1]))

    @F.pandas_udf("run long, heavy boolean")
    def run_of(ids: pd.Series, h: pd.Series) -> pd.DataFrame:
        has, own = ids.notna().to_numpy(), ids.fillna(0).to_numpy(np.int64)
        at = np.searchsorted(heavy, own)
        is_heavy = has & (np.append(heavy, 0)[at] == own) & (at < len(heavy))
        of = np.where(has, cut[np.where(is_heavy, at + 1, 0)], nulls)
        sub = np.minimum((h.to_numpy(np.float64) + 2.0**63) / 2.0**64 * of, of - 1).astype(np.int64)
        return pd.DataFrame({"run": np.where(has, np.searchsorted(edges, own, side="right"), -1) * (1 << 24) + sub, "heavy": is_heavy | ~has})

    dealt = rows.withColumn("r", run_of("doc_id", "h")).select("doc_id", "text", "h", "r.run", "r.heavy")
    # the first row of a run: by id, or, in a run of one heavy id, by hash
    dealt = dealt.withColumn("first", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("key", F.when(F.col("heavy"), F.col("h")).otherwise(F.lit(0)))
    heads = dealt.groupBy("run").agg(F.min("first").alias("first"), F.min("key").alias("key"))
    order = sorted((r["run"], r["first"], r["key"]) for r in heads.collect())
    to = [(order[i][1], order[i][2], order[i - 1][0]) for i in range(len(order))]
    ahead = F.broadcast(spark.createDataFrame(to, "first long, key long, run long"))
    copies = dealt.drop("run").join(ahead, ["first", "key"]).select("run", F.lit(True).alias("copy"), "doc_id", "text", "h").dropDuplicates(["run", "doc_id", "h"])
    sorted_runs = (
        dealt.select("run", F.lit(False).alias("copy"), "doc_id", "text", "h")
        .union(copies)
        .repartition("run")
        .sortWithinPartitions("run", "copy", "doc_id", "h", "text")
    )
    return sorted_runs.select("run", "copy", "doc_id", "text").mapInArrow(_compare, OUT)


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document."""
    return fingerprint_with_next(table(spark, sf_dir, "documents"))
