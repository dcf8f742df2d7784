"""SimHash near-duplicate grouping (operator 10): pigeonhole blocks, verified Hamming distance."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegraph.llm._tables import materialise, table
from tidegraph.llm.components import connected_components

BITS, BLOCKS, DISTANCE, SHINGLE, SEED = 64, 4, 2, 3, 42
WIDTH = BITS // BLOCKS
#: Above this many different fingerprints under one block key, links come from one-bit variants.
PAIRWISE = 64
CHUNK = 1 << 15


def _fingerprint(data: bytes | None) -> int:
    words = (data or b"").lower().split()  # bytes: A-Z only, and exactly \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) < SHINGLE:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches):
    for b in batches:
        texts = b.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_fingerprint(t) for t in texts], pa.int64())], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; null, empty and blank texts have fingerprint 0."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id long, fp long"
    )


def _distance(x, y):
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the fingerprints (one distinct column fp) at most DISTANCE bits apart.

    Four blocks of 16 bits: two differing bits leave two blocks equal, so every close pair
    shares one of six two-block keys. Keys with up to PAIRWISE fingerprints are joined on the
    key and verified. Under a larger key the other two blocks may differ in two bits: each
    fingerprint sends itself and its 32 one-bit variants there, and those that meet at a
    variant (33 at most, each within one bit of it) are at most two bits apart; they are
    linked to the smallest. That is exact and linear in the size of the key.
    """
    block = [F.shiftrightunsigned("fp", WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1)) for i in range(BLOCKS)]
    pairs = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))
    keyed = fps.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(k).alias("k"),
                        F.shiftleft(block[i], WIDTH).bitwiseOR(block[j]).alias("v"),
                    )
                    for k, (i, j) in enumerate(pairs)
                )
            )
        ).alias("key"),
    ).select("fp", "key.k", "key.v")
    sizes = materialise(keyed.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    shared = materialise(keyed.join(sizes, ["k", "v"]), "keyed")
    few = shared.where(F.col("n") <= PAIRWISE)
    x, y = few.select("k", "v", F.col("fp").alias("a")), few.select("k", "v", F.col("fp").alias("b"))
    near = x.join(y, ["k", "v"]).where((F.col("a") < F.col("b")) & (_distance("a", "b") <= DISTANCE)).select("a", "b")
    free = F.expr(
        "element_at(array("
        + ",".join(
            "array(" + ",".join(str(WIDTH * i + t) for i in range(BLOCKS) if i not in p for t in range(WIDTH)) + ")"
            for p in pairs
        )
        + "), k + 1)"
    )
    many = shared.where(F.col("n") > PAIRWISE).withColumn("bit", F.explode(F.concat(F.array(F.lit(-1)), free)))
    at = many.select(
        "k", "v", "fp", F.expr("if(bit < 0, fp, fp ^ shiftleft(1L, bit))").alias("at")
    )
    stars = (
        at.groupBy("k", "v", "at")
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .where("a <> b")
    )
    return near.union(stars)


def group(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row of docs; root is the smallest fingerprint of the component.

    Rows are linked when their fingerprints differ in at most two bits; component_id is the
    smallest doc_id that can be reached over links, the row's own included. Equal
    fingerprints are first put together, so copies never form pairs. Null and blank texts
    have fingerprint 0 and are linked like any other; a null doc_id takes no part in the
    smallest id (null if there is no other). Repeated rows give repeated rows; an empty table
    gives none; other columns are ignored.
    """
    rows = materialise(fingerprints(docs), "fp")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = materialise(rooted, "rooted")
    lows = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    of = materialise(rooted.join(lows, "root").select("fp", "component_id", "root"), "of")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id", "root")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: fingerprint (16 hex digits) and component_id."""
    return group(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without near duplicates: of each component the document with the smallest doc_id stays.

    Where that id has several rows, the smallest of the component's by all columns in their
    order stays; different texts under one id that are no near duplicates all stay. Rows
    without a doc_id stay, as nothing can be said to stand for them. Null and blank texts are
    one component. An empty table gives no rows. Columns and their order are those of docs.
    """
    ids = materialise(group(docs.where("doc_id is not null")).where("doc_id = component_id"), "groups")
    several = materialise(ids.groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    kept = docs.join(ids.join(several, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
    rest = docs.where("doc_id is null")
    if not several.isEmpty():  # few rows: their fingerprints tell which component each belongs to
        twice = docs.join(several, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("doc"))
        marked = twice.select("doc", F.col("doc.text").cast("string").alias("text"), F.col("doc.doc_id").cast("long").alias("doc_id")).mapInArrow(
            _fingerprinted, T.StructType([twice.schema["doc"], T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
        )
        own = marked.join(ids.join(several, "doc_id").select("doc_id", "fp", "root").distinct(), ["doc_id", "fp"])
        first = F.row_number().over(Window.partitionBy("doc_id", "root").orderBy("doc"))
        rest = rest.select(*docs.columns).union(own.withColumn("at", first).where("at = 1").select("doc.*"))
    return kept.select(*docs.columns).union(rest.select(*docs.columns))


def _fingerprinted(batches):
    for b in batches:
        fp = [_fingerprint(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp, pa.int64())], names=["doc", "doc_id", "fp"])
