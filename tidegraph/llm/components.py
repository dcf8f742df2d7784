"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Nodes are longs. Null ends and self loops are ignored; repeated edges count once; no
    edges give no rows. Each round is one large-star and one small-star step (a logarithmic
    number of rounds), and is written to the shared folder, so a lost executor costs at most
    one round. Neighbour lists are only ever reduced to their minimum, never gathered.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .distinct()
    )
    e = materialise(e, "cc")
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == state or now["n"] == 0:
            break
        state = (now["n"], now["h"])
        both = e.union(e.select(F.col("v"), F.col("u")))
        # written, so that both sides of the join come from shuffles, which Spark can split where a node has very many edges
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "cc")
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "cc")
        small = large.join(low, "u").select(
            F.explode(
                F.when(F.col("v") == F.col("m"), F.array(F.struct("u", F.col("m").alias("v")))).otherwise(
                    F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
                )
            ).alias("e")
        )
        e = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "cc")
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root"), F.col("root")).distinct())
