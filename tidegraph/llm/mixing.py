"""Mixing sources to target weights (operator 6) by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

SEED = "mix-1"
#: Above this mean a Poisson count is a sum of several with smaller means (exp(-mean) must not vanish).
PART = 500.0
#: Rate tables of up to this many sources (30-odd numbers each) are broadcast; larger ones are shuffled.
BROADCAST_SOURCES = 2_000


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a SHA-256, the same on every engine."""
    digits = F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, size: int | None = None) -> DataFrame:
    """(source, n, rate, parts, cdf): mean repetitions of each source's documents, and their distribution.

    weights gives target shares by source (others get 0); without it a source's share is in
    proportion to the square root of its documents. size is the expected number of rows in
    all, by default as many as there are. Counts cover all documents.
    """
    n = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = n.withColumn("w", F.sqrt("n"))
    else:
        of = docs.sparkSession.createDataFrame(list(weights.items()) or [("", 0.0)], "source string, w double")
        weighed = n.join(F.broadcast(of) if len(weights) <= BROADCAST_SOURCES else of, "source", "left").fillna(0.0, ["w"])
    weighed = materialise(weighed, "weights")
    total = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    all_w, all_n = float(total["w"] or 0) or 1.0, float(size if size is not None else total["n"] or 0)
    rated = weighed.select("source", "n", F.round(F.lit(all_n) * F.col("w") / F.lit(all_w) / F.col("n"), 9).alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART).cast("int")))
    mean = F.col("rate") / F.col("parts")
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))
    zero = F.exp(-mean)
    cdf = F.aggregate(
        steps,
        F.struct(zero.alias("p"), zero.alias("c"), F.array(zero).alias("all")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            (s["c"] + s["p"] * mean / k).alias("c"),
            F.concat(s["all"], F.array(s["c"] + s["p"] * mean / k)).alias("all"),
        ),
        lambda s: s["all"],
    )
    return rated.withColumn("cdf", cdf)


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, size: int | None = None) -> DataFrame:
    """(doc, copy, copies, position): every document as often as its Poisson count says, shuffled globally.

    doc is the whole row. The count inverts the Poisson distribution with the source's mean
    rate at a number hashed from the seed and doc_id, so it doesn't depend on partitioning or
    reruns, and repeated rows get the same count. Null sources are a source of their own;
    a null doc_id hashes like the text "null"; texts aren't looked at. Rows with a count of 0
    leave. position is a hash of seed, doc_id and copy: rows are dealt to partitions by it
    and sorted by it there, and ordering by it gives the global order (ties: equal ids).
    """
    rated = materialise(rates(docs, weights, size), "rates")
    few = rated.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    right = rated.select(F.col("source").alias("_s"), "parts", "cdf")
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    joined = rows.join(F.broadcast(right) if few else right, F.col("doc.source").cast("string").eqNullSafe(F.col("_s")))
    doc_id = F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("null"))
    # one hash per row and part, then a look-up in the distribution
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda i: uniform(F.lit(SEED), doc_id, i.cast("string")))
    count = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter("cdf", lambda c: c <= u)))
    copies = (
        joined.select("doc", count.alias("copies"))
        .where("copies > 0")
        .select("doc", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    position = F.sha2(F.concat_ws(":", F.lit(SEED), F.lit("at"), doc_id, F.col("copy").cast("string")), 256)
    dealt = copies.select("doc", "copy", "copies", F.substring(position, 1, 16).alias("position"))
    return dealt.repartition("position").sortWithinPartitions("position")


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, size: int | None = None) -> DataFrame:
    """The replicated and shuffled documents, with the columns of docs."""
    return replicate(docs, weights, size).select("doc.*")


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per copy of a document, with its place in the global order."""
    return replicate(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "doc.source", "doc.lang", "doc.n_chars", "doc.text", "copy", "copies", "position"
    )


OP6_SQL = f"""
with recursive n as (select source, count(*) as n from documents group by source),
t as (select sum(sqrt(n)) as w, sum(n) as n from n),
r as (select n.source, round(cast(t.n as double) * sqrt(n.n) / t.w / n.n, 9) as rate from n, t),
m as (select source, greatest(1, cast(ceil(rate / {PART}) as int)) as parts, rate / greatest(1, cast(ceil(rate / {PART}) as int)) as mean from r),
cdf as (
  select source, mean, 0 as k, exp(-mean) as p, exp(-mean) as c from m
  union all
  select source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from cdf
  where k < cast(ceil(mean + 12 * sqrt(mean) + 20) as int)
),
u as (
  select d.*, i, (cast('0x' || substr(sha256(concat_ws(':', '{SEED}', cast(d.doc_id as varchar), cast(i as varchar))), 1, 13) as bigint) + 0.5::double) / 4503599627370496.0::double as u
  from documents d join m on d.source is not distinct from m.source, unnest(range(1, m.parts + 1)) as x(i)
),
c as (
  select u.doc_id, u.source, u.lang, u.n_chars, u.text, sum((select count(*) from cdf where cdf.source is not distinct from u.source and cdf.c <= u.u)) as copies
  from u group by all
)
select doc_id, source, lang, n_chars, text, cast(copy as int) as copy, cast(copies as int) as copies,
  substr(sha256(concat_ws(':', '{SEED}', 'at', cast(doc_id as varchar), cast(copy as varchar))), 1, 16) as position
from c, unnest(range(1, cast(copies as bigint) + 1)) as y(copy)
"""
