"""Phrase collocation mining (operator 13): packed keys of dictionary ids, range partitions, run lengths.

Words of enough occurrences get ids; pieces break at all other words. Every position hands on
one fixed-width key, the ids of the next four words of its piece (zeros behind the end), so
that one sorted order holds the runs of all phrases of two, three and four words: a phrase is
a prefix. Keys are sorted by radix and counted in the task that reads the text, then
partitioned by ranges of the key, sorted, and run-length counted.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

LONGEST, LEAST, INSIDE, TOP = 4, 30, 80, 2000
#: A dictionary of up to so many bytes of words goes to every task; a larger one stays distributed, and ids are digests.
DICTIONARY_BYTES = 1 << 26
#: Different words, or positions, that a task holds before it hands on its counts.
HELD_WORDS, HELD_KEYS = 1 << 18, 1 << 20
UNDETERMINED = "und"
#: A-Z become a-z; what ends a piece becomes 0xFF, which no UTF-8 text holds.
_BREAK = b"\xff"
_FOLD = bytes(0xFF if chr(i) in ".,;:!?" or 10 <= i <= 13 else i + 32 if 65 <= i <= 90 else i for i in range(256))


def _tokens(data: bytes) -> list[bytes]:
    """The words of a text in order, and 0xFF between pieces."""
    return data.translate(_FOLD).replace(_BREAK, b" \xff ").split()  # \x0A-\x0D are gone: splits at \x20 and \x09


def _texts(batches):
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
            yield lang, text or b""


def _word_counts(batches):
    """(lang, word, n) of all words, and (lang, null, n) for their sum; in portions."""

    def out(held, sums):
        rows = [(lang, w, c) for (lang, w), c in held.items()] + [(lang, None, c) for lang, c in sums.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "word", "n"])

    held, sums = Counter(), Counter()
    for lang, text in _texts(batches):
        words = _tokens(text)
        own = Counter(words)
        sums[lang] += len(words) - own.pop(_BREAK, 0)
        for w, c in own.items():
            held[lang, w] += c
        if len(held) >= HELD_WORDS:
            yield out(held, sums)
            held, sums = Counter(), Counter()
    yield out(held, sums)


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by columns of uint32, first column first: stable passes over 16 bits, last digit first."""
    order = np.arange(len(columns[0]))
    for c in reversed(columns):
        for shift in (0, 16):
            digit = (c >> np.uint32(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _windows(codes: np.ndarray, context: int) -> list[np.ndarray]:
    """For each position that starts a phrase, the codes of its next LONGEST words, zero from the end of the piece on.

    The last `context` positions start none.
    """
    padded = np.concatenate([codes, np.zeros(LONGEST, codes.dtype)])
    columns, inside = [], np.ones(len(codes), bool)
    for j in range(LONGEST):
        at = padded[j : j + len(codes)]
        inside = inside & (at != 0)
        columns.append(np.where(inside, at, 0).astype(np.uint32))
    starts = columns[1] != 0
    starts[len(codes) - context :] = False
    return [c[starts] for c in columns]


def _key_counts(dictionary, width: int):
    """Reads (lang, text); gives (key, n), sorted and counted by portions.

    dictionary: a broadcast of (lang, word) -> id, or None: then the id of a word is a digest
    of language and word, and every word counts as frequent.
    """

    def run(batches):
        ids = dictionary.value if dictionary is not None else None

        def out(parts, words, context=0):
            columns = _windows(np.concatenate(parts), context) if parts else [np.zeros(0, np.uint32)] * LONGEST
            order = radix_order(columns)
            columns = [c[order] for c in columns]
            new = np.zeros(len(order), bool)
            new[:1] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            if ids is not None:
                packed = [c[first].astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - width :] for c in columns]
            else:
                digests = [b"\0" * width] + [_digest(lang, w) for lang, w in words]
                look = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, width)
                packed = [look[c[first]] for c in columns]
            keys = np.ascontiguousarray(np.concatenate(packed, axis=1))
            key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LONGEST * width), len(keys), [None, pa.py_buffer(keys)])
            n = np.diff(np.append(first, len(order)))
            return pa.RecordBatch.from_arrays([key.cast(pa.binary()), pa.array(n, pa.int64())], names=["key", "n"])

        parts, size, words = [], 0, {}
        for lang, text in _texts(batches):
            tokens = _tokens(text)
            for i in range(0, len(tokens), HELD_KEYS):
                some = tokens[i : i + HELD_KEYS + LONGEST - 1]
                if ids is not None:
                    own = ids.get(lang, {})
                    codes = [own.get(w, 0) for w in some]
                else:
                    codes = [0 if w == _BREAK else words.setdefault((lang, w), len(words) + 1) for w in some]
                parts.append(np.array([*codes, 0], np.uint32))
                size += len(some)
                if i + HELD_KEYS < len(tokens):  # a very long text: phrases that start behind HELD_KEYS belong to its next portion
                    yield out(parts, words, len(some) - HELD_KEYS + 1)
                    parts, size, words = [], 0, {}
            if size >= HELD_KEYS or len(words) >= HELD_WORDS:
                yield out(parts, words)
                parts, size, words = [], 0, {}
        yield out(parts, words)

    return run


def _digest(lang: str, word: bytes) -> bytes:
    return xxhash.xxh3_128_digest(lang.encode() + b"\0" + word)


def _digests(batches):
    for b in batches:
        made = [_digest(lang, w) for lang, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(made, pa.binary())], names=["lang", "word", "n", "id"])


def _run_lengths(width: int, least: int):
    """Reads sorted (key, n) of one range; gives (phrase, n): the runs of each prefix.

    Runs at the edge of the range may go on in the next one, so they are given whatever their size.
    """

    def run(batches):
        held = {}  # length: [phrase, n, whether it is the first run of the range]
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, LONGEST * width)
            n = b.column(1).to_numpy(zero_copy_only=False)
            phrases, counts = [], []
            for length in range(2, LONGEST + 1):
                long_enough = keys[:, (length - 1) * width : length * width].any(axis=1)
                own, m = keys[long_enough, : length * width], n[long_enough]
                if not len(own):
                    continue
                first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
                sums = np.add.reduceat(m, first)
                last = held.get(length)
                if last and last[0] == own[0].tobytes():
                    sums[0] += last[1]
                    edge = last[2]
                elif last:
                    edge = False
                    if last[2] or last[1] >= least:
                        phrases.append(last[0])
                        counts.append(last[1])
                else:
                    edge = True
                done = np.flatnonzero(sums[:-1] >= least)
                if edge and len(sums) > 1 and (not len(done) or done[0] != 0):
                    done = np.append(0, done)
                phrases += [own[first[i]].tobytes() for i in done]
                counts += sums[done].tolist()
                held[length] = [own[first[-1]].tobytes(), int(sums[-1]), edge and len(sums) == 1]
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())], names=["phrase", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in held.values()], pa.binary()), pa.array([x[1] for x in held.values()], pa.int64())], names=["phrase", "n"])

    return run


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to four words of each language.

    Texts are cut into pieces at . , ; : ! ? and line ends, pieces into words at blanks and
    tabs; A-Z count as a-z. a: occurrences of the phrase; l and r: those of its two parts at
    the cut that scores least, the first such cut; score: floor(2,000,000 a / (l + r)); n: all
    words of the language. A phrase needs `least` occurrences, and goes if a longer phrase of
    as many, whose words hold its own, has at least INSIDE percent of them. Ranks go by score,
    occurrences, and the bytes of the phrase.

    A null text is empty, a null lang is `und`; repeated rows count each; an empty table, or
    one without such phrases, gives no rows; other columns are ignored. Counts are exact.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_word_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = materialise(counted.where(f"word is null or n >= {least}"), "words")
    words = counted.where("word is not null")
    size, many = words.agg(F.coalesce(F.sum(F.length("word") + F.length("lang")), F.lit(0)), F.count("*")).first()
    if size <= dictionary_bytes:
        rows = sorted((r["lang"], bytes(r["word"]), r["n"]) for r in words.collect())
        width = max(1, (many.bit_length() + 7) // 8)
        ids: dict = {}
        for i, (lang, w, _) in enumerate(rows, 1):
            ids.setdefault(lang, {})[w] = i
        known = spark.createDataFrame(
            pa.table({"lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.binary()), "n": pa.array([r[2] for r in rows], pa.int64()),
                      "id": pa.array([i.to_bytes(width, "big") for i in range(1, many + 1)], pa.binary())})
        )
        keys = _key_counts(spark.sparkContext.broadcast(ids), width)
    else:
        width = 16
        known = words.mapInArrow(_digests, "lang string, word binary, n long, id binary")
        keys = _key_counts(None, width)
    known = materialise(known, "dictionary")
    runs = materialise(texts.mapInArrow(keys, "key binary, n long"), "runs")  # written: the bounds of the ranges are sampled from it
    ranged = runs.repartitionByRange("key").sortWithinPartitions("key")
    phrases = ranged.mapInArrow(_run_lengths(width, least), "phrase binary, n long").groupBy("phrase").agg(F.sum("n").alias("n"))
    counts = materialise(known.select(F.col("id").alias("phrase"), "n").union(phrases.where(f"n >= {least}")), "phrases")

    def part(start: str, length: str):
        return F.expr(f"substring(phrase, {width} * ({start}) + 1, {width} * ({length}))")

    several = counts.withColumn("words", F.expr(f"cast(length(phrase) / {width} as int)")).where("words > 1")
    if width == 16:  # ids of words below the least count are unknown: no frequent phrase holds one
        several = several.where(F.col("n") >= least)
    wide = "decimal(20,0)"
    of = lambda name: counts.select(F.col("phrase").alias(name), F.col("n").alias("n_" + name))
    cuts = several.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "phrase", "words", "n", "k", part("0", "k").alias("left"), part("k", "words - k").alias("right")
    )
    scored = cuts.join(of("left"), "left").join(of("right"), "right").select(
        "phrase", "words", F.col("n").alias("a"),
        F.struct(
            F.expr(f"(2000000BD * cast(n as {wide})) div (cast(n_left as {wide}) + cast(n_right as {wide}))").alias("score"),
            "k", F.col("n_left").alias("l"), F.col("n_right").alias("r"),
        ).alias("cut"),
    )
    best = scored.groupBy("phrase").agg(F.min("cut").alias("cut"), F.first("a").alias("a"), F.first("words").alias("words"))
    inner = (
        several.where("words > 2")
        .withColumn("m", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("at", F.explode(F.expr("sequence(0, words - m)")))
        .select(part("at", "m").alias("phrase"), F.col("n").alias("longer"))
        .groupBy("phrase")
        .agg(F.max("longer").alias("longer"))
    )
    free = best.join(inner, "phrase", "left").where(f"longer is null or 100BD * cast(longer as {wide}) < {INSIDE}BD * cast(a as {wide})")
    spelt = (
        free.select("phrase", "words", "a", "cut", F.explode(F.expr("sequence(0, words - 1)")).alias("at"))
        .withColumn("id", part("at", "1"))
        .join(known.select("id", "lang", "word"), "id")
        .groupBy("phrase")
        .agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("cut").alias("cut"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .select("lang", "a", "cut.*", F.array_join(F.transform("spelt", lambda w: w["word"].cast("string")), " ").alias("text"))
    )
    # decoding bytes keeps their order: strings compare by UTF-8
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text"))).where(F.col("rank") <= top)
    totals = counted.where("word is null").select("lang", F.col("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language of documents."""
    return collocations(table(spark, sf_dir, "documents"))


_GRAMS = "\n  union all ".join(
    f"select lang, {k} as words, {' || chr(32) || '.join(f'w[i + {j}]' if j else 'w[i]' for j in range(k))} as phrase from (select lang, w, unnest(range(1, len(w) + {2 - k})) as i from pieces)"
    for k in range(1, LONGEST + 1)
)
OP13_SQL = rf"""
with pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)),
grams as ({_GRAMS}),
totals as (select lang, count(*) as n from grams where words = 1 group by lang),
counts as (select lang, words, phrase, count(*) as f from grams group by all having count(*) >= {LEAST}),
cand as (select *, string_split(phrase, ' ') as w from counts where words > 1),
cuts as (select lang, phrase, words, f, unnest(range(1, words)) as k, w from cand),
scored as (select c.lang, c.phrase, c.words, c.f as a, c.k, l.f as l, r.f as r, (2000000::hugeint * c.f) // (l.f + r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.k], ' ') join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(f) as longer from (
    select *, unnest(range(1, words - m + 2)) as i from (select *, unnest(range(2, words)) as m from cand)) group by 1, 2),
free as (select b.* from best b left join inside i using (lang, phrase) where longer is null or 100::hugeint * longer < {INSIDE}::hugeint * a)
select f.lang, row_number() over (partition by f.lang order by score desc, a desc, f.phrase) as rank, f.phrase, a, l, r, n, cast(score as bigint) as score
from free f join totals t on t.lang = f.lang qualify rank <= {TOP}
"""
