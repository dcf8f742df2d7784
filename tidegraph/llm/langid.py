"""Language identification (operator 9): bit-sliced Bloom filters of character n-grams.

Every cell of the filter holds one bit per language, so one look-up (the AND of K cells)
returns the set of all languages that contain an n-gram. A document counts, per language,
the n-grams whose set has it; the counts are corrected for the filter's false positives, and
the largest decides. A slice of the filter has as many cells as the n-grams kept for its
languages need: no language fills more than about half of them (false positives about 1/8).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import materialise, table

N = 4
#: Cells of a slice at least, and look-ups per n-gram.
CELLS_LOG2, K = 20, 3
#: A language contains an n-gram that enough of its texts have, at this share at least of the rate
#: of the language that uses it most. Enough is LEAST_COUNT, or less by one for 16 and by two for
#: 8 texts (see _enough), or one in RARE of all texts of the language where that is more: what is kept
#: of a language then has a bound, the mean number of n-grams in a text times RARE.
LEAST_COUNT, SHARE, RARE = 3, 0.25, 100_000
#: Settings that keep all n-grams of all texts.
EXACT = {"least": 1, "share": 0.0, "rare": None}
#: Languages in one slice of the filter: as many as a long has safe bits.
SLICE = 62
#: Characters that are looked at together, and different n-grams that a task holds before it hands on its counts.
PIECE, HELD = 1 << 20, 1 << 22
#: Cells that come to the driver at once.
READ = 1 << 22
UNDETERMINED = "und"
_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool))
    return _LETTER[0]


def _pieces(texts):
    """Lists of (row, text) of about PIECE characters together; long texts are cut, with N - 1 characters of overlap."""
    held, size = [], 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for i in range(0, len(text), PIECE):
            part = text[i : i + PIECE + N - 1]
            # the ends of a text count as non-letters
            part = ("\0" if i == 0 else "") + part + ("\0" * (N - 1) if i + PIECE >= len(text) else "")
            if held and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((row, part))
            size += len(part)
    if held:
        yield held


def _grams(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams whose inner characters are letters, the row of each, and rows with any letter."""
    rows = np.array([r for r, _ in parts])
    sizes = np.array([len(p) for _, p in parts])
    codes = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    owner = np.repeat(rows, sizes)
    ends = np.cumsum(sizes)
    c = np.where(letter, codes, 0).astype(np.uint64)
    x = np.zeros(max(0, len(c) - N + 1), np.uint64)
    for i in range(N):
        x += c[i : len(c) - N + 1 + i] * _MUL[i]
    ok = letter[1 : len(x) + 1] & letter[2 : len(x) + 2]
    for e in ends[:-1]:  # no n-gram over the end of a part
        ok[max(0, e - N + 1) : e] = False
    x = x[ok]
    x ^= x >> np.uint64(32)
    x *= _MUL[0]
    x ^= x >> np.uint64(29)
    return x, owner[: len(ok)][ok], owner[letter]


def _enough(texts: int, least: int = LEAST_COUNT, rare: int | None = RARE) -> int:
    """How many texts of a language must have an n-gram: `least`, but 1 below 8 texts and 2 below 16, or one in `rare` of all."""
    return max(min(least, 1 + texts // 8), -(-texts // rare) if rare else 1)


def _size(kept: int) -> int:
    """Cells of a slice whose largest language keeps so many n-grams: at most half of them get its bit."""
    return max(1 << CELLS_LOG2, math.ceil(K * kept / math.log(2)))


def _cells(x: np.ndarray, size):
    """The K cells of each hash; size, below 2^32, is one number or one for each hash."""
    size = np.asarray(size, np.uint64)
    return [((x * _MUL[i] >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64) for i in range(K)]


def _count(batches):
    """(lang, gram, n) of a partition: n of its texts have the n-gram; a null gram counts all texts.

    Counting texts, however long, keeps one with a wrong label from speaking for its language.
    Rows may come in several portions, which add up: a task holds about HELD n-grams at most.
    """
    have: dict[str, list] = {}
    seen: Counter = Counter()

    def add(lang, keys, n):
        have.setdefault(lang, []).append((keys, n))
        if len(have[lang]) > 8:
            fold(lang)

    def fold(lang):
        parts = have[lang]
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        have[lang] = [(keys, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64))]

    def portions():
        for lang in have:
            fold(lang)
            keys, n = have[lang][0]
            for i in range(0, len(keys), PIECE // 8):
                k = keys[i : i + PIECE // 8].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(n[i : i + PIECE // 8])], names=["lang", "gram", "n"]
                )
        have.clear()

    for b in batches:
        by: dict[str, list] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            seen[lang] += len(texts)
            for text in (t for t in texts if len(t) > PIECE):
                keys = np.empty(0, np.uint64)
                for parts in _pieces([text]):
                    keys = np.union1d(keys, _grams(parts)[0])
                add(lang, keys, np.ones(len(keys), np.int64))
            for parts in _pieces([t for t in texts if len(t) <= PIECE]):
                x, owner, _ = _grams(parts)
                once = np.unique(x + owner.astype(np.uint64) * _MUL[3], return_index=True)[1]
                add(lang, *np.unique(x[once], return_counts=True))
            if sum(len(k) for parts in have.values() for k, _ in parts) > HELD:
                yield from portions()
    none = pa.array([None] * len(seen), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), none, pa.array(list(seen.values()), pa.int64())], names=["lang", "gram", "n"])
    yield from portions()


def _bits(sizes):
    """(cell, slice, bits): where each n-gram is put down."""
    sizes = np.array(sizes, np.uint64)

    def run(rows):
        for b in rows:
            x, part, bits = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = np.concatenate(_cells(x.view(np.uint64), sizes[part]))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(part, K)), pa.array(np.tile(bits, K))], names=["cell", "slice", "bits"])

    return run


def learn(labelled: DataFrame, least: int = LEAST_COUNT, share: float = SHARE, rare: int | None = RARE) -> dict:
    """The filter of all rows of (lang, text) with a lang: langs, cells of each slice, and each language's false positives.

    Which n-grams a language has: those of `least` of its texts (see _enough), at `share` of the
    highest rate. EXACT keeps every n-gram of every text: the filter then returns all languages
    that contain an n-gram, and grows with all of them. It is made on the driver and held by
    every worker: cells of 8 bytes (1 for up to 8 languages), 4.33 for each n-gram kept of a
    slice's largest language, so 50 million n-grams kept of one of eight languages are 217 MB.
    """
    counts = labelled.where("lang is not null and text is not null").select("lang", "text").mapInArrow(
        _count, "lang string, gram long, n long"
    )
    counts = materialise(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sums = counts.groupBy("lang").agg(F.sum(F.when(F.col("gram").isNotNull(), F.col("n"))).alias("n"), F.sum(F.when(F.col("gram").isNull(), F.col("n"))).alias("texts"))
    found = [r for r in sums.collect() if r["n"]]
    totals, texts = {r["lang"]: r["n"] for r in found}, {r["lang"]: r["texts"] for r in found}
    langs = sorted(totals)
    cells = []
    if langs:
        known = [(x, float(totals[x]), _enough(texts[x], least, rare), i // SLICE, 1 << i % SLICE) for i, x in enumerate(langs)]
        of = labelled.sparkSession.createDataFrame(known, "lang string, total double, least long, slice int, bit long")  # one row a language
        # One text less in the highest rate: what a single text of a small language has takes nothing from the others.
        rated = counts.where("gram is not null").join(of, "lang").select("gram", "n", "least", (F.col("n") / F.col("total")).alias("rate"), ((F.col("n") - 1) / F.col("total")).alias("sure"), "slice", "bit")
        most = rated.groupBy("gram").agg(F.collect_list(F.struct("n", "least", "rate", "slice", "bit")).alias("of"), F.max("sure").alias("top"))
        used = most.select("gram", F.filter("of", lambda x: (x["n"] >= x["least"]) & (x["rate"] >= share * F.col("top"))).alias("of"))
        sets = used.select("gram", F.explode(F.array_distinct(F.transform("of", lambda x: x["slice"]))).alias("slice"), "of").select(
            "gram",
            "slice",
            F.aggregate(
                F.filter("of", lambda x: x["slice"] == F.col("slice")),
                F.lit(0).cast("long"),
                lambda acc, x: acc.bitwiseOR(x["bit"]),
            ).alias("bits"),
        )
        sets = materialise(sets, "kept")
        kept = sets.groupBy("slice").agg(*(F.sum(F.shiftright("bits", i).bitwiseAND(F.lit(1))) for i in range(min(SLICE, len(langs))))).collect()
        kept = {r[0]: max(r[1:]) for r in kept}
        sizes = [_size(kept.get(i, 0)) for i in range(-(-len(langs) // SLICE))]
        put = sets.mapInArrow(_bits(sizes), "cell long, slice int, bits long").groupBy("cell", "slice").agg(F.bit_or("bits").alias("bits"))
        put = materialise(put, "cells")
        for part, size in enumerate(sizes):
            width = next(w for w in (8, 16, 32, 64) if min(SLICE, len(langs) - part * SLICE) <= w)
            cells.append(np.zeros(size, f"uint{width}"))
            for low in range(0, size, READ):  # a bounded part at once comes to the driver
                rows = put.where((F.col("slice") == part) & F.col("cell").between(low, low + READ - 1)).select("cell", "bits").toArrow()
                cells[part][rows.column(0).to_numpy()] = rows.column(1).to_numpy().astype(cells[part].dtype)
    filled = [float((cells[i // SLICE] >> i % SLICE & 1).mean()) for i in range(len(langs))]
    common = max(langs, key=lambda x: (totals[x], x), default=UNDETERMINED)
    return {"langs": langs, "cells": cells, "false": [s**K for s in filled], "common": common}


def _predictor(model):
    def run(batches):
        m = model.value
        langs, cells, false = m["langs"], m["cells"], np.array(m["false"])
        for b in batches:
            texts = b.column(2).to_pylist()
            n, hits, letters = np.zeros(len(texts)), np.zeros((len(texts), len(langs))), np.zeros(len(texts), bool)
            for parts in _pieces(texts):
                x, owner, lettered = _grams(parts)
                letters[lettered] = True
                if len(x):
                    n += np.bincount(owner, minlength=len(texts))
                    for part, own in enumerate(cells):
                        at = _cells(x, len(own))
                        sets = own[at[0]]
                        for a in at[1:]:
                            sets &= own[a]
                        for i in range(part * SLICE, min(len(langs), (part + 1) * SLICE)):
                            hits[:, i] += np.bincount(owner[(sets >> i % SLICE & 1).astype(bool)], minlength=len(texts))
            if langs:
                right = np.clip((hits - false * n[:, None]) / (1 - false + 1e-12), 0, None)
                best, top = right.argmax(axis=1), right.max(axis=1)
                score = np.where(n > 0, np.clip(top / np.maximum(n, 1), 0, 1), 0.0)
                pred = [langs[i] if t > 0 else m["common"] for i, t in zip(best, top, strict=True)]
            else:
                score, pred = np.zeros(len(texts)), [m["common"]] * len(texts)
            pred = [p if ok else UNDETERMINED for p, ok in zip(pred, letters, strict=True)]
            score = np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array(pred, pa.string()), pa.array(score)], names=[*b.schema.names[:2], "lang_pred", "score"]
            )

    return run


def held_out():
    """crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text. settings: see learn.

    Learned from all rows with text, lang and doc_id that are not held out. A null text, or
    one without any letter, is `und` with score 0; so is everything if nothing can be
    learned. A text whose n-grams no language has gets the most common learned language with
    score 0. Ties go to the first language by name. Repeated rows give repeated rows; other
    columns are ignored. Each slice of 62 languages has 2^20 cells (8 bytes each, 1 for up to 8
    languages), or 4.33 for each n-gram of its largest language where that is more; what is
    kept of a language grows with its vocabulary, not with the number of texts (see RARE). A
    language of a few texts has all their n-grams.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(learn(d.where("doc_id is not null").where(~held_out()), **settings))
    return d.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _predictor(model), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def with_language(docs: DataFrame) -> DataFrame:
    """docs with lang replaced by the predicted language; rows that are `und` go. Columns stay as they are."""
    d = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(learn(d.where("doc_id is not null").where(~held_out())))
    at = docs.columns.index("text")
    names = docs.columns
    predict = _predictor(model)

    def run(batches):
        for b in batches:
            text = b.column(at).cast(pa.string())
            view = pa.RecordBatch.from_arrays([text, text, text], names=["a", "b", "c"])
            pred = next(predict([view])).column(2)
            lang = names.index("lang")
            b = b.set_column(lang, b.schema.field(lang), pred.cast(b.schema.field(lang).type))
            yield b.filter(pa.compute.not_equal(pred, UNDETERMINED))

    return docs.mapInArrow(run, docs.schema)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document."""
    return identify(table(spark, sf_dir, "documents"))
