"""Hard negatives, b-bit MinHash and collocations against brute force on small tables with every odd case."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidegraph.llm import collocations, minhash, negatives

VECTORS = "vec_id long, embedding array<float>, label int, pivot int, copies long, score double"
DOCS = "doc_id long, text string, lang string, n long, name string, key long"


# --- hard negatives


def slow_negatives(rows):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        kept.append((i, label, [max(-(1 << 27), min(1 << 27, math.floor(256 * float(np.float32(x))))) for x in v]))
    out = []
    for a, (i, label, v) in enumerate(kept):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, own) for b, (j, own, w) in enumerate(kept) if b != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            some = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, p, r, x[1], -s, -x[0]) for r, x in enumerate(some, 1)]
    return sorted(out)


def vectors(n=400, size=6, seed=1):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 0.5) for _ in range(size)], r.randrange(4)) for i in range(n)]
    base = rows[3][1]
    rows += [(1000 + i, base, i % 3) for i in range(60)]  # a group of copies, with anchors among them
    rows += [
        (2000, None, 1), (2001, [0.1] * size, None), (2100, [None] * size, 1), (2002, [float("nan")] * size, 1), (2003, [float("inf")] + [0.0] * (size - 1), 2), (2200, [0.0] * size, 1),
        (2004, [1e30] * size, 1), (2300, [-1e30] * size, 1), (2005, [0.5], 2), (2006, [], 2), (2400, [], 3), (None, [0.2] * size, 1), (100, rows[100][1], rows[100][2]), (2500, [0.3] * size, -1), (-100, [0.4] * size, 0),
        (1100, base, 2), (1100, base, 2),
    ]
    return rows


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*x, 0, 1, 0.0) for x in rows], VECTORS).repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **more).collect())


def test_negatives_match_brute_force_on_odd_rows(spark):
    want = slow_negatives(vectors())
    assert len(want) > 60
    assert mined(spark, vectors()) == want


def test_negatives_with_several_pivots_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_A_PIVOT", 40)
    rows = vectors(300, 3, seed=5)
    assert mined(spark, rows, block=16) == slow_negatives(rows)


@pytest.mark.parametrize("rows", [[], [(100, None, None)], [(100, [1.0], 1)], [(100, [], 1), (1, [], 1), (2, [], 2)], [(7, [1.0], 1), (8, [1.0], 2)]])
def test_negatives_of_tiny_tables(spark, rows):
    assert mined(spark, rows) == slow_negatives(rows)


def test_search_leaves_out_far_cells(spark, monkeypatch):
    """Two tight clusters: rows of the other one are never multiplied."""
    r = random.Random(2)
    rows = [(i, [(1.0 if i % 2 else -1.0) + r.gauss(0, 0.01), r.gauss(0, 0.01)], i // 2 % 2) for i in range(600)]
    monkeypatch.setattr(negatives, "ROWS_A_PIVOT", 100)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plans = []
    whole = negatives.materialise
    monkeypatch.setattr(negatives, "materialise", lambda d, name: plans.append((name, whole(d, name))) or plans[-1][1])
    assert sorted(tuple(x) for x in negatives.hard_negatives(df).collect()) == slow_negatives(rows)
    cells = next(d for n, d in plans if n == "blocks").select("pivot", "cell").distinct().count()
    read = {tuple(r) for n, d in plans if n == "plan" for r in d.where("now").select("pivot", "cell").collect()}
    assert 0 < len(read) < cells


def test_least_score():
    for s in range(-50, 200):
        low = negatives.least_score(s)
        assert 100 * low >= 80 * s > 100 * (low - 1)


# --- b-bit MinHash


def slow_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(w)} if len(w) == 1 else {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}


def slow_groups(rows):
    sets = [slow_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None)))
    return sorted(out, key=repr)


def near_rows(seed=1, groups=12):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.randint(40, 120))
        for _ in range(r.randint(2, 9)):  # edits that leave similarities on either side of the threshold
            words = list(base)
            for _ in range(r.randint(0, 9)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append(" ".join(words))
    drift = r.choices(vocabulary, k=60)
    for i in range(40):  # a chain: neighbours are linked, its ends are not
        drift[i] = r.choice(vocabulary)
        rows.append(" ".join(drift))
    odd = ["", None, " \t\n", "one", "ONE", "one two", "One  two", "Été été", "été été", "x" * 50_000, "a b " * 20_000, "a b", "b a", rows[0], rows[0].upper(), rows[0]]
    ids = r.sample(range(10_000), len(rows) + len(odd))
    out = list(zip(ids, rows + odd, strict=True))
    return out + [(None, rows[1]), (None, None), (ids[0], "another text under one id"), (ids[2], rows[2]), (ids[2], rows[2])]


def grouped(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], DOCS).repartition(3)
    return sorted((tuple(r) for r in minhash.group(df, **more).collect()), key=repr)


def test_minhash_matches_brute_force(spark):
    rows = near_rows()
    assert grouped(spark, rows) == slow_groups(rows)


def test_crowded_buckets_are_compared_block_by_block(spark, monkeypatch):
    """Every pair may be linked, by its estimate, and estimates come strip by strip."""
    monkeypatch.setattr(minhash, "MARGIN", 2.0)
    monkeypatch.setattr(minhash, "HUBS", 1)
    monkeypatch.setattr(minhash, "STRIP", 2)
    rows = near_rows(seed=7, groups=5)
    assert grouped(spark, rows, block=3) == slow_groups(rows)


def test_a_large_group_of_copies_that_are_hardly_alike(spark):
    """Copies of one text with drawn words in place of others: most pairs are under the threshold, the group is one or few components."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(r.randint(0, 8)):
            words[r.randrange(90)] = f"v{r.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    want = slow_groups(rows)
    assert 1 < len({c for _, _, c in want}) < 150
    assert grouped(spark, rows, block=64) == want


def test_full_sets_move_once_for_all_buckets(spark, monkeypatch):
    """Small gangs are dealt by themselves; what may be linked meets in a block, however gangs are dealt."""
    monkeypatch.setattr(minhash, "FEW", 0)
    sets = {bytes([i]): np.arange(5, dtype=np.uint64) + np.uint64(9 * i) for i in range(12)}
    full = spark.createDataFrame([(k, v.tobytes()) for k, v in sets.items()], "name binary, hashes binary")
    gang = lambda i: bytes([i // 6 * 6])
    rows = [(100 * (i // 6) + key, bytes([i]), bytes([i]), 5, left, gang(i)) for i in range(12) for key in range(45) for left in (True, False)]
    partners = spark.createDataFrame(rows, "key long, name binary, root binary, n long, left boolean, chief binary")
    for most, moved in ((30, 12), (10, None)):
        blocks = minhash._tests(partners, full, most).collect()
        met = {(a["name"], b["name"]) for r in blocks for a in r["left"] for b in r["right"]}
        assert {(bytes([i]), bytes([j])) for i in range(12) for j in range(12) if i // 6 == j // 6} <= met
        assert moved is None or sum(len(r["left"]) for r in blocks) == moved


def test_gangs_match_brute_force(spark, monkeypatch):
    """Every pair may be linked, by its estimate, and gangs are dealt by themselves, whole or in blocks."""
    monkeypatch.setattr(minhash, "MARGIN", 2.0)
    monkeypatch.setattr(minhash, "HUBS", 1)
    monkeypatch.setattr(minhash, "FEW", 0)
    rows = near_rows(seed=5, groups=6)
    assert grouped(spark, rows, block=5) == slow_groups(rows)


def test_sets_that_pairs_join_have_one_chief():
    """The pairs are (a0, b2), (a1, b0) and (a1, b2): the first partners alone would leave a0, b2 apart from a1, b0."""
    word = lambda v: np.full(minhash.WORDS, v, np.uint64).tobytes()
    row = lambda name, packed, n: {"name": name, "root": name, "n": n, "packed": word(packed)}
    left = [row(b"a0", 7, 100), row(b"a1", 7, 120), row(b"a2", 7, 1000)]
    right = [row(b"b0", 7, 146), row(b"b1", 7, 5000), row(b"b2", 7, 110)]
    kind = pa.list_(pa.struct([("name", pa.binary()), ("root", pa.binary()), ("n", pa.int64()), ("packed", pa.binary())]))
    batch = pa.RecordBatch.from_arrays([pa.array([left], kind), pa.array([right], kind), pa.array([1])], names=["left", "right", "key"])
    out = pa.Table.from_batches(minhash._partners([batch])).to_pylist()
    assert sorted((r["name"], r["left"], r["n"]) for r in out) == [(b"a0", True, 100), (b"a1", True, 120), (b"b0", False, 146), (b"b2", False, 110)]
    assert len({r["chief"] for r in out}) == 1


def test_minhash_of_an_empty_table(spark):
    assert grouped(spark, []) == []


def test_estimate_is_close_and_unbiased():
    r = np.random.default_rng(4)
    off = []
    for _ in range(300):
        common, rest = r.integers(0, 1 << 63, 800, np.uint64), r.integers(0, 1 << 63, 400, np.uint64)
        x, y = np.concatenate([common, rest[:200]]), np.concatenate([common, rest[200:]])
        off.append(minhash.likeness(minhash.pack(minhash.minima(x)), minhash.pack(minhash.minima(y))) - 800 / 1200)
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < minhash.MARGIN


# --- collocations


def slow_collocations(rows, least, top=2000):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
            found[lang, p] = (*min(cuts), a)
    out = []
    for lang in words:
        kept = []
        for (own, p), (score, k, a) in found.items():
            if own == lang and not any(o == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= 80 * a for (o, q), (_, _, b) in found.items()):
                kept.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def prose(seed=1):
    r = random.Random(seed)
    vocabulary = ["new", "york", "city", "of", "the", "Times", "été", "à", "la", "x\u0001y", " ", "日本", "a"]
    rows = []
    for i in range(120):
        words = [r.choice(["new york", "New York City", "of the", r.choice(vocabulary), r.choice(vocabulary), f"rare{r.randrange(500)}"]) + r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]) for _ in range(r.randint(0, 60))]
        rows.append((r.choice(["en", "en", "fr", None, "und", ""]), "".join(words)))
    return rows + [("en", None), ("en", ""), (None, " .,;\n"), ("de", "one"), ("en", rows[0][1]), ("en", rows[0][1]), ("long", "again and again, " * 3000 + "word " * 3000)]


def collocated(spark, rows, **more):
    df = spark.createDataFrame([(i, t, lang, 1, "y", 2) for i, (lang, t) in enumerate(rows)], DOCS).repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(df, **more).collect())


def test_collocations_match_brute_force(spark):
    rows = prose()
    want = slow_collocations(rows, 8)
    assert len(want) > 50
    assert collocated(spark, rows, least=8) == want


def test_collocations_without_a_common_dictionary(spark):
    rows = prose(2)
    assert collocated(spark, rows, least=5, dictionary_bytes=0) == slow_collocations(rows, 5)


def test_small_portions_ranges_and_tops(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_KEYS", 37)
    monkeypatch.setattr(collocations, "HELD_WORDS", 5)
    rows = prose(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert collocated(spark, rows, least=6, top=9) == slow_collocations(rows, 6, 9)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("rows", [[], [(None, None)], [("en", "a b"), ("en", "a b")]])
def test_collocations_of_tiny_tables(spark, rows):
    assert collocated(spark, rows, least=2) == slow_collocations(rows, 2)


def test_radix_order_is_stable():
    r = np.random.default_rng(3)
    columns = [r.integers(0, m, 5000).astype(np.uint32) for m in (3, 100_000, 7)]
    assert (collocations.radix_order(columns) == np.lexsort(columns[::-1])).all()
