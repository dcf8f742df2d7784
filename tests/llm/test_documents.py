"""Operators on documents against brute force, on a small table with every odd case."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from tidegraph.llm import bpe, langid, mixing, pii, simhash, sketch

ODD = "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id long, run string, copy int, spans string"


def odd_rows():
    r = random.Random(3)
    word = {"en": "the of and tion here with".split(), "fr": "les que dans eau une été".split()}
    rows, n = [], 0
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        text = " ".join(r.choice(word[lang]) + r.choice(["", "s", "er"]) for _ in range(r.randint(20, 60)))
        rows.append((i * 3, text, lang, f"s{i % 3}", len(text)))
    base = rows[5][1]
    extra = [
        (1, None, None, None, None), (2, "", "en", "s0", 0), (4, " \n\t", None, None, 3), (5, "word", "en", "s1", 4), (7, "ÉTÉ mail me at a.b@c.de or +1 (555) 123-4567, 4539 1488 0343 6467, 10.0.0.1 token = \"0123abcd4567ef89aa\"", "en", "s1", 90),
        (400, base, "en", "s2", 1), (401, base, "en", "s2", 1), (402, base + " x", "en", "s2", 1), (403, (base + " ") * 400, "fr", "s2", 1), (404, "x" * 30_000, "en", "s0", 1), (405, "12345 67890", "fr", "s0", 1),
        (6, "same row", "en", "s1", 8), (6, "same row", "en", "s1", 8), (None, "no id here", "en", "s1", 9), (8, "a<|endoftext|>b Σ", "en", "s9", 1),
    ]
    n += 1
    return [(*x, "f", -1, "r", -1, "s") for x in rows + extra]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


def texts():
    return [(r[0], r[1] or "") for r in odd_rows()]


def slow_fingerprint(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_kept(fps):
    """The smallest id of every component; one id may stand for several."""
    roots = {}
    for (i, f), low in zip(fps, slow_components(fps), strict=True):
        group = {f}
        while more := {g for _, g in fps if any((g ^ x).bit_count() <= 2 for x in group)} - group:
            group |= more
        roots[min(group)] = low
    return sorted(roots.values())


def slow_components(fps):
    """fps: list of (id, fingerprint)."""
    low = {f: min((i for i, g in fps if g == f and i is not None), default=None) for _, f in fps}
    group = {f: {f} for f in low}
    for a in low:
        for b in low:
            if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    return [min((low[g] for g in group[f] if low[g] is not None), default=None) for _, f in fps]


def test_simhash_matches_brute_force(docs):
    got = simhash.group(docs).select("doc_id", "fp", "component_id").collect()
    fps = [(i, slow_fingerprint(t)) for i, t in texts()]
    want = [(i, f, c) for (i, f), c in zip(fps, slow_components(fps), strict=True)]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("limit", [4, 64])
def test_links_are_exact_on_both_sides_of_the_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIRWISE", limit)
    r = random.Random(1)
    fps = set()
    for _ in range(6):
        f = r.getrandbits(64)
        for _ in range(40):
            fps.add(f)
            f ^= 1 << r.randrange(64)
            f ^= (1 << r.randrange(64)) if r.random() < 0.5 else 0
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = {r["node"]: r["root"] for r in simhash.connected_components(edges).collect()}
    want = slow_components([(i, x % (1 << 64)) for i, x in enumerate(fps)])
    same = {}
    for i, x in enumerate(fps):
        same.setdefault(want[i], set()).add(got.get(x, x))
    assert all(len(v) == 1 for v in same.values()) and len(same) == len({next(iter(v)) for v in same.values()})


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    fps = [(i, slow_fingerprint(t)) for i, t in texts() if i is not None]
    assert sorted(x for x in ids if x is not None) == slow_kept(fps) and ids.count(None) == 1


def test_keep_one_with_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long, "b"), (5, "quite another text stands here", "a"), (5, long + " x", "a"), (9, long, "z"), (9, "quite another text stands here", "y"), (7, None, "n"), (7, " ", "m"), (None, long, "k")]
    for _ in range(2):
        got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, root string").repartition(3)).collect()
        assert sorted(map(tuple, got), key=str) == sorted([(5, long, "b"), (5, "quite another text stands here", "a"), (7, None, "n"), (None, long, "k")], key=str)
        rows = rows[::-1]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert simhash.group(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert bpe.encode_digests(none).count() == 0 and sketch.fingerprint_with_next(none).count() == 0
    assert pii.find_spans(none).count() == 0 and pii.redact(none).count() == 0
    assert langid.identify(none).count() == 0 and langid.with_language(none).count() == 0
    assert mixing.replicate(none).count() == 0


def test_bpe_is_the_library(docs):
    t = Tokenizer.from_file(bpe.default_vocabulary())
    want = []
    for i, text in texts():
        e = t.encode(text, add_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(e.ids), sha(" ".join(map(str, e.ids))), sha(t.decode(e.ids, skip_special_tokens=False))))
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, bpe.encode_digests(docs).collect()), key=key) == sorted(want, key=key)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_ids(docs.where("doc_id = 8")).collect()}
    assert ids[8] == t.encode("a<|endoftext|>b Σ", add_special_tokens=False).ids


def test_bpe_on_random_strings():
    t, b = Tokenizer.from_file(bpe.default_vocabulary()), bpe.WordBpe(open(bpe.default_vocabulary()).read())
    r = random.Random(5)
    pool = "aAbBeéÉñßΣσİıſ'sStvVdm0９½²\t\n\x0b\x1c\x85 　̧́日本!?.<|>_-🎉‍"
    for _ in range(2000):
        s = "".join(r.choice(pool) for _ in range(r.randint(0, 30)))
        e = t.encode(s, add_special_tokens=False)
        assert b.encode(s) == (" ".join(map(str, e.ids)), t.decode(e.ids, skip_special_tokens=False), len(e.ids)), s


def slow_sketch(t):
    """Hashes of five-word shingles in whole numbers; those under a quarter of 48 bits, or the smallest."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t).encode())
    odd = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
    k, out = min(5, len(words)), set()
    for i in range(len(words) - k + 1 if words else 0):
        x = sum(xxhash.xxh64_intdigest(w) * o for w, o in zip(words[i : i + k], odd, strict=False)) % (1 << 64)
        x = (x ^ (x >> 32)) * odd[0] % (1 << 64)
        out.add(((x ^ (x >> 29)) * odd[1] % (1 << 64)) >> 16)
    return sorted(x for x in out if x < 1 << 46) or sorted(out)[:1]


def slow_likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def in_order(rows):
    h = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, signed(h(x[1])), x[1]))


def test_heavy_ids_are_cut_into_runs(spark, monkeypatch):
    monkeypatch.setattr(sketch, "HEAVY_RUNS", 1)
    monkeypatch.setattr(sketch, "RUN_ROWS", 8)
    r = random.Random(9)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 30)))) for i in range(300)] + [(8, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = in_order(rows)
    want = sorted((i or -1, hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest(), slow_likeness(slow_sketch(t), slow_sketch(n))) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True))
    got = [(x["doc_id"] or -1, x["edited_sha256"], x["near_next"]) for x in sketch.fingerprint_with_next(d).collect()]
    assert sorted(got) == want


def test_sketch_and_next_document(docs):
    got = {}
    for r in sketch.fingerprint_with_next(docs).collect():
        got.setdefault((r["doc_id"], r["n_chars"]), []).append(r)
    order = in_order(texts())
    assert sum(map(len, got.values())) == len(order)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        sha = hashlib.sha256(e.encode()).hexdigest()
        row = next(r for r in got[(i, len(t))] if r["edited_sha256"] == sha)
        got[(i, len(t))].remove(row)
        a, b, c = slow_sketch(t), slow_sketch(e), slow_sketch(nxt)
        assert row["fingerprint"] == "".join(f"{x:012x}" for x in a) and row["edited_fingerprint"] == "".join(f"{x:012x}" for x in b)
        assert (row["near_edited"], row["near_next"]) == (slow_likeness(a, b), slow_likeness(a, c))


def test_sketch_estimates_and_merges():
    r = random.Random(2)
    w = [str(r.random()) for _ in range(8000)]
    a, b = sketch.sketch(" ".join(w[:6000])), sketch.sketch(" ".join(w[2000:]))
    assert abs(sketch.likeness(a, b) - 0.5) < 0.05 and abs(sketch.containment(a, b) - 4 / 6) < 0.05
    assert abs(sketch.containment(sketch.sketch(" ".join(w[:400])), a) - 1) < 0.02
    assert (sketch.from_string(sketch.to_string(a)) == a).all()
    assert sketch.likeness(sketch.merged(a, b), sketch.sketch(" ".join(w))) > 0.98


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_base(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    ok = {
        "email": lambda s: True, "ip": lambda s: all(int(p) < 256 for p in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, t) if ok[k](m[0])] for k, p in BASE.items()}


def test_base_spans_on_random_strings():
    r = random.Random(0)
    for _ in range(20000):
        t = "".join(r.choice("a@.b1234567890 -+()%é@@..") for _ in range(r.randint(0, 40)))
        assert slow_base(t) == pii.base_spans(t), t


def test_find_spans_and_redact(docs):
    rows = {r["doc_id"]: r for r in pii.find_spans(docs.where("doc_id is not null")).collect()}
    for i, t in texts():
        if i is None:
            continue
        base = slow_base(t)
        written = ",".join(f"{k}:{s}:{e}" for k in pii.BASE for s, e in base[k])
        assert rows[i]["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.BASE] == [len(base[k]) for k in pii.BASE]
    assert rows[7]["n_email"] == 1 and "secret:" in rows[7]["spans"]
    red = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert red[7]["text"].count("[") == 5 and "a.b@c.de" not in red[7]["text"] and red[7]["n_chars"] == len(red[7]["text"])
    assert red[0]["text"] == dict(texts())[0] and red[1]["text"] is None


def found(text):
    return {(k, text[s:e]) for k, s, e, _ in pii.candidates(text, pii.base_spans(text))}


def test_titles_and_long_secrets_are_candidates():
    for text, name in (("Please contact Ms Jones today", "Jones"), ("Signed Mrs Olga Smith", "Olga Smith"), ("see Dr. Who", "Who")):
        assert found(text) == {("name", name)}
    key = "aB3" * 100
    assert found(f"token={key} x") == {("secret", f"token={key}")} and found("b" * 300 + " 1") == set()


def test_overlaps_are_settled_after_the_classifier():
    for text, kind, value in (("customer_ssn=123-45-6789", "ssn", "123-45-6789"), ("phone=555-234-4567", "phone", "555-234-4567")):
        assert found(text) == {(kind, value), ("secret", text)}
        codes = {k: c for k, _, _, c in pii.candidates(text, pii.base_spans(text))}
        at = text.index(value)
        assert pii._all_spans(text, {codes[kind]})[1] == [(kind, at, len(text))]
        assert pii._all_spans(text, set(codes.values()))[1] == [("secret", 0, len(text))]


def slow_em(patterns, rounds=50):
    """Expectation and maximisation by loops, over single candidates' patterns."""
    belief = [[[0.7 * r, 0.3, 0.7 * (1 - r)], [0.7 * (1 - r), 0.3, 0.7 * r]] for r in (0.6, 0.9, 0.75, 0.75, 0.6)]
    like, prior = [[list(x) for x in b] for b in belief], 0.5

    def yes(v):
        no, on = 1 - prior, prior
        for k, x in enumerate(v):
            no, on = no * like[k][0][x + 1], on * like[k][1][x + 1]
        return on / (no + on)

    for _ in range(rounds):
        p = {v: yes(v) for v in patterns}
        prior = min(0.99, max(0.01, sum(n * p[v] for v, n in patterns.items()) / sum(patterns.values())))
        for k in range(5):
            for c in (0, 1):
                seen = [10 * x for x in belief[k][c]]
                for v, n in patterns.items():
                    seen[v[k] + 1] += n * (p[v] if c else 1 - p[v])
                like[k][c] = [x / sum(seen) for x in seen]
    return {v: yes(v) for v in patterns}


SLOW_WIDE = {
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b", "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", "card": BASE["card"], "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}",
    "email": r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]+)+",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.? ([A-Z][a-z]+(?: [A-Z][a-z]+)*)", "given": r"\b(?:" + "|".join(sorted(pii.GIVEN_NAMES)) + r")(?: [A-Z][a-z]+)+(?![a-z])",
}


def slow_candidates(t):
    out = set()
    for kind, pattern in SLOW_WIDE.items():
        for m in re.finditer(pattern, t):
            digits = sum(c in "0123456789" for c in m[0])
            if (kind == "card" and not 13 <= digits <= 19) or (kind == "secret" and (not digits or m[0].isdigit() or m[0].isalpha())):
                continue
            out.add(("name" if kind == "given" else kind, *m.span(1 if kind == "name" else 0)))
    base = [x for spans in slow_base(t).values() for x in spans]
    return {(k, s, e) for k, s, e in out if not any(a < e and s < b for a, b in base)}


def personal_texts():
    r = random.Random(12)
    words = "the people of town wrote that rain fell on old stones again".split()
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    token = lambda n: "".join(r.choice("abcdef0123456789ABCDEF") for _ in range(n))

    def card(n=16):
        d = "4" + digits(n - 2)
        return d + next(c for c in "0123456789" if pii.luhn(d + c))

    makers = [
        lambda: f"phone {r.randint(200, 999)}-{r.randint(200, 999)}-{digits(4)}", lambda: f"call ({r.randint(200, 999)}) {r.randint(200, 999)}-{digits(4)}", lambda: f"ssn {r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}",
        lambda: f'token = "{token(40)}"', lambda: f"api_key={token(r.randint(300, 900))}", lambda: f"row {card()[:15]}", lambda: f"card {card(13)} with", lambda: f"mail jo{digits(2)} [at] example [dot] org", lambda: f"Dear Mrs {r.choice('Olga Marta Petra'.split())} Smith",
        lambda: f"{r.choice('John Mary Peter'.split())} {r.choice('Miller Brown Fisher'.split())}", lambda: "IBAN DE89 3704 0044 0532 0130 00", lambda: f"order {digits(3)}-{digits(2)}-{digits(5)}", lambda: f"IBAN DE{digits(2)} 3704 0044 0532 0130 00",
        lambda: f"mail a{digits(2)}@example.org", lambda: f"at 10.0.{r.randint(0, 255)}.7", lambda: f"number {digits(14)}",
    ]
    return [" ".join(r.choice(makers)() if r.random() < 0.15 else r.choice(words) for _ in range(40)) for _ in range(250)]


def test_spans_against_a_slow_version(spark):
    """Candidates by plain patterns, probabilities by loops, the classifier's decision, overlaps by a scan: the query's spans."""
    texts = personal_texts()
    codes = {t: {x: pii._code(x[0], t, x[1], x[2]) for x in slow_candidates(t)} for t in texts}
    counts = {}
    for of in codes.values():
        for c in of.values():
            counts[c] = counts.get(c, 0) + 1
    votes = {c: tuple(map(int, c.split("|")[1].split(","))) for c in counts}
    soft = {}
    for kind in pii.KINDS:
        own = [c for c in counts if c.startswith(kind + "|")]
        patterns = {}
        for c in own:
            patterns[votes[c]] = patterns.get(votes[c], 0) + counts[c]
        p = slow_em(patterns) if own else {}
        like, prior = pii.reliabilities(patterns) if own else (None, None)
        for v in patterns:
            assert abs(pii.posterior(np.array([v]) + 1, like, prior)[0] - p[v]) < 1e-9
        soft |= {c: p[votes[c]] for c in own}
    x, y, n = np.array([pii._features(c) for c in counts]), np.array([soft[c] for c in counts]), np.sqrt(np.array([counts[c] for c in counts], float))
    w = np.zeros(x.shape[1])
    for _ in range(20_000):  # plain gradient descent on the same loss
        w -= 0.5 * (x.T @ (n * (1 / (1 + np.exp(-x @ w)) - y)) + 0.1 * w) / n.sum()
    q = dict(zip(counts, 1 / (1 + np.exp(-x @ w)), strict=True))
    got = {r["doc_id"]: r["spans"] for r in pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sure = 0
    for i, t in enumerate(texts):
        if any(abs(q[c] - 0.5) < 0.02 for c in codes[t].values()):
            continue
        sure += 1
        more, end = [], 0
        for k, s, e in sorted((x for x, c in codes[t].items() if q[c] > 0.5), key=lambda x: (x[1], -x[2], x[0])):
            if s >= end:
                more.append((k, s, e))
                end = e
        base = [(k, *x) for k, spans in slow_base(t).items() for x in spans]
        assert got[i] == ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(base + more, key=lambda x: (pii.KINDS.index(x[0]), x[1]))), t
    assert sure > 200
    whole = "\n".join(f"{x[0]} {t[x[1]:x[2]]}" for i, t in enumerate(texts) for x in [(y.split(":")[0], *map(int, y.split(":")[1:])) for y in got[i].split(",") if y])
    assert "ssn " in whole and "secret token" not in whole and "name John" in whole and "[at]" in whole and len(max(re.findall("[0-9a-fA-F]+", whole), key=len)) > 500
    cards = re.findall("^card ([0-9]+)$", whole, re.M)
    assert np.mean([pii.luhn(x) for x in cards]) > 0.8 and len(cards) > 20


def test_many_spans_in_one_text_are_read_in_linear_time():
    import time

    took = []
    for n in (2_000, 20_000):
        t = "10.0.0.1 a [at] b [dot] org 555-234-4567 Mr John Smith " * n
        start = time.process_time()
        assert len(pii.candidates(t, pii.base_spans(t))) == 4 * n - n
        took.append(time.process_time() - start)
    assert took[1] < 30 * took[0] + 0.5


def test_em_finds_the_better_labeler():
    r = random.Random(4)
    seen = {}
    for _ in range(4000):
        truth = r.random() < 0.4
        v = tuple((1 if truth else -1) * (1 if r.random() < p else -1) for p in (0.95, 0.9, 0.6))
        seen[v] = seen.get(v, 0) + 1
    like, prior = pii.reliabilities(seen)
    assert like[0, 1, 2] > like[2, 1, 2] + 0.2 and abs(prior - 0.4) < 0.1


def test_language_identification(docs):
    got = {(r["doc_id"], r["held_out"]): r for r in langid.identify(docs).collect()}
    for (i, held), r in got.items():
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    rows = {r[0]: r for r in odd_rows()}
    pred = {i: r["lang_pred"] for (i, _), r in got.items()}
    assert pred[1] == pred[2] == pred[4] == pred[405] == "und" and pred[404] in ("en", "fr")
    held = [i for (i, h) in got if h and i % 3 == 0 and i < 180]
    assert np.mean([pred[i] == rows[i][2] for i in held]) >= 0.9
    out = langid.with_language(docs)
    assert out.columns == docs.columns and out.where("lang = 'und'").count() == 0


def grams(t):
    t = "\0" + t.lower() + "\0\0\0"
    return [tuple(c if c.isalpha() else "\0" for c in t[i : i + 4]) for i in range(len(t) - 3) if t[i + 1].isalpha() and t[i + 2].isalpha()]


def slow_languages(rows):
    """Exact sets of n-grams in place of the filter: share of a text's n-grams that each language has."""
    learned = [(lang, t) for i, t, lang in rows if None not in (i, t, lang) and zlib.crc32(str(i).encode()) % 4 != 2]
    texts, n = {}, {}
    for lang, t in learned:
        texts[lang] = texts.get(lang, 0) + 1
        for g in set(grams(t)):
            n.setdefault(g, {}).setdefault(lang, 0)
            n[g][lang] += 1
    total = {lang: sum(c.get(lang, 0) for c in n.values()) for lang in texts}
    least = {lang: min(3, 1 + k // 8) for lang, k in texts.items()}
    kept = {g: {lang for lang, k in of.items() if k >= least[lang] and k / total[lang] >= 0.25 * max((x - 1) / total[y] for y, x in of.items())} for g, of in n.items()}
    out = {}
    for i, t, _ in rows:
        g = grams(t or "")
        share = {lang: sum(lang in kept.get(x, ()) for x in g) / max(1, len(g)) for lang in sorted(total) if total[lang]}
        out[i, t] = share if any(c.isalpha() for c in t or "") else None
    return out, kept, sorted(x for x in total if total[x])


def test_exact_settings_keep_every_language_of_every_ngram(spark, docs):
    learned = [(lang, t) for i, t, lang in (r[:3] for r in odd_rows()) if i is not None and lang and t is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    has = {}
    for lang, t in learned:
        for g in set(grams(t)):
            has.setdefault(g, set()).add(lang)
    m = langid.learn(docs.where("doc_id is not null").where(~langid.held_out()).select("lang", "text"), **langid.EXACT)
    looked, more = 0, 0
    for g, of in has.items():
        x = langid._grams([(0, "".join(g))])[0]
        if len(x) == 1:
            cells = [m["cells"][0][a][0] for a in langid._cells(x, len(m["cells"][0]))]
            sets = {lang for i, lang in enumerate(m["langs"]) if int(cells[0] & cells[1] & cells[2]) >> i & 1}
            assert of <= sets
            looked, more = looked + 1, more + len(sets - of)
    assert looked > 80 and more <= looked / 50
    assert langid._enough(10**9, **{k: langid.EXACT[k] for k in ("least", "rare")}) == 1
    assert {r["lang_pred"] for r in langid.identify(docs, **langid.EXACT).collect()} >= {"en", "fr", "und"}


def test_languages_against_exact_sets(spark, docs, monkeypatch):
    rows = [r[:3] for r in odd_rows()]
    want, kept, langs = slow_languages(rows)
    m = langid.learn(docs.where("doc_id is not null").where(~langid.held_out()).select("lang", "text"))
    assert m["langs"] == langs
    false = []
    for g, of in kept.items():
        x = langid._grams([(0, "".join(g))])[0]
        if len(x) != 1:  # the window of a lone n-gram has both ends outside
            continue
        at = langid._cells(x, len(m["cells"][0]))
        sets = int(m["cells"][0][at[0]][0] & m["cells"][0][at[1]][0] & m["cells"][0][at[2]][0])
        has = {lang for i, lang in enumerate(langs) if sets >> i & 1}
        assert of <= has
        false.append(has - of)
    assert len(false) > 80 and sum(map(len, false)) <= 2
    by_id = {}
    for r in langid.identify(docs).collect():
        by_id.setdefault(r["doc_id"], r)
    for (i, _), share in want.items():
        r = by_id[i]
        if sum(x == i for x, _ in want) > 1:  # one id with two texts
            continue
        if share is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif max(share.values()):
            best = min(share, key=lambda x: (-share[x], x))
            assert abs(r["score"] - share[best]) < 0.01 and share[r["lang_pred"]] > share[best] - 0.01
    tie = langid.identify(spark.createDataFrame([(i, "abcd efgh", lang) for i, lang in enumerate(["b", "a"] * 20)], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in tie.collect()} == {"a"}


def test_counts_of_long_texts_and_in_portions(spark, monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5 + ["fr"]), pa.array(["abab " * 50, "abab", "abab cdcd", "x", "abab " * 90, "abab"])], names=["lang", "text"])

    def counted():
        out = {}
        for b in langid._count([batch, batch]):
            for r in b.to_pylist():
                out[r["lang"], r["gram"]] = out.get((r["lang"], r["gram"]), 0) + r["n"]
        return out

    whole = counted()
    assert max(n for (_, g), n in whole.items() if g is not None) == 8 and whole["en", None] == 10
    monkeypatch.setattr(langid, "PIECE", 64)
    monkeypatch.setattr(langid, "HELD", 3)
    assert counted() == whole


def test_more_languages_than_one_slice(spark):
    r = random.Random(8)
    rows = []
    for n in range(70):
        letters = [chr(0x4E00 + 20 * n + i) for i in range(20)]
        rows += [(i, "".join(r.choice(letters[:3]) for _ in range(80)), f"l{n:02d}") for i in range(n * 12, n * 12 + 12)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(d).collect()}
    assert len({x[2] for x in rows}) > langid.SLICE and np.mean([got[i] == lang for i, _, lang in rows]) > 0.98


def test_whole_long_texts_are_read(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 64)
    parts = [x for p in langid._pieces(["abcdefgh " * 50, "", None, "xy"]) for x in p]
    n = sum(len(langid._grams([p])[0]) for p in parts)
    monkeypatch.setattr(langid, "PIECE", 1 << 20)
    whole = [x for p in langid._pieces(["abcdefgh " * 50, "", None, "xy"]) for x in p]
    assert n == sum(len(langid._grams([p])[0]) for p in whole) > 300


def cjk(seed, n):
    return "".join(map(chr, np.random.default_rng(seed).integers(0x4E00, 0x9FA5, n)))


def test_languages_with_millions_of_ngrams(spark):
    """Texts half of which are unknown n-grams, and 30 % n-grams of the other language."""
    big = {lang: [cjk(i, 10_000) for i in range(at, at + 150)] for lang, at in (("ja", 0), ("zh", 1000))}
    rows = [(t, lang) for lang, texts in big.items() for t in texts for _ in range(3)]
    m = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert all(x < 0.13 for x in m["false"]) and len(m["cells"][0]) > 4 * 1_490_000
    x = langid._grams([(0, cjk(9999, 200_000))])[0]
    at = langid._cells(x, len(m["cells"][0]))
    sets = m["cells"][0][at[0]] & m["cells"][0][at[1]] & m["cells"][0][at[2]]
    assert all(abs((sets >> i & 1).mean() - m["false"][i]) < 0.01 for i in range(2))
    asked = [(lang, f"{big[lang][i][:43]} {big[other][i][:33]} {cjk(5000 + i, 103)}") for lang, other in (("ja", "zh"), ("zh", "ja")) for i in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in asked])] * 3, names=["a", "b", "text"])
    model = type("Model", (), {"value": m})
    pred = next(langid._predictor(model)([batch])).column(2).to_pylist()
    assert np.mean([p == lang for p, (lang, _) in zip(pred, asked, strict=True)]) > 0.9


def test_language_of_two_texts(spark):
    r = random.Random(5)
    en = [" ".join(r.choice("the of and tion here with when all".split()) for _ in range(40)) for _ in range(60)]
    few = ["mikä tämä on hyvää päivää kaikille", "hyvää yötä kaikille täällä ja siellä"]
    m = langid.learn(spark.createDataFrame([(t, "en") for t in en] + [(t, "fi") for t in few], "text string, lang string"))
    batch = pa.RecordBatch.from_arrays([pa.array(["hyvää iltaa kaikille", "here with the tion"])] * 3, names=["a", "b", "text"])
    assert next(langid._predictor(type("Model", (), {"value": m}))([batch])).column(2).to_pylist() == ["fi", "en"]


def test_enough_texts():
    assert [langid._enough(n) for n in (1, 2, 7, 8, 16, 300_000, 100_000_000)] == [1, 1, 1, 2, 3, 3, 1000]


def test_mixing_matches_poisson(spark):
    n = 3000
    d = spark.range(n).selectExpr("id as doc_id", "'t' as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source", "1 as copy")
    got = mixing.replicate(d, {"hot": 1.0, "s1": 1.0, "s2": 3.0}).selectExpr("doc.doc_id", "doc.source", "copy", "position")
    by = {r["source"]: r["n"] for r in got.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert set(by) == {"hot", "s1", "s2"}
    for s, share in (("hot", 0.2), ("s1", 0.2), ("s2", 0.6)):
        assert abs(by[s] - share * n) < 5 * (share * n * 2) ** 0.5
    assert got.select("position").distinct().count() == got.count() == got.select("doc_id", "copy").distinct().count()
    big = mixing.replicate(d.limit(5), size=10_000).count()
    assert abs(big - 10_000) < 500


def test_mixing_ties_and_null_ids(spark):
    rows = [(None, "a", "s", -1)] * 3 + [(1, "a", "s", -1)] * 2 + [(1, "b", None, -1), (2, None, None, -1)] + [(i, "t", "s", -1) for i in range(3, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = [r.asDict(True) for r in mixing.replicate(d, size=300).collect()]
    n = {}
    for r in got:
        key = (r["doc"]["doc_id"], r["doc"]["source"], r["doc"]["text"])
        n.setdefault(key, []).append((r["copies"], r["copy"], r["position"]))
    times = {(None, "s", "a"): 3, (1, "s", "a"): 2}
    for key, of in n.items():
        k = times.get(key, 1)
        assert len(of) == k * of[0][0] and sorted(x[1] for x in of) == sorted([*range(1, of[0][0] + 1)] * k)
    # a slow inversion of the Poisson distribution
    rate = {s: 300 * c**0.5 / (2**0.5 + 62**0.5) / c for s, c in (("s", 62), (None, 2))}
    for i, _, s, _ in rows:
        u = (int(hashlib.sha256(f"mix-1:{'null' if i is None else i}:1".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p = 0, np.exp(-rate[s])
        total = p
        while total <= u:
            k += 1
            p *= rate[s] / k
            total += p
        have = [of[0][0] for key, of in n.items() if key[:2] == (i, s)]
        assert (have[0] if have else 0) == k
    again = sorted((str(r["doc"]), r["copy"], r["position"]) for r in mixing.replicate(d.repartition(7), size=300).collect())
    assert again == sorted((str(mixing_row(r)), r["copy"], r["position"]) for r in got)


def mixing_row(r):
    from pyspark.sql import Row

    return Row(**r["doc"])


def test_mixing_odd_rows(docs):
    got = mixing.mixed(docs, size=500)
    assert got.columns == docs.columns
    assert got.where("source is null").count() > 0
