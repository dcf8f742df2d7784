"""Personal data (operator 1): weak supervision over candidate spans.

The base detectors of the contract always count. Beside them, wider patterns propose
candidates (secrets, national phone numbers, loosely written addresses, titled names, ...).
Labelers - shape, checksum or range, gazetteer, context words, boundary - vote on every
candidate; expectation-maximisation over the counts of vote patterns of the whole corpus
estimates how reliable each labeler is; the resulting probabilities train a logistic
classifier over votes and span features, which decides which candidates become spans.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "name", "secret", "ssn")

# Fixed patterns of the base detectors.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Candidates of the method.
WIDE = {
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "phone": re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "card": CARD,
    "secret": re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"),
}
#: The sign of a spelled-out address, and what follows it; what stands before is read backwards, as far as it goes.
AT = re.compile(r" ?[\[(]at[\])] ?")
SPELLED = re.compile(r"[A-Za-z0-9-]++(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]++)++")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.? ([A-Z][a-z]++(?: [A-Z][a-z]++)*+)")
#: Words with capitals in a row; from the first given name on they are a candidate.
CAPITALS = re.compile(r"\b[A-Z][a-z]++(?: [A-Z][a-z]++)++")
#: A part of every title that NAME begins with.
TITLES = ("Mr", "Ms", "Dr", "Prof")

# Words near personal data, by kind, and gazetteers.
CONTEXT = {
    "email": ("mail", "contact", "reply"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "name": ("dear", "sincerely", "patient", "signed", "mr", "mrs", "ms ", "ms.", "dr ", "dr.", "prof"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "bearer", "auth"),
    "ssn": ("ssn", "social", "security"),
}
COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR IE IT LU NL NO PL PT RO SE".split())
TOP_DOMAINS = frozenset("com org net edu gov io de fr es uk eu info".split())
CARD_STARTS = ("4", "5", "34", "37", "6011", "65", "35", "30", "36")
TOLL_FREE = frozenset("800 833 844 855 866 877 888".split())
SERVICES = frozenset("211 311 411 511 611 711 811 911".split())
PUBLISHED_SSN = frozenset("078051120 219099999 457555462".split())
SECRET_STARTS = ("AKIA", "ASIA", "AIza", "eyJ", "ghp_", "gho_", "glpat-", "sk_live_", "sk-", "xoxb-", "xoxp-")
GIVEN_NAMES = frozenset(
    "Ahmed Ana Anna Antoine Barbara Camille Carlos Carmen Charles Claire David Elena Elizabeth Emma Fatima Felix Giulia Hans Hiroshi Ivan James Jean Jennifer "
    "Jessica John Jose Joseph Juan Julia Julien Karen Klaus Laura Lena Liam Linda Luca Lucia Luis Lukas Marco Maria Marie Marta Mary Michael Mohammed Natasha "
    "Nicolas Noah Olga Olivia Patricia Paul Peter Pierre Priya Rahul Richard Robert Sarah Sofia Sophie Susan Thomas William Yuki".split()
)
NOT_NAMES = frozenset(
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February April June July August September October November December "
    "Street Avenue Road Square Park River Lake Mount University College Company Bank The And Of".split()
)
WINDOW = 24
LABELERS = ("shape", "check", "gazetteer", "context", "boundary")
#: How often each labeler's votes are taken to be right before anything is seen, how often it abstains, and how many candidates that belief weighs.
RIGHT, ABSTAINS, WEIGHT = (0.6, 0.9, 0.75, 0.75, 0.6), 0.3, 10.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; every @ is looked at once, and runs before it are read backwards."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        elif start < at:
            end = max(end, start)
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The contract's spans by kind, with code point offsets."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        out["email"] = _emails(text)
    if DIGIT.search(text):
        out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _votes(kind: str, text: str, start: int, end: int, value: str) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    before = text[max(0, start - WINDOW) : start].lower()
    around = before + " " + text[end : end + WINDOW].lower()
    digits = "".join(c for c in value if "0" <= c <= "9")
    near = 1 if any(w in before for w in CONTEXT[kind]) else (0 if any(w in around for w in CONTEXT[kind]) else -1)
    edge = 1 if (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum()) else -1
    if kind == "card":
        return (1 if 13 <= len(digits) <= 19 else -1, 1 if luhn(digits) else -1, 1 if digits.startswith(CARD_STARTS) else 0, near, edge)
    if kind == "phone":
        known = 1 if digits[:3] in TOLL_FREE else -1 if digits[:3] in SERVICES or digits[3:6] in SERVICES else 0
        return (1 if len(digits) == 10 else -1, 1 if digits[0] in "23456789" and digits[3] in "23456789" else -1, known, near, edge)
    if kind == "ssn":
        ok = digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
        return (1 if value.count("-") == 2 else -1, 1 if ok else -1, -1 if digits in PUBLISHED_SSN else 0, near, edge)
    if kind == "iban":
        flat = value.replace(" ", "")
        number = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4]))
        return (1 if 15 <= len(flat) <= 34 else -1, 1 if number % 97 == 1 else -1, 1 if flat[:2] in COUNTRIES else -1, near, edge)
    if kind == "email":
        host = SPELLED.search(value)
        last = re.split(r"[^A-Za-z]+", value.rstrip(" )]"))[-1].lower()
        return (1 if value[0] not in ".-" else -1, 1 if host and 1 < len(last) < 64 else -1, 1 if last in TOP_DOMAINS else -1, near, edge)
    if kind == "name":
        words = value.split(" ")
        return (1 if 2 <= len(words) <= 3 else 0 if len(words) == 1 else -1, -1 if NOT_NAMES.intersection(words) else 1, 1 if words[0] in GIVEN_NAMES else 0, near, edge)
    mixed = bool(digits) and any(c.isalpha() for c in value)
    return (1 if mixed else -1, 1 if _entropy(value) >= 3.0 else -1, 1 if value.startswith(SECRET_STARTS) else 0, near, edge)


def _side(c: str) -> int:
    """What a span touches: 0 white space or an end of the text, 1 a quote, bracket, = or :, 2 anything else."""
    return 0 if not c or c.isspace() else 1 if c in "\"'`()[]{}<>=:," else 2


def _code(kind: str, text: str, s: int, e: int) -> str:
    """The discrete description of a candidate: votes, size, shares of digits and capitals, what it touches, and how many context words are near."""
    value = text[s:e]
    votes = _votes(kind, text, s, e, value)
    size = min(7, (e - s).bit_length())
    share = round(4 * sum("0" <= c <= "9" for c in value) / len(value))
    upper = int(any("A" <= c <= "Z" for c in value))
    around = f"{text[max(0, s - WINDOW) : s]} {text[e : e + WINDOW]}".lower()
    words = min(2, sum(w in around for w in CONTEXT[kind]))
    return f"{kind}|{','.join(map(str, votes))}|{size}|{share}|{upper}|{_side(text[s - 1 : s])}|{_side(text[e : e + 1])}|{words}"


def _spelled(text: str) -> list[tuple[int, int]]:
    """Addresses with the sign spelled out: leftmost, non-overlapping, in time linear in the text."""
    out, end = [], 0
    for at in AT.finditer(text):
        start = at.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = SPELLED.match(text, at.end()) if start < at.start() else None
        if m:
            end = m.end()
            out.append((start, end))
    return out


def _names(text: str) -> set[tuple[int, int]]:
    """Words with capitals after a title, or from a given name on."""
    out = {m.span(1) for m in NAME.finditer(text)} if any(t in text for t in TITLES) else set()
    for m in CAPITALS.finditer(text):
        at = m.start()
        words = m[0].split(" ")
        for w in words[:-1]:
            if w in GIVEN_NAMES:
                out.add((at, m.end()))
                break
            at += len(w) + 1
    return out


def candidates(text: str, base: dict[str, list[tuple[int, int]]]) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, code) of all that the wide patterns find outside base spans; they may overlap (see settle).

    code is the discrete description that the labelers and the classifier see.
    """
    found = []
    if DIGIT.search(text) is not None:
        for kind, pattern in WIDE.items():
            for m in pattern.finditer(text):
                s, e = m.span()
                if kind == "card" and not 13 <= sum("0" <= c <= "9" for c in m[0]) <= 19:
                    continue
                if kind == "secret" and (m[0].isalpha() or m[0].isdigit() or not any("0" <= c <= "9" for c in m[0])):
                    continue
                found.append((kind, s, e))
    if "at]" in text or "at)" in text:
        found += [("email", *x) for x in _spelled(text)]
    found += [("name", *x) for x in _names(text)]
    if not found:
        return []
    taken = sorted(x for spans in base.values() for x in spans)
    starts, ends = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    out = []
    for kind, s, e in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        before = bisect_left(starts, e)
        if not before or ends[before - 1] <= s:
            out.append((kind, s, e, _code(kind, text, s, e)))
    return out


def settle(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Accepted candidates, ordered by start and length, without overlaps: leftmost, then longest, wins."""
    out: list[tuple[str, int, int]] = []
    for x in found:
        if not out or x[1] >= out[-1][2]:
            out.append(x)
    return out


def _beliefs() -> np.ndarray:
    """Per labeler and class (no, yes), the probability of each vote (-1, 0, 1) before anything is seen."""
    r, speaks = np.array(RIGHT), 1 - ABSTAINS
    yes = np.stack([speaks * (1 - r), np.full(len(r), ABSTAINS), speaks * r], axis=1)
    return np.stack([yes[:, ::-1], yes], axis=1)


def reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 50) -> tuple[np.ndarray, float]:
    """EM for two classes with conditionally independent labelers.

    patterns: votes and how often they occur. Returns, per labeler and class (no, yes), the
    probability of each vote (-1, 0, 1), and the prior of yes. It starts from what is believed
    of the labelers (RIGHT), which weighs as much as WEIGHT candidates; a checksum is believed
    more than a shape. The prior is held in 0.01 to 0.99.
    """
    keys = sorted(patterns)
    v = np.array(keys, int) + 1
    n = np.array([patterns[k] for k in keys], float)
    belief = _beliefs()[: v.shape[1]]
    like, prior = belief.copy(), 0.5
    for _ in range(rounds):
        yes = posterior(v, like, prior)
        prior = float(np.clip((n * yes).sum() / n.sum(), 0.01, 0.99))
        for k in range(v.shape[1]):
            for c, w in ((0, n * (1 - yes)), (1, n * yes)):
                seen = np.bincount(v[:, k], w, minlength=3) + WEIGHT * belief[k, c]
                like[k, c] = seen / seen.sum()
    return like, prior


def posterior(v: np.ndarray, like: np.ndarray, prior: float) -> np.ndarray:
    k = np.arange(v.shape[1])
    no, yes = (np.log(like[k, c, v]).sum(axis=1) + math.log(p) for c, p in ((0, 1 - prior), (1, prior)))
    return 1 / (1 + np.exp(np.clip(no - yes, -500, 500)))


def _features(code: str) -> np.ndarray:
    kind, votes, n, share, upper, left, right, words = code.split("|")
    v = [float(x) for x in votes.split(",")]
    sides = [float(x == y) for x in (left, right) for y in "012"]
    return np.array([1.0, *v, *(float(kind == k) for k in KINDS), float(n) / 7, float(share) / 4, float(upper), *sides, float(words)])


def train(counts: dict[str, int]) -> set[str]:
    """Codes that the final classifier accepts, learned from how often each code occurs.

    The codes form a finite grid (kinds, votes, three small features), so what is gathered
    here does not grow with the corpus. The classifier is logistic over votes, kind, size,
    characters, neighbours and context; it learns the probabilities that EM gives the
    candidates, each code as heavy as the root of its count, and accepts those of half and more.
    """
    if not counts:
        return set()
    codes = sorted(counts)
    kinds = {c: c.split("|")[0] for c in codes}
    votes = {c: tuple(int(x) for x in c.split("|")[1].split(",")) for c in codes}
    soft = {}
    for kind in sorted(set(kinds.values())):
        own = [c for c in codes if kinds[c] == kind]
        patterns: dict[tuple[int, ...], float] = {}
        for c in own:
            patterns[votes[c]] = patterns.get(votes[c], 0) + counts[c]
        like, prior = reliabilities(patterns)
        p = posterior(np.array([votes[c] for c in own]) + 1, like, prior)
        soft |= dict(zip(own, p, strict=True))
    x = np.array([_features(c) for c in codes])
    y = np.array([soft[c] for c in codes])
    n = np.sqrt(np.array([counts[c] for c in codes], float))
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + 0.1 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {c for c, q in zip(codes, p, strict=True) if q >= 0.5}


def _tally(batches):
    seen: Counter = Counter()
    for b in batches:
        for text in b.column(0).to_pylist():
            if text:
                seen.update(c[3] for c in candidates(text, base_spans(text)))
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])


def accepted_codes(docs: DataFrame) -> set[str]:
    """Learns from all texts of docs. Only counts of codes reach the driver."""
    rows = docs.select(F.col("text").cast("string")).mapInArrow(_tally, "code string, n long")
    return train({r["code"]: r["n"] for r in rows.groupBy("code").agg(F.sum("n").alias("n")).collect()})


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _all_spans(text: str, accepted) -> tuple[list, list]:
    base = base_spans(text)
    first = [(k, s, e) for k in BASE for s, e in base[k]]
    more = settle([(k, s, e) for k, s, e, code in candidates(text, base) if code in accepted])
    return first, sorted(first + more, key=lambda x: (KINDS.index(x[0]), x[1]))


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_spans(docs: DataFrame) -> DataFrame:
    """Spans of every row: counts and digest of the base detectors, and all spans written out.

    A null text is empty: no spans, digest of the empty string. Candidates never overlap base
    spans or each other: of accepted ones that overlap, the leftmost,
    then longest, wins. Repeated rows give repeated rows; no
    rows give none; other columns are ignored. Both passes are scans without a shuffle of text.
    """
    accepted = docs.sparkSession.sparkContext.broadcast(accepted_codes(docs))

    def run(batches):
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                first, spans = _all_spans(text or "", accepted.value)
                n = Counter(k for k, _, _ in first)
                out.append((*(n[k] for k in BASE), sha256(_written(first).encode()).hexdigest(), _written(spans)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                names=[x.split()[0] for x in OUT.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, OUT)


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars (if there) counted anew.

    Overlapping spans of several kinds are replaced together, by the kind that starts first.
    Rows and columns stay as they are otherwise; null texts stay null.
    """
    accepted = docs.sparkSession.sparkContext.broadcast(accepted_codes(docs))
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def clean(text):
        if not text:
            return text
        _, spans = _all_spans(text, accepted.value)
        if not spans:
            return text
        out, end = [], 0
        for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= end:
                out += [text[end:s], f"[{kind.upper()}]"]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def run(batches):
        for b in batches:
            texts = b.column(at).cast(pa.string()).to_pylist()
            now = [clean(t) for t in texts]
            b = b.set_column(at, b.schema.field(at), pa.array(now, b.schema.field(at).type))
            if size >= 0:
                was = b.column(size).to_pylist()
                n = [w if x is y or x is None else len(y) for w, x, y in zip(was, texts, now, strict=True)]
                b = b.set_column(size, b.schema.field(size), pa.array(n, b.schema.field(size).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document."""
    return find_spans(table(spark, sf_dir, "documents"))
