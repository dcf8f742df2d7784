"""Pages, WARC, tool calls, vectors and the pipeline."""

import json
import random
import re
from html import unescape
from pathlib import Path

import numpy as np
import pytest

from tidegraph.llm import ann, extraction, tools, warc
from tidegraph.llm.dom import joined, parse


def test_parse_and_joined():
    html = "<html><head><title>x</title><script>if (a<b) '</p>'</script></head><body><p>a<b>b</b> &amp; c<p>d<br>e<ul><li>f<li>g</ul>h<!-- no --></body>"
    nodes, pieces = parse(html)
    assert joined(pieces) == "ab & c d e f g h"
    assert [n.tag for n in nodes].count("li") == 2
    assert joined(parse("")[1]) == "" and joined(parse("a < b <")[1]) .startswith("a")


def test_visible_raw_text_and_words_in_parts():
    read = lambda h: joined(parse(h)[1])
    assert read("super<wbr>calif foo<img src=x>bar") == "supercalif foobar"
    assert read("a<xmp><b>&amp;</b></xmp>c") == "a <b>&amp;</b> c"
    assert read("so <math><mi>y</mi><mo>+</mo><annotation>tex</annotation></math>z") == "so y+ z"
    assert read("q<svg>r <noscript>s</noscript>t") == "q r t" and read("q<svg><text>u</text></svg>t") == "q t"
    assert read("""<a x="1>2" y='3>4'>t</a> <a href=x=y>k</a> a < b""") == "t k a < b" and read("ab<script>x") == "ab"


@pytest.mark.parametrize("page", ["<b>{n}<p>", "<span class=x>{n}<p>", "<div", "<a x='>' ", '<a "', "<ul><li>", "<svg>", "<!-- ", "<table><tr><td>", "</b>", "<a ="])
def test_odd_markup_is_read_in_linear_time(page):
    import time

    took = []
    for n in (20_000, 200_000):
        parts = page.split("{n}")
        html = "".join(p * n for p in parts)
        start = time.process_time()
        parse(html)
        took.append(time.process_time() - start)
    assert took[1] < 25 * took[0] + 0.5


def test_pages_against_a_slow_reader():
    """Texts of drawn layouts, read by hand from their marks (see _Writer), against the tree's."""
    for seed in range(60):
        s = extraction._Writer(20_000_000 + seed).page().translate(extraction.MARKS)
        nodes, pieces = parse(s)
        inner = s[s.index("<body>") :]
        inner = re.sub(r"<title>.*?</title>", "", inner)
        want = unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?!a\b|b\b|label\b|button\b|input\b)[a-z0-9]+[^>]*>", " ", re.sub(r"</?(label|button)>", " ", inner)))).split()
        assert joined(pieces).split() == want


def test_decoding_is_consistent():
    m = extraction.model()
    for seed in range(20):
        nodes, _ = parse(extraction._Writer(seed).page().translate(extraction.MARKS))
        keep = extraction.decode(nodes, m.predict(extraction.features(nodes)))
        assert all(keep[n.parent] for n, k in zip(nodes[1:], keep[1:], strict=True) if k)


def test_held_out_layouts():
    m, exact = extraction.model(), 0
    for seed in range(100):
        s = extraction._Writer(10_000_000 + seed).page()
        _, pieces = parse(s)
        main = junk = False
        out = []
        for _, x in pieces:
            for c in x or " ":
                main = c == "\2" if c in "\2\3" else main
                junk = c == "\0" if c in "\0\1" else junk
                if main and not junk and c not in "\0\1\2\3":
                    out.append(c)
            out.append(" " if not x else "")
        exact += " ".join("".join(out).split()) == extraction.extract(s.translate(extraction.MARKS), m)
    assert exact >= 90


def test_articles_of_pages(spark):
    p = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in extraction.extract_pages(p).collect()}
    hit = 0
    for r in p.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())
        hit += want == got[r["page_id"]]["text"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    assert hit >= 0.98 * len(got)


def test_odd_pages(spark):
    d = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p>"), (3, "u", "<p>"), (None, "u", "plain " * 20000)], "page_id long, url string, html string")
    got = extraction.extract_pages(d.withColumn("text", d["url"])).collect()
    assert len(got) == 5 and {r["n_chars"] for r in got if r["page_id"] in (1, 2, 3)} == {0}
    assert extraction.extract_pages(d.limit(0)).count() == 0


def test_warc_records(spark):
    html = b"<title>T &amp; U</title><script>x</script><p>a<p>b <a href=q>c</a>"
    rows = [("<urn:uuid:1>", "http://x/", "2024-01-01T00:00:00Z", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nX-A: 1\r\n 2\r\n\r\n" + html), ("<urn:uuid:2>", None, None, None), (None, "u", "d", b"x")]
    d = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, payload binary")
    got = {(r["refers_to"], r["warc_type"]): r for r in warc.derive(d).collect()}
    assert len(got) == 4
    m, c = got[("<urn:uuid:1>", "metadata")], got[("<urn:uuid:1>", "conversion")]
    assert c["block"] == "a\nb c" and c["source_payload_digest"] == warc.digest(html) == m["source_payload_digest"]
    assert f"conversion: {c['record_id']}" in m["block"] and "http-x-a: 1 2" in m["block"] and "title: T & U" in m["block"] and "links: 1" in m["block"]
    for r in got.values():
        fields = dict(x.split(": ", 1) for x in r["header"].split("\r\n")[1:] if x)
        data = r["block"].encode()
        assert int(fields["Content-Length"]) == len(data) == r["content_length"] and fields["WARC-Block-Digest"] == warc.digest(data) == r["block_digest"]
        assert fields["WARC-Refers-To"] == r["refers_to"] and fields["WARC-Record-ID"] == r["record_id"]
    again = {(r["refers_to"], r["warc_type"]): r for r in warc.derive(d.union(d)).distinct().collect()}
    assert again == got and warc.derive(d.limit(0)).count() == 0


def bare(html):
    """All text of a page read by a walk over characters: blocks on lines, words by one blank."""
    out, i = [], 0
    while i < len(html):
        if html.startswith("<!--", i):
            i = html.find("-->", i) + 3
        elif html[i] == "<":
            name = re.match(r"</?([a-z0-9]*)", html[i:])[1]
            end = html.find(">", i)
            if name in ("script", "style", "title") and html[i + 1] != "/":
                end = html.find(">", html.find(f"</{name}", i))
            i = end + 1
            out.append("" if name in ("a", "b", "i", "em", "span", "wbr", "img") else "\n")
        else:
            out.append(" " if html[i] == "\n" else html[i])
            i += 1
    return "\n".join(filter(None, (" ".join(unescape(x).split()) for x in "".join(out).split("\n"))))


def test_warc_query_against_a_slow_reader(spark):
    """Every page of the query: plain text by a walk over characters, and digests of the page's own bytes."""
    pages = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        pages.setdefault(r["url"], []).append(r["html"] or "")
    got = warc.op5_warc_derivatives(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 2 * sum(map(len, pages.values())) and {r["warc_type"] for r in got} == {"metadata", "conversion"}
    by_id = {r["record_id"]: r for r in got}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    for r in got:
        data = r["block"].encode()
        assert r["content_length"] == len(data) and r["block_digest"] == warc.digest(data)
        assert r["source_payload_digest"] in {warc.digest(h.encode()) for h in pages[r["target_uri"]]}
        assert r["source_block_digest"] in {warc.digest(head + h.encode()) for h in pages[r["target_uri"]]}
        if r["warc_type"] == "conversion":
            assert r["block"] in {bare(h) for h in pages[r["target_uri"]]}
        else:
            linked = by_id[re.search("conversion: (.*)\r", r["block"])[1]]
            assert linked["refers_to"] == r["refers_to"] and f"source-warc-record-id: {r['refers_to']}" in r["block"]


def test_warc_sources_keep_headers_and_digests(spark):
    html = "<p>grüße</p><script>document.write('<a href=x>')</script><!-- <a href=y> --><p>su<wbr>per <a href=z>z</a>"
    gz = lambda b: __import__("gzip").compress(b)
    chunked = lambda b: b"".join(b"%x;q\r\n%s\r\n" % (len(b[i : i + 7]), b[i : i + 7]) for i in range(0, len(b), 7)) + b"0\r\n\r\n"
    http = lambda *f: ("HTTP/1.1 200 OK\r\n" + "".join(x + "\r\n" for x in f) + "\r\n").encode()
    body = html.encode()
    given = "WARC/1.0\r\nWARC-Payload-Digest: sha256:abc\r\nWARC-Block-Digest: sha1:XYZ\r\nWARC-IP-Address: 192.0.2.1\r\nX-Long: a\r\n b\r\nWARC-Target-URI: http://h/\r\nWARC-Date: 2020-02-02T02:02:02Z"
    late = b"<p>" + b"x " * 3000 + b"<meta charset=latin-1><p>gr\xfc\xdfe"
    cases = {
        "gzip": http("Content-Encoding: gzip") + gz(body), "both": http("Transfer-Encoding: chunked", "Content-Encoding: gzip") + chunked(gz(body[:20]) + gz(body[20:])),
        "deflate": http("Content-Encoding: deflate") + __import__("zlib").compress(body), "cut": http("Content-Encoding: gzip") + gz(body)[:-9], "late": late,
        "undefined": http("Content-Type: text/html; charset=undefined") + body, "idna": http("Content-Type: text/html; charset=idna") + body, "odd": http("Content-Type: text/html; charset=no-such") + body,
        "brotli": http("Content-Encoding: br") + b"\x0b\x02\x80", "image": http("Content-Type: image/png") + b"\x89PNG", "plain": http("Content-Type: text/plain") + b"a <b>\n c", "bom": "\ufeff".encode("utf-16-le") + html.encode("utf-16-le"),
        "long": b"<p>word</p>" * 200_000,
    }
    rows = [(k, None, None, v, given, "x") for k, v in cases.items()]
    d = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, payload binary, warc_header string, block string")
    got = {(r["refers_to"], r["warc_type"]): r for r in warc.derive(d).collect()}
    for k in ("gzip", "both", "deflate", "undefined", "idna", "odd", "bom"):
        assert got[k, "conversion"]["block"] == "grüße\nsuper z", k
        assert "links: 1\r" in got[k, "metadata"]["block"]
    assert got["late", "conversion"]["block"].endswith("grüße") and got["cut", "conversion"]["block"].startswith("grüße")
    assert got["plain", "conversion"]["block"] == "a <b>\n c" and got["long", "conversion"]["block"].count("word") == 200_000
    for k, why in (("brotli", "content coding"), ("image", "media type")):
        assert (k, "conversion") not in got and f"no-conversion: {why}" in got[k, "metadata"]["block"]
    for r in got.values():
        assert (r["source_payload_digest"], r["source_block_digest"], r["source_header"]) == ("sha256:abc", "sha1:XYZ", given)
        assert r["target_uri"] == "http://h/" and r["warc_date"] == "2020-02-02T02:02:02Z" and "WARC-Source-Payload-Digest: sha256:abc" in r["header"]
    m = got["gzip", "metadata"]["block"]
    assert "source-warc-ip-address: 192.0.2.1" in m and "source-x-long: a b" in m and "block-digest-matches: false" in m


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>"
RESULTS = "conv_id long, call_id string, turn long, content string"


ADD = {"properties": {"a": {"type": "integer"}, "b": {"type": "number"}}, "required": ["a"]}


def test_tool_links(spark):
    schemas = {"add": ADD, "none": {}}
    calls = [
        (1, "x", 0, "add", '{"b": 2.5, "a": 1}', []), (1, "y", 1, "add", '{"a": "1"}', ["x"]), (1, "z", 2, "none", "{}", ["y", "x", "gone"]), (1, "x", 9, "add", "{}", []),
        (1, "c1", 3, "none", "{}", ["c2"]), (1, "c2", 4, "none", "{}", ["c1"]), (1, "c3", 5, "none", "{}", ["c2"]), (2, "x", 0, "odd", "[1]", None), (2, "n", 1, "none", "nope", []), (None, "x", 0, "add", "{}", []),
    ]
    results = [(1, "x", 3, "first"), (1, "x", 4, "later"), (1, "z", 5, 'say "hi"\n'), (3, "lost", 1, "?"), (2, None, 1, "?")]
    got = {(r["conv_id"], r["call_id"]): r for r in tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), schemas).collect()}
    assert set(got) == {(1, "x"), (1, "y"), (1, "z"), (1, "c1"), (1, "c2"), (1, "c3"), (2, "x"), (2, "n"), (3, "lost")}
    status = {k: (r["status"], r["level"]) for k, r in got.items()}
    assert status[1, "x"] == ("linked", 0) and status[1, "y"] == ("invalid", 0) and status[1, "z"] == ("linked", 0)
    assert status[1, "c1"] == status[1, "c3"] == ("cycle", None) and status[3, "lost"] == ("orphan_result", None)
    assert status[2, "x"][0] == status[2, "n"][0] == "invalid" and got[1, "y"]["errors"] == "arguments.a: not integer"
    assert got[1, "x"]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"first"}' and got[1, "x"]["n_results"] == 2
    assert json.loads(got[1, "z"]["json"])["result"] == 'say "hi"\n'


def test_conversations_to_calls(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "\n\t" + json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": {"q": 1}, "needs": []}]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "ok"})), (1, 3, "assistant", "bye"), (2, 0, "user", None), (2, 0, "user", None), (None, 0, "user", "x"), (3, 1, None, "y"),
        (3, 2, "system", "be \"kind\""), (3, 2, "system", "zz"), (4, 0, "user", "w " * 300_000),
    ]
    d = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id long, turn long, role string, text string, call_id string, level int")
    got = {(r["conv_id"], r["call_id"]): r for r in tools.link_conversations(d, tools.PLAIN | {"f": {"properties": {"q": {"type": "integer"}}}}).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        (1, "turn-0"): "no_result", (1, "a"): "linked", (1, "turn-2"): "orphan_result", (2, "turn-0"): "no_result", (3, "other-null-1"): "other_turn", (3, "other-system-2"): "other_turn", (4, "turn-0"): "no_result",
    }
    assert got[3, "other-system-2"]["n_calls"] == 2 and got[3, "other-system-2"]["json"] == '{"content":"be \\"kind\\"","id":"other-system-2","role":"system"}'
    assert json.loads(got[4, "turn-0"]["json"])["arguments"]["prompt"] == "w " * 300_000
    assert tools.link_conversations(d.limit(0), tools.PLAIN).count() == 0


NESTED = {
    "type": "object", "required": ["q", "list"], "additionalProperties": False,
    "properties": {
        "q": {"type": "string", "enum": ["a", "é\"b"]}, "list": {"type": "array", "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}, "tags": {"type": "array", "items": {"type": "string"}}}}},
        "deep": {"type": "object", "properties": {"x y": {"type": "object", "properties": {"z'": {"enum": [1, None, True]}}}}}, "maybe": {"type": "null"}, "a'b\"c": {"type": "boolean"},
    },
}


def slow_wrong(v, schema, at="arguments"):
    kinds = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "array": (list,), "object": (dict,), "null": (type(None),)}
    out, kind = [], schema.get("type")
    if kind and (not isinstance(v, kinds[kind]) or (isinstance(v, bool) and kind != "boolean")):
        return [f"{at}: not {kind}"]
    if "enum" in schema and json.dumps(v) not in {json.dumps(x) for x in schema["enum"]}:
        out.append(f"{at}: not one of the listed")
    if isinstance(v, dict):
        for k in sorted(set(schema.get("properties", {})) | set(schema.get("required", []))):
            if k in v:
                out += slow_wrong(v[k], schema.get("properties", {}).get(k, {}), f"{at}.{k}")
            elif k in schema.get("required", []):
                out.append(f"{at}.{k}: missing")
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: not expected" for k in sorted(set(v) - set(schema.get("properties", {})))]
    if isinstance(v, list) and "items" in schema:
        out += [e for i, x in enumerate(v) for e in slow_wrong(x, schema["items"], f"{at}[{i}]")]
    return out


def test_nested_schemas(spark):
    args = [
        {"q": "a", "list": []}, {"q": "é\"b", "list": [{"n": 1, "tags": ["x"]}, {"n": "1"}, {"tags": [1, "y"]}, 3]}, {"q": "c", "list": {}, "more": 1, "also": 2}, {"list": [{"n": 2}], "deep": {"x y": {"z'": 2}}},
        {"q": "a", "list": [], "deep": {"x y": {"z'": None}}, "maybe": None}, {"q": "a", "list": [], "deep": {"x y": 1}, "maybe": 0, "a'b\"c": 1}, {"q": None, "list": None}, {"q": "a", "list": [], "deep": {"x y": {"z'": True}}},
    ]
    calls = [(1, f"k{i}", i, "t", json.dumps(a), []) for i, a in enumerate(args)]
    got = {r["call_id"]: r["errors"] for r in tools.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), {"t": NESTED}).collect()}
    assert got == {f"k{i}": "; ".join(slow_wrong(a, NESTED)) for i, a in enumerate(args)} and sum(x == "" for x in got.values()) == 3


def slow_levels(calls):
    """By relaxation until nothing changes; calls that need a cycle have none."""
    at = {(c, i): (t, i) for c, i, t, _ in calls}
    needs = {(c, i): [(c, n) for n in w if (c, n) in at] for c, i, _, w in calls}
    done = {}
    while True:
        free = {k for k in needs if k not in done and all(n in done for n in needs[k])}
        if not free:
            return done
        done |= {k: max((done[n] + (at[n] >= at[k]) for n in needs[k]), default=0) for k in free}


def test_levels_against_a_slow_version(spark):
    """Chains of 1,000 forwards and backwards, a long chain behind a cycle, and random needs with several each."""
    r = np.random.default_rng(6)
    calls = [(1, f"f{i:04d}", i, [f"f{i - 1:04d}"] if i else []) for i in range(1000)]
    calls += [(2, f"b{i:04d}", i, [f"b{i + 1:04d}"]) for i in range(1000)]
    calls += [(3, f"c{i:04d}", i, [f"c{max(0, i - 1):04d}"]) for i in range(300)]
    calls += [(4, f"s{i}", i % 7, [f"s{i - 1}", f"s{max(0, i - 3)}", "gone"]) for i in range(1, 9)] + [(4, "s0", 3, [])]
    for c in range(5, 25):
        calls += [(c, f"r{i}", int(r.integers(0, 6)), [f"r{j}" for j in r.integers(0, 12, r.integers(0, 3))]) for i in range(12)]
    d = spark.createDataFrame(calls, "conv_id long, call_id string, turn long, needs array<string>")
    got = {(x["conv_id"], x["call_id"]): x["level"] for x in tools.levels(d).collect()}
    want = slow_levels(calls)
    assert got == want and want[2, "b0000"] == 999 and not any(c == 3 for c, _ in want) and len({c for c, _ in want}) > 10
    order = {k: (lv, t, i) for c, i, t, _ in calls if (k := (c, i)) in got for lv in [got[k]]}
    assert all(order[c, n] < order[c, i] for c, i, _, w in calls if (c, i) in got for n in w if (c, n) in order)


def slow_search(ids, x, k=10):
    out = []
    for i, q in zip(ids, x, strict=True):
        if i % 100 == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            d[ids == i] = np.inf
            out += [(int(i), n + 1, int(ids[j]), float(d[j])) for n, j in enumerate(np.lexsort((ids, d))[: min(k, len(ids) - 1)])]
    return out


def test_search_is_exact_with_one_part_and_odd_rows(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 8)).astype(np.float32)
    x[50:90] = x[0]
    rows = [(i, [float(v) for v in a], i) for i, a in enumerate(x)]
    odd = [(500, None, 0), (600, [], 0), (700, [0.0] * 8, 0), (800, [1.0, None] * 4, 0), (900, [float("nan")] * 8, 0), (None, [1.0] * 8, 0), rows[0], (1000, [1.0, 2.0], 0)]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in ann.search(d).collect())
    want = sorted(slow_search(np.arange(300), x.astype(float)))
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)
    assert ann.search(d.limit(0)).count() == 0


def drawn_vectors(n, dims=32, seed=3):
    """Overlapping clusters of unequal size on a curved surface, as embeddings have."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(150, dims))
    of = np.minimum(r.geometric(0.03, n) - 1, 149)
    return centres[of] * 0.7 + r.normal(size=(n, 8)) @ r.normal(size=(8, dims)) * 0.4 + 0.1 * r.normal(size=(n, dims))


@pytest.mark.parametrize("leaf", [1536, 200])
def test_search_recall(spark, monkeypatch, leaf):
    """Both over one level of parts and over two."""
    monkeypatch.setattr(ann, "LEAF", leaf)
    x = drawn_vectors(20_000)
    d = spark.createDataFrame([(i, [float(v) for v in a]) for i, a in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    of = ann.materialise(ann.classes(ann.clean(d), 10), "classes")
    index, queries = ann.descend(of, ann.materialise(of.where("ids[0] % 100 = 0").select("cls", "x", "node"), "queries"), 10)
    sizes = [r["count"] for r in index.groupBy("node").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 40 and max(sizes) < 4 * 20_000 / len(sizes) + leaf
    depth = {r["node"].count("/") for r in index.select("node").distinct().collect()}
    assert max(depth) == 1 if leaf == 1536 else max(depth) >= 2
    assert queries.count() < 0.4 * len(sizes) * 200
    want = {(a, c) for a, _, c, _ in slow_search(np.arange(20_000), x)}
    got = [tuple(r) for r in ann.search(d).collect()]
    assert len(got) == len(want) == 2000 and len({(a, c) for a, _, c, _ in got} & want) >= 0.93 * len(want)
    for q, _, v, score in got[::50]:
        assert abs(score - np.sqrt(((x[q] - x[v]) ** 2).sum())) < 1e-12


def test_search_in_chunks_of_queries(spark, monkeypatch):
    x = drawn_vectors(3000, 8)
    d = spark.createDataFrame([(i, [float(v) for v in a]) for i, a in enumerate(x)], "vec_id long, embedding array<double>").repartition(2)
    whole = sorted(map(tuple, ann.search(d, every=10).collect()))
    for name, n in (("QUERIES", 50), ("BLOCK", 100), ("CHUNK", 300)):
        monkeypatch.setattr(ann, name, n)
    assert whole == sorted(map(tuple, ann.search(d, every=10).collect()))


def test_copies_ties_and_repeated_ids(spark):
    """A third of all rows is one vector; ties lie across parts; one id has two vectors; rows repeat."""
    x = np.round(drawn_vectors(900, 4), 1)
    x[300:600] = x[0]
    rows = [(i, [float(v) for v in a]) for i, a in enumerate(x)]
    d = spark.createDataFrame([*rows, *rows[:50], (100, [float(v) for v in x[7]])], "vec_id long, embedding array<double>")
    ids, x = np.append(np.arange(900), 100), np.vstack([x, x[7]])
    want = []
    for i in [*range(0, 900, 100), 900]:
        dist = np.sqrt(((x - x[i]) ** 2).sum(1))
        dist[i] = np.inf
        want += [(int(ids[i]), n + 1, int(ids[j]), float(dist[j])) for n, j in enumerate(np.lexsort((ids, dist))[:10])]
    got = sorted(tuple(r) for r in ann.search(d).collect())
    assert len(got) == len(want) == 100
    near = [(round(g[3], 9) == round(w[3], 9)) for g, w in zip(got, sorted(want), strict=True)]
    assert np.mean(near) >= 0.9
    zero = [w for w in sorted(want) if w[3] == 0]
    assert len(zero) > 30 and set(zero) <= set(got)


def test_balanced_parts():
    r = np.random.default_rng(1)
    x = r.normal(size=(1000, 6))
    x[:400] = x[0]
    label = ann.balanced_parts(x, ann.nearest(x, x, 6), 8)
    assert np.bincount(label, minlength=8).max() <= 1.1 * 1000 / 8 + 1


@pytest.mark.skipif(not Path(__file__).parents[2].joinpath("corpus_pipeline.py").exists(), reason="no pipeline")
def test_pipeline(spark):
    import corpus_pipeline as c

    from tidegraph.llm import bpe

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        docs = out
    want = sorted(tuple(r) for r in bpe.encode_digests(docs).collect())
    assert want == sorted(tuple(r) for r in c.run(spark, "/root/testdata/sf0.001").collect()) and len(want) > 50
    assert docs.where("text rlike '[A-Za-z0-9]@[a-z0-9]+[.]'").count() == 0


@pytest.mark.skipif(not Path(__file__).parents[2].joinpath("corpus_pipeline.py").exists(), reason="no pipeline")
def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    """Every stage against a slow reading of its own input."""
    import corpus_pipeline as c
    from test_documents import odd_rows, slow_base, slow_fingerprint, slow_kept, slow_languages
    from tokenizers import Tokenizer

    from tidegraph.llm import bpe

    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id long, run string, copy int, spans string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    final = sorted(map(tuple, c.run(spark, str(tmp_path)).collect()), key=str)
    assert c.run(spark, str(tmp_path / "none")).count() == 0
    stages = dict(c.STAGES)
    known = {x[0]: x[1] for x in rows}
    one = ann.materialise(stages["language_id"](spark, docs, ""), "one")
    got = one.collect()
    share, _, _ = slow_languages([x[:3] for x in rows])
    assert sorted((str(r["doc_id"]) for r in got)) == sorted(str(x[0]) for x in rows if share[x[0], x[1]] is not None)
    two = ann.materialise(stages["near_duplicates"](spark, one, ""), "two")
    fps = [(r["doc_id"], slow_fingerprint(r["text"])) for r in got if r["doc_id"] is not None]
    assert sorted(r["doc_id"] for r in two.collect() if r["doc_id"] is not None) == slow_kept(fps)
    three = ann.materialise(stages["personal_data"](spark, two, ""), "three")
    after = {r["doc_id"]: r for r in three.collect()}
    assert set(after) == {r["doc_id"] for r in two.collect()}
    for i, r in after.items():
        assert not any(slow_base(r["text"]).values()) and r["n_chars"] == (len(r["text"]) if r["text"] != known[i] else r["n_chars"])
        assert ("[" in r["text"]) == (i == 7)
    four = ann.materialise(stages["mixture"](spark, three, ""), "four")
    assert {r["doc_id"] for r in four.collect()} <= set(after) and four.columns == docs.columns
    t = Tokenizer.from_file(bpe.default_vocabulary())
    want = sorted((r["doc_id"], len(t.encode(r["text"], add_special_tokens=False).ids)) for r in four.collect() if r["doc_id"] is not None)
    assert want == sorted((r[0], r[1]) for r in final if r[0] is not None) and len(want) > 20


def test_no_turn_of_tool_calls_is_lost(spark):
    """Odd lists of calls, drawn: every turn has a row of its own, and what is wrong is named."""
    call = lambda **x: json.dumps({"tool_calls": [x]})
    schemas = {"f": {"properties": {"q": {"type": "integer"}}}}
    turns = [
        (1, "assistant", '{"tool_calls": []}'), (2, "user", '{"tool_calls": []}'), (3, "assistant", call(id=None, name="f", arguments={"q": 1})), (4, "assistant", call(name="f", arguments="{}")),
        (5, "assistant", call(id="a", name="f", arguments={"q": 1}, needs="b")), (6, "assistant", call(id="b", name="f", arguments={"q": 1}, needs=["a", 5, None])), (7, "assistant", '{"tool_calls": ["x", {"id": 7, "name": "f", "arguments": {"q": 2}, "needs": null}]}'),
        (8, "assistant", '{"tool_calls": "none"}'), (9, None, '{"tool_calls": []}'), (10, "tool", '{"tool_call_id": "a", "content": "r"}'), (11, "assistant", '{"tool_calls": [], "tool_call_id": "b"}'),
    ]
    d = spark.createDataFrame([(1, *t) for t in turns], "conv_id long, turn int, role string, text string")
    got = {r["call_id"]: (r["status"], r["errors"], r["turn"], r["result_turn"]) for r in tools.link_conversations(d, schemas).collect()}
    assert got == {
        "other-assistant-1": ("other_turn", "", 1, None), "other-user-2": ("other_turn", "", 2, None), "other-null-9": ("other_turn", "", 9, None),
        "call-3-0": ("invalid", "id: missing", 3, None), "call-4-0": ("invalid", "id: missing", 4, None), "a": ("invalid", "needs: not a list of texts", 5, 10), "b": ("invalid", "needs: not a list of texts", 6, 11),
        "call-7-0": ("invalid", "call: not object; id: missing; unknown tool null", 7, None), "7": ("no_result", "", 7, None), "turn-7": ("orphan_result", "", None, 8),
    }
    r = random.Random(8)
    drawn = []
    for conv in range(1000):
        for turn in range(r.randint(1, 6)):
            calls = [{k: v for k, v in (("id", r.choice([None, "x", "y", 3])), ("name", "f"), ("arguments", {"q": 1}), ("needs", r.choice([None, [], "x", ["x"], [None], {}]))) if r.random() < 0.9} for _ in range(r.randint(0, 3))]
            drawn.append((conv, turn, r.choice(["assistant", "user", None]), json.dumps({"tool_calls": calls}), calls))
    got = tools.link_conversations(spark.createDataFrame([x[:4] for x in drawn], "conv_id long, turn int, role string, text string"), schemas).collect()
    want = {}
    for conv, turn, role, _, calls in drawn:
        if not calls:
            want[conv, f"other-{role or 'null'}-{turn}"] = "other_turn"
        for i, c in enumerate(calls):
            needs, key = c.get("needs"), (conv, str(c["id"]) if c.get("id") is not None else f"call-{turn}-{i}")
            bad = c.get("id") is None or not (needs is None or (isinstance(needs, list) and None not in needs))
            want.setdefault(key, []).append((turn, bad, c))
    assert {(r["conv_id"], r["call_id"]) for r in got} == set(want)
    for r in got:
        of = want[r["conv_id"], r["call_id"]]
        if of != "other_turn":
            assert r["n_calls"] == len(of) and r["turn"] == min(t for t, _, _ in of)
            if len(of) == 1 and of[0][1]:
                assert r["status"] in ("invalid", "cycle") and ("id: missing" in r["errors"]) == (of[0][2].get("id") is None)


@pytest.mark.parametrize("part, said", [
    ('<h2>References</h2><ul><li><a href="a">First source of this</a></li><li><a href="b">Second source here</a></li><li><a href="c">Third one</a></li></ul>', "Third one"),
    ('<div class="related-work"><p>Earlier studies looked at this question in other places and found it hard.</p></div>', "Earlier studies"),
    ('<div class="form-of-words"><p>The form of words that was chosen says little about the matter at hand, as we saw.</p></div>', "form of words that"),
])
def test_parts_of_articles_with_links_and_odd_names_stay(part, said):
    body = "".join(f"<p>{' '.join(['Some words of the article that go on'] * 4)} {i}.</p>" for i in range(6))
    page = f"<html><body><header><p>Site</p></header><nav><ul><li><a href=1>Home</a></li></ul></nav><article><h1>Title here</h1>{body}{part}</article><div class=ad>Buy it</div><footer>c 2020</footer></body></html>"
    got = extraction.extract(page, extraction.model())
    assert said in got and got.startswith("Title here") and not {"Site", "Home", "Buy", "2020"} & set(got.split())


def test_decoding_is_the_most_probable_hierarchy():
    """Against all labellings of small trees in which no yes is under a no and the page is yes."""
    r = np.random.default_rng(6)
    for _ in range(60):
        n = int(r.integers(1, 9))
        nodes = [type("Node", (), {"parent": int(r.integers(0, i)) if i else -1})() for i in range(n)]
        odds = r.normal(0, 2, n)
        p = 1 / (1 + np.exp(-odds))
        best = (-1.0, None)
        for bits in range(1 << n):
            yes = [bool(bits >> i & 1) for i in range(n)]
            if yes[0] and all(yes[nodes[i].parent] or not yes[i] for i in range(1, n)):
                best = max(best, (float(np.prod([p[i] if yes[i] else 1 - p[i] for i in range(1, n) if yes[nodes[i].parent]])), yes))
        assert extraction.decode(nodes, odds) == best[1]
