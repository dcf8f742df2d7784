"""HTML main-text extraction (operator 2): boosted trees over DOM nodes, decoded as a hierarchy.

A node is labelled yes if its subtree holds main text. The trees learn that label for nodes
under a yes parent; they see a node's and its parent's tag, words of attributes, depth,
subtree density and sibling statistics. The decoding chooses the
most probable labelling in which no node is yes under a no: an ancestor and its descendant
can't contradict each other. Text that belongs to yes nodes is the main text.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import table
from tidegraph.llm.dom import joined, parse, tokens
from tidegraph.llm.gbt import Boosted

# Words in class, id and role attributes, by what they tell.
WORDS = {
    "main": "article content main post entry story text body maincontent articlebody prose page paragraph",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "head": "header masthead topbar banner logo brand branding",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar aside side rail widget widgets related recommended trending popular more complementary tags archive",
    "note": "cookie cookies consent notice notification alert popup modal overlay newsletter subscribe subscription signup gdpr banner disclaimer",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion outbrain taboola adsense dfp",
    "talk": "comment comments reply replies respond discussion disqus thread reviews commentlist responses",
    "form": "form search login register searchbox button input contact survey poll",
    "share": "share sharing social follow facebook twitter tools print byline author meta",
}
WORD_OF = {w: i for i, ws in enumerate(WORDS.values()) for w in reversed(ws.split())}
TAGS = (
    "article main section div p h1 h2 li ul table td blockquote figure nav header footer aside form span body dl".split()
)
TAG_OF = {t: i for i, t in enumerate(TAGS)} | {
    "h3": 6, "h4": 6, "h5": 6, "h6": 6, "ol": 8, "menu": 8, "th": 10, "tr": 9, "tbody": 9, "pre": 11, "figcaption": 12,
    "button": 17, "label": 17, "fieldset": 17, "legend": 17, "dialog": 17, "center": 3, "dt": 20, "dd": 20, "html": 19, "#page": 19,
}
JUNK_TAGS = frozenset("nav header footer aside form button label fieldset dialog menu".split())
N_WORDS, N_TAGS = len(WORDS), len(TAGS) + 1


def _log2(x: int) -> int:
    return min(15, x.bit_length())


def features(html_nodes) -> np.ndarray:
    """One row per node of a page."""
    nodes = html_nodes
    n = len(nodes)
    text, links, tags = [x.own for x in nodes], [x.links for x in nodes], [x.tags for x in nodes]
    paras = [0] * n
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        text[p] += text[i]
        links[p] += links[i]
        tags[p] += tags[i]
        paras[p] += paras[i] + (nodes[i].tag == "p")
    before, seen = [0] * n, 0
    for i in range(n):
        before[i] = seen
        seen += nodes[i].own
    total = max(1, text[0])
    place = [0] * n
    for x in nodes:
        for at, c in enumerate(x.children):
            place[c] = at
    above = [[0] * (N_WORDS + 1) for _ in range(n)]
    rows = []
    for i, x in enumerate(nodes):
        own = [0] * N_WORDS
        for t in tokens(x):
            if t in WORD_OF:
                own[WORD_OF[t]] = 1
        junk = x.tag in JUNK_TAGS
        if i:
            up = above[x.parent]
            above[i] = [a | b for a, b in zip(up, [*own, junk], strict=True)]
            brothers = nodes[x.parent].children
            k, at = len(brothers), place[i]
            around = text[x.parent]
        else:
            up, k, at, around = [0] * (N_WORDS + 1), 1, 0, text[0]
            above[i] = [*own, int(junk)]
        tag = [0] * N_TAGS
        tag[TAG_OF.get(x.tag, N_TAGS - 1)] = 1
        hidden = int("hidden" in x.attrs or "none" in x.attrs.get("style", ""))
        rows.append([
            *tag, *own, *up, TAG_OF.get(nodes[x.parent].tag, N_TAGS - 1) if i else 31, hidden, min(31, x.depth), _log2(text[i]), _log2(x.own), int(15 * links[i] / max(1, text[i])),
            _log2(text[i] // (tags[i] + 1)), min(15, len(x.children)), min(15, k), min(15, at), int(15 * at / k),
            int(31 * text[i] / total), int(31 * before[i] / total), int(15 * text[i] / max(1, around)), min(15, paras[i]),
            _log2(around // k), *(int(any(nodes[c].tag in heads for c in x.children)) for heads in (("h1", "h2"), ("h3", "h4", "h5", "h6"))),
        ])
    return np.array(rows, np.uint8)


def decode(nodes, odds: np.ndarray) -> list[bool]:
    """The most probable labelling in which every yes has a yes parent; the page itself is yes.

    odds are those of a node whose parent is yes; below a no everything is no.
    """
    yes, no = np.logaddexp(0, -odds) * -1, np.logaddexp(0, odds) * -1
    keep, drop = yes.tolist(), no.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        keep[p] += max(keep[i], drop[i])
    out = [True] * len(nodes)
    for i in range(1, len(nodes)):
        out[i] = out[nodes[i].parent] and keep[i] > drop[i]
    return out


# ---- training pages: drawn from a grammar of layouts, with known labels ----


class _Writer:
    """Writes a page; text in <main> scope is what should be extracted."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.hints = self.r.random() < 0.8

    def words(self, low: int, high: int) -> str:
        syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it le la de qui un sch ein ge ver el os ci".split()
        one = lambda: "".join(self.r.choice(syllables) for _ in range(self.r.randint(1, 4)))
        s = [one() for _ in range(self.r.randint(low, high))]
        s[0] = s[0].capitalize()
        return " ".join(s) + self.r.choice([".", ".", "", "!"])

    def cls(self, *names: str) -> str:
        if not self.hints and self.r.random() < 0.7:
            return ""
        return f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(names)}"'

    def menu(self) -> str:
        items = "".join(f'<li><a href="/{i}">{self.words(1, 2)}</a></li>' for i in range(self.r.randint(3, 9)))
        return f"<ul>{items}</ul>" if self.r.random() < 0.8 else items.replace("<li>", "").replace("</li>", " | ")

    def junk(self, kind: str) -> str:
        r, w = self.r, self.words
        links = self.menu()
        line = lambda a, b: f"<p>{w(a, b)}</p>"
        if kind == "nav":
            return r.choice([f"<nav{self.cls('nav', 'menu')}>{links}</nav>", f"<div{self.cls('menu', 'navbar', 'main-nav')}>{links}</div>"])
        if kind == "head":
            inner = f"<div{self.cls('logo', 'site-title')}>{w(1, 3)}</div><p>{w(2, 6)}</p>" + (links if r.random() < 0.3 else "")
            return r.choice([f"<header{self.cls('header')}>{inner}</header>", f"<div{self.cls('header', 'masthead', 'site-header')}>{inner}</div>"])
        if kind == "foot":
            inner = r.choice([f"&copy; {w(2, 9)}", f"<p>{w(3, 12)}</p>{links}", links])
            return r.choice([f"<footer>{inner}</footer>", f"<footer{self.cls('footer')}>{inner}</footer>", f"<div{self.cls('footer', 'site-footer')}>{inner}</div>"])
        if kind == "side":
            inner = f"<h3>{w(1, 3)}</h3>" + r.choice([links, line(5, 30), line(4, 20) + links])
            return r.choice([f"<aside{self.cls('sidebar', 'related')}>{inner}</aside>", f'<div class="{r.choice(["sidebar", "widget", "related-posts", "right-rail"])}">{inner}</div>'])
        if kind == "note":
            return f'<div{r.choice([" class=", " id="])}"{r.choice(["cookie-notice", "cookie-banner", "consent", "notice", "newsletter", "popup", "alert"])}">{r.choice([line(5, 25), w(5, 20)])}{r.choice(["", "<button>" + w(1, 2) + "</button>"])}</div>'
        if kind == "ad":
            tag = r.choice(["div", "div", "aside", "section"])
            return f'<{tag}{r.choice([" class=", " id="])}"{r.choice(["ad", "ads", "advert", "advertisement", "ad-box", "sponsored", "promo"])}">{r.choice([w(3, 15), line(4, 25)])}</{tag}>'
        if kind == "form":
            return f"<form{self.cls('search', 'login', 'contact-form')}><label>{w(1, 3)}</label><input name=q><button>{w(1, 2)}</button></form>"
        if kind == "share":
            return f'<div class="{r.choice(["share", "social", "share-buttons"])}">{links}</div>'
        one = lambda: r.choice([
            f'<div class="comment"><b>{w(1, 2)}</b><p>{w(4, 50)}</p></div>', f"<li>{w(4, 40)}</li>", f"<p>{w(4, 50)}</p>", f'<article class="comment"><p>{w(4, 40)}</p></article>',
        ])
        name = r.choice(["comments", "comments", "comment-list", "discussion", "responses", "disqus"])
        tag = r.choice(["section", "div", "aside", "ul"])
        return f'<{tag} {r.choice(["class", "id"])}="{name}"><h3>{w(1, 3)}</h3>{"".join(one() for _ in range(r.randint(1, 6)))}</{tag}>'

    def sources(self) -> str:
        """A list of links that belongs to the article."""
        r, w = self.r, self.words
        item = lambda: f'<a href="http://{r.randrange(99)}">{w(2, 14)}</a>' + (f" {w(1, 6)}" if r.random() < 0.3 else "")
        tag = r.choice(["ul", "ul", "ol"])
        return r.choice(["", f"<h2>{w(1, 3)}</h2>", f"<p>{w(2, 9)}</p>"]) + f"<{tag}>{''.join(f'<li>{item()}</li>' for _ in range(r.randint(2, 9)))}</{tag}>"

    def division(self) -> str:
        """A part of the article whose name has a word that other parts of pages are known by."""
        r, w = self.r, self.words
        known = [x for k in ("side", "form", "talk", "share", "head") for x in WORDS[k].split()]
        name = r.choice([f"{r.choice(known)}-{w(1, 1).strip('.!').lower()}", f"{w(1, 1).strip('.!').lower()}-{r.choice(known)}", w(1, 2).strip(".!").lower().replace(" ", "-")])
        inner = "".join(f"<p>{w(12, 90)}</p>" for _ in range(r.randint(1, 3))) if r.random() < 0.8 else w(20, 90)
        tag = r.choice(["div", "div", "section"])
        return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">{r.choice(["", f"<h2>{w(1, 4)}</h2>"])}{inner}</{tag}>'

    def body(self) -> str:
        r, w = self.r, self.words
        small = r.random() < 0.35
        style = r.choice(["p", "p", "p", "div", "br", "open"])
        out = []
        for _ in range(r.randint(0, 2) if small else r.randint(2, 12) if r.random() < 0.7 else r.randint(12, 60)):
            t = w(1, 3) if r.random() < 0.15 else w(1, 12) if r.random() < 0.25 else w(10, 90)
            if r.random() < 0.2:
                t = t.replace(" ", ' <a href="x">' + w(1, 2) + "</a> ", 1)
            out.append({"p": f"<p>{t}</p>", "div": f"<div>{t}</div>", "br": f"{t}<br>", "open": f"<p><b>{t}<br>"}[style])
            extra = r.random()
            if extra < 0.06:
                out.append(f"<h2>{w(2, 7)}</h2>")
            elif extra < 0.1:
                out.append(f"<ul>{''.join(f'<li>{w(3, 15)}</li>' for _ in range(r.randint(2, 5)))}</ul>")
            elif extra < 0.13:
                out.append(f"<blockquote><p>{w(8, 40)}</p></blockquote>")
            elif extra < 0.15:
                out.append(f"<table><tr><td>{w(1, 5)}</td><td>{w(1, 5)}</td></tr></table>")
            elif extra < 0.17:
                out.append(f"<figure><figcaption>{w(3, 10)}</figcaption></figure>")
            elif extra < 0.19:
                out.append(f"<p>{t[:30]}<br><p>{w(1, 9)}</p>")
            elif extra < 0.24:
                out.append("\0" + self.junk(r.choice(["ad", "ad", "note", "side", "share", "form"])) + "\1")
            elif extra < 0.28:
                out.append(self.sources())
            elif extra < 0.36:
                out.append(self.division())
        if r.random() < 0.8 or not out:
            out.insert(0, f"<h1>{w(3, 12)}</h1>")
        if r.random() < 0.1:
            out.append(self.sources())
        if r.random() < 0.2:
            out.append("\0" + self.junk(r.choice(["share", "talk", "side", "foot"])) + "\1")
        return "".join(out)

    def page(self) -> str:
        """The page with control marks: \2 ... \3 around main text, \0 ... \1 around junk in it."""
        r = self.r
        inner = f"\2{self.body()}\3"
        wrap = r.choice(["article", "article", "article", "main", "div", "section"])
        inner = f"<{wrap}{self.cls('content', 'post', 'entry-content', 'article-body', 'story', 'main')}>{inner}</{wrap}>"
        after = "".join(self.junk(k) for k in ("talk", "side", "ad", "form", "share") if r.random() < 0.25)
        if r.random() < 0.4:
            outer = r.choice(["main", "div", "section"])
            side = self.junk("side") if r.random() < 0.4 else ""
            inner = f"<{outer}{self.cls('container', 'wrapper', 'page', 'main')}>{side if r.random() < 0.3 else ''}{inner}{after}{side}</{outer}>"
            after = ""
        top = "".join(self.junk(k) for k in ("note", "head", "nav", "ad") if r.random() < 0.6)
        end = "".join(self.junk(k) for k in ("side", "note", "form", "ad") if r.random() < 0.25)
        end += self.junk("foot") if r.random() < 0.85 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{top}{inner}{after}{end}</body></html>"


MARKS = str.maketrans("", "", "\0\1\2\3")


def _labels(nodes, pieces) -> np.ndarray:
    """yes for nodes with main text in them. Pieces are walked in page order with the marks."""
    out = np.zeros(len(nodes), bool)
    main = junk = False
    for node, s in pieces:
        has = False
        for c in s:
            if c in "\2\3":
                main = c == "\2"
            elif c in "\0\1":
                junk = c == "\0"
            elif main and not junk and not c.isspace():
                has = True
        if has:
            while node >= 0 and not out[node]:
                out[node] = True
                node = nodes[node].parent
    return out


@lru_cache(maxsize=2)
def model(pages: int = 1000, seed: int = 7) -> Boosted:
    """Trained on `pages` drawn pages: a fixed, bounded amount of work on the driver."""
    xs, ys = [], []
    for i in range(pages):
        html = _Writer(seed * 1_000_003 + i).page()
        marked, pieces = parse(html)
        nodes, _ = parse(html.translate(MARKS))
        if len(nodes) == len(marked):
            y = _labels(marked, pieces)
            under = np.array([i > 0 and bool(y[x.parent]) for i, x in enumerate(nodes)])
            xs.append(features(nodes)[under])
            ys.append(y[under])
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def extract(html: str | None, trees: Boosted) -> str:
    return _extract_all([html], trees)[0]


BATCH_NODES = 50_000


def _extract_all(pages, trees: Boosted) -> list[str]:
    out: list[str] = []
    held: list = []
    xs: list[np.ndarray] = []
    n = 0

    def flush():
        nonlocal n
        if held:
            odds = trees.predict(np.concatenate(xs))
            at = 0
            for nodes, pieces in held:
                out.append(joined(pieces, decode(nodes, odds[at : at + len(nodes)])))
                at += len(nodes)
        held.clear()
        xs.clear()
        n = 0

    for html in pages:
        nodes, pieces = parse(html or "")
        held.append((nodes, pieces))
        xs.append(features(nodes))
        n += len(nodes)
        if n >= BATCH_NODES:
            flush()
    flush()
    return out


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row. A null or blank html has an empty text.

    Whole pages are read, nothing is cut; repeated rows give repeated rows; other columns are
    ignored; an empty table gives no rows. A plain scan: nothing is shuffled.
    """
    trees = pages.sparkSession.sparkContext.broadcast(model())

    def run(batches):
        for b in batches:
            texts = _extract_all(b.column(2).to_pylist(), trees.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def op2_html_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page."""
    return extract_pages(table(spark, sf_dir, "pages"))
