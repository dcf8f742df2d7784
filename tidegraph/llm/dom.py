"""A small HTML reader: a flat tree of block nodes, with text pieces in page order."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

# Comments and declarations, or a tag: slash, name, attributes. Every part is taken at once and never given back, so that
# reading is linear; what is open at the end of the page (a comment, a tag, a quoted value) ends there, as in browsers.
TAG = re.compile(
    r"<!--(?:.*?-->|.*+)|<!\[CDATA\[(?:.*?\]\]>|.*+)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"?+|'[^']*+'?+)?+)*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Fixed values of HTML: elements without content, with raw content, and in running text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg object canvas select datalist noembed noframes annotation xmp".split())
#: Raw content that ends with the page where it is not closed; the others are left out only up to an end tag.
TO_THE_END = frozenset("script style textarea title iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mfenced mstyle mpadded semantics".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
#: What an implied end does not reach beyond.
SCOPE = frozenset("ul ol dl table article section div main aside nav form blockquote body html td th".split())
NAMED = ("class", "id", "role", "itemprop", "aria-label", "hidden", "style")


class Node:
    __slots__ = ("attrs", "children", "depth", "links", "own", "parent", "tag", "tags")

    def __init__(self, tag: str, parent: int, depth: int, attrs: dict[str, str]):
        self.tag, self.parent, self.depth, self.attrs = tag, parent, depth, attrs
        self.children: list[int] = []
        self.own = self.links = self.tags = 0


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    return out


class Raw:
    """Where raw content ends: the place after the end tag, looked for once beyond the last one."""

    def __init__(self, html: str):
        self.html, self.lower, self.none = html, "", set()

    def end(self, name: str, at: int) -> tuple[int, int]:
        """(end of the content, place after its end tag); the content is empty if there is no end tag and none is asked for."""
        found = -1
        if name not in self.none:
            if not self.lower:
                self.lower = self.html.lower()
                if len(self.lower) != len(self.html):  # a few letters grow
                    self.lower = self.html.translate(_LOWER)
            found = self.lower.find(f"</{name}", at)
        if found < 0:
            self.none.add(name)
            end = len(self.html) if name in TO_THE_END else at
            return end, end
        return found, self.lower.find(">", found) + 1 or len(self.html)


_LOWER = {c: c + 32 for c in range(65, 91)}


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes (the first is the page) and text pieces (node, text); a piece (node, "") is a block's edge.

    Character references are decoded. Script-like content, comments and declarations give no
    text; that of xmp is as written. Elements of running text are nodes only if they carry a
    class, id or role. Time is linear in the page: open elements are found by name, not by a walk.
    """
    nodes = [Node("#page", -1, 0, {})]
    pieces: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#page", 0)]  # element, node that text goes to
    opened: dict[str, list[int]] = {}  # places in the stack by element
    anchors = at = 0
    n = len(html)
    raws = Raw(html)

    def text(s: str) -> None:
        node = nodes[stack[-1][1]]
        size = len(s) - s.count(" ")
        node.own += size
        if anchors:
            node.links += size
        pieces.append((stack[-1][1], s))

    def decoded(a: int, b: int) -> str:
        s = html[a:b]
        return unescape(s) if "&" in s else s

    def push(name: str, node: int) -> None:
        opened.setdefault(name, []).append(len(stack))
        stack.append((name, node))

    def close(to: int) -> None:
        nonlocal anchors
        while len(stack) > to:
            tag, _ = stack.pop()
            opened[tag].pop()
            if tag == "a":
                anchors -= 1
            elif tag not in INLINE:
                pieces.append((stack[-1][1], ""))

    while True:
        m = TAG.search(html, at)
        if m is None:
            if at < n:
                text(decoded(at, n))
            break
        if m.start() > at:
            text(decoded(at, m.start()))
        at = m.end()
        name = m[2]
        if not name:
            continue
        name, raw = name.lower(), m[3]
        if m[1]:
            if opened.get(name):
                close(opened[name][-1])
            elif name in ("p", "br"):
                pieces.append((stack[-1][1], ""))
            continue
        here = stack[-1][1]
        nodes[here].tags += 1
        if name in VOID:
            if name in ("br", "hr"):
                pieces.append((here, " " if name == "br" else ""))
            continue
        if name in RAW:
            pieces.append((here, ""))
            if not raw.rstrip().endswith("/") or name in TO_THE_END:
                end, after = raws.end(name, at)
                if name == "xmp":
                    text(html[at:end])
                    pieces.append((here, ""))
                at = after
            continue
        if name in ENDS_P or name in ENDS:
            ends = (*ENDS.get(name, ()), "p")
            wall = max((opened[t][-1] for t in SCOPE if t not in ends and opened.get(t)), default=0)
            first = [p[i] for t in ends if (p := opened.get(t)) and (i := bisect_right(p, wall)) < len(p)]
            if first:
                close(min(first))
                here = stack[-1][1]
        attrs = attributes(raw) if raw and not raw.isspace() else {}
        inline = name in INLINE
        if name == "a":
            anchors += 1
        if inline and not ("class" in attrs or "id" in attrs or "role" in attrs):
            push(name, here)
            continue
        nodes[here].children.append(len(nodes))
        nodes.append(Node(name, here, nodes[here].depth + 1, {k: attrs[k] for k in NAMED if k in attrs}))
        if not inline:
            pieces.append((here, ""))
        push(name, len(nodes) - 1)
    return nodes, pieces


def joined(pieces, keep=None) -> str:
    """Text of the kept nodes' pieces: white space is one space, blocks are joined by one."""
    out = [(s or " ") for node, s in pieces if not s or keep is None or keep[node]]
    return " ".join("".join(out).split())


def tokens(node: Node) -> list[str]:
    """Words of a node's class, id, role and the like, in lower case."""
    named = " ".join(v for k, v in node.attrs.items() if k not in ("style", "hidden"))
    return [t.lower() for t in TOKEN.findall(named)] if named else []
