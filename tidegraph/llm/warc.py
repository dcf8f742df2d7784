"""WARC derivatives (operator 5): metadata and plain-text conversion records of responses."""

from __future__ import annotations

import codecs
import re
import zlib
from base64 import b32encode
from hashlib import sha1, sha256
from html import unescape

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import table
from tidegraph.llm.dom import INLINE, RAW, TAG, TO_THE_END, VOID, Raw, attributes

CHARSET = re.compile(r"""charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
META = re.compile(rb"""<meta\s[^<>]*?charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
# Byte order marks, and encodings that Python knows but pages don't use.
MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
NO_CHARSETS = frozenset("undefined idna punycode unicode_escape raw_unicode_escape".split())
#: Media types whose content is text, beside text/*, and the markup among them; no type at all counts as HTML.
TEXT = re.compile(r"text/.*|application/(?:.*\+)?(?:xhtml|xml|json|javascript|rss|atom|x-ndjson|yaml)(?:\+.*)?", re.I)
MARKUP = re.compile(r".*(?:html|xml|rss|atom).*", re.I)
#: The identification of derived records, from which their ids are made.
NAMESPACE = "derived"
OUT = (
    "record_id string, warc_type string, refers_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, source_payload_digest string, source_block_digest string, "
    "source_header string, header string, block string"
)


def record_id(*parts: str) -> str:
    """A uuid that depends on nothing but its parts (version 8: own scheme)."""
    h = sha256("\x1f".join(parts).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def digest(data: bytes) -> str:
    return "sha1:" + b32encode(sha1(data).digest()).decode()


def page_text(html: str) -> tuple[str, str, int]:
    """Plain text, title and number of links of a page, in one pass.

    The text is all that stands outside scripts, styles and comments; one line for each
    block. Links are anchors with an href; those in comments or scripts don't count.
    """
    out, at, title, links, raws = [], 0, "", 0, Raw(html)
    while (m := TAG.search(html, at)) is not None:
        out.append(unescape(html[at : m.start()]).replace("\n", " "))
        at = m.end()
        name = (m[2] or "").lower()
        if name in RAW and not m[1]:
            out.append("\n")
            if not m[3].rstrip().endswith("/") or name in TO_THE_END:
                end, after = raws.end(name, at)
                if name == "title" and not title:
                    title = " ".join(unescape(html[at:end]).split())
                if name == "xmp":
                    out += [html[at:end].replace("\n", " "), "\n"]
                at = after
        elif name and name not in INLINE and (name not in VOID or name in ("br", "hr")):
            out.append("\n")
        elif name == "a" and not m[1] and "href" in attributes(m[3]):
            links += 1
    out.append(unescape(html[at:]).replace("\n", " "))
    lines = (" ".join(x.split()) for x in "".join(out).split("\n"))
    return "\n".join(x for x in lines if x), title, links


def plain_text(html: str) -> str:
    return page_text(html)[0]


def http_parts(payload: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields (status line as the first) and body of an HTTP response; no header if there is none."""
    if not payload.startswith(b"HTTP/"):
        return [], payload
    for mark in (b"\r\n\r\n", b"\n\n"):
        if (i := payload.find(mark)) >= 0:
            head, body = payload[:i], payload[i + len(mark) :]
            break
    else:
        head, body = payload, b""
    fields = []
    for i, line in enumerate(head.decode("latin-1").splitlines()):
        name, _, value = (":status", "", line) if i == 0 else line.partition(":")
        if fields and line[:1] in (" ", "\t"):  # a folded line goes on
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        else:
            fields.append((name.strip().lower(), value.strip()))
    return fields, body


def _unchunked(body: bytes) -> bytes:
    """The content of a chunked body; what doesn't follow the form is kept as it is, from there on."""
    out, at = [], 0
    while at < len(body):
        end = body.find(b"\n", at)
        try:
            size = int(body[at:end].split(b";")[0].strip() or b"x", 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            out.append(body[at:])
            break
        if size == 0:
            break
        out.append(body[end + 1 : end + 1 + size])
        at = end + 1 + size
        at += 2 if body[at : at + 2] == b"\r\n" else int(body[at : at + 1] == b"\n")
    return b"".join(out)


def _inflated(body: bytes, coding: str) -> bytes | None:
    """The content under one content coding; null if it is unknown or damaged from the start. A cut stream gives what it holds."""
    if coding in ("", "identity"):
        return body
    try:
        if coding == "zstd":
            return zstandard.ZstdDecompressor().decompressobj().decompress(body)
        if coding in ("gzip", "x-gzip"):
            out, rest = [], body
            while rest[:2] == b"\x1f\x8b":  # members one after the other
                d = zlib.decompressobj(31)
                out += [d.decompress(rest), d.flush()]
                rest = d.unused_data
            return b"".join(out) if out or not body else None
        if coding == "deflate":
            d = zlib.decompressobj(15 if body[:1] == b"\x78" else -15)
            return d.decompress(body) + d.flush()
    except (zlib.error, zstandard.ZstdError):
        pass
    return None


def _decoded(body: bytes, content_type: str) -> tuple[str, str]:
    """Text and charset: by byte order mark, then Content-Type, then the first meta element that names one, else UTF-8."""
    name = next((n for mark, n in MARKS if body.startswith(mark)), None)
    found = None if name else CHARSET.search(content_type) or META.search(body)
    if found:
        name = found[1] if isinstance(found[1], str) else found[1].decode()
    name = (name or "utf-8").lower()
    try:
        if codecs.lookup(name).name not in NO_CHARSETS:
            return body.decode(name, "replace").removeprefix("\ufeff"), name
    except (LookupError, UnicodeError, ValueError):
        pass
    return body.decode("utf-8", "replace"), "utf-8"


def _fields(header: str) -> list[tuple[str, str]]:
    """Named fields of a record header, folded lines joined; the version line and other lines without a colon are left out."""
    out: list[tuple[str, str]] = []
    for line in header.splitlines():
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def _header(kind: str, rid: str, refers: str, uri: str, date: str, media: str, block: bytes, source: str, source_block: str) -> str:
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Refers-To", refers),
        ("WARC-Block-Digest", digest(block)), ("WARC-Source-Payload-Digest", source), ("WARC-Source-Block-Digest", source_block),
        ("Content-Type", media), ("Content-Length", str(len(block))),
    ]
    one_line = lambda v: " ".join(v.split())
    return "WARC/1.1\r\n" + "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields) + "\r\n"


def derive_one(rid: str, uri: str, date: str, payload: bytes, header: str = "") -> list[tuple]:
    """The metadata and the conversion record of one response record; see derive."""
    given = _fields(header)
    warc = dict(reversed(given))
    uri, date = uri or warc.get("warc-target-uri", ""), date or warc.get("warc-date", "")
    fields, body = http_parts(payload)
    http = dict(reversed(fields))
    given_digests = [(k, warc.get(f"warc-{k}-digest", ""), data) for k, data in (("payload", body), ("block", payload))]
    source, block_digest = (said or digest(data) for _, said, data in given_digests)
    content: bytes | None = _unchunked(body) if "chunked" in http.get("transfer-encoding", "").lower() else body
    for coding in reversed(http.get("content-encoding", "").lower().split(",")):
        content = _inflated(content, coding.strip()) if content is not None else None
    media = http.get("content-type", "")
    kind = media.split(";")[0].strip()
    readable = content is not None and (not kind or TEXT.fullmatch(kind) is not None)
    facts = [("source-payload-digest", source), ("source-block-digest", block_digest), ("content-bytes", str(len(body)))]
    facts += [(f"{k}-digest-matches", str(digest(data) == said).lower()) for k, said, data in given_digests if said.lower().startswith("sha1:")]
    facts += [(f"source-{k}", v) for k, v in given] + [(f"http-{k.strip(':')}", v) for k, v in fields]
    text = ""
    if readable:
        text, charset = _decoded(content or b"", media)
        facts += [("charset-detected", charset)]
        if not kind or MARKUP.fullmatch(kind):
            text, title, links = page_text(text)
            facts += ([("title", title)] if title else []) + [("links", str(links))]
        facts += [("conversion", record_id(NAMESPACE, "conversion", rid))]
    else:
        facts += [("no-conversion", "content coding" if content is None else "media type")]
    note = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in facts)
    out = []
    for name, form, block in (("metadata", "application/warc-fields", note), ("conversion", "text/plain; charset=utf-8", text))[: 1 + readable]:
        own, data = record_id(NAMESPACE, name, rid), block.encode("utf-8", "replace")
        head = _header(name, own, rid, uri, date, form, data, source, block_digest)
        out.append((own, name, rid, uri, date, form, len(data), digest(data), source, block_digest, header, head, data.decode()))
    return out


def _derive(batches):
    names = [x.split()[0] for x in OUT.split(", ")]
    kinds = [pa.int64() if n == "content_length" else pa.string() for n in names]
    for b in batches:
        rows = []
        for rid, uri, date, payload, header in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if rid is not None:
                rows += derive_one(rid, uri or "", date or "", payload or b"", header or "")
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


def derive(responses: DataFrame) -> DataFrame:
    """A metadata and a conversion record per response record, each with the response's id in refers_to.

    responses: record_id, target_uri, warc_date (texts), payload (binary: the HTTP response
    with its headers, or a bare body) and, if there, warc_header (the source record's own
    header lines). header and block together are the record's bytes (then comes an empty line
    twice). The source's header is kept in source_header, and each of its fields and of the
    HTTP fields stands in the metadata. Its digests are carried over as given; where there are
    none they are computed. Given SHA-1 ones are also held against the bytes. An empty uri or
    date is taken from the header.

    Chunked bodies and gzip, deflate and zstd content are read; any charset is survived (an
    unknown one is read as UTF-8, bytes that can't be decoded become U+FFFD). Under another
    content coding, or a media type that isn't text, there is a metadata record alone, which
    says so. Text other than markup is taken as it is.

    Ids are made from the response's id, so reruns give the same records and the two records
    name each other. A null id can't be referred to: such rows give nothing; other nulls are
    empty. Repeated rows give repeated records; no rows give none; other columns are ignored.
    A scan without shuffles.
    """
    header = F.col("warc_header").cast("string") if "warc_header" in responses.columns else F.lit("")
    return responses.select(
        F.col("record_id").cast("string"), F.col("target_uri").cast("string"), F.col("warc_date").cast("string"), F.col("payload").cast("binary"), header.alias("warc_header")
    ).mapInArrow(_derive, OUT)


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as response records with their headers. A null page_id or url counts as the text "null"."""
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce(F.col("url").cast("string"), F.lit("null")))
    h = F.sha2(key, 256)
    part = lambda a, n: F.substring(h, a, n)
    rid = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    payload = F.concat(head.cast("binary"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary"))
    own = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: "), rid, F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(payload).cast("string"))
    return pages.select(rid.alias("record_id"), F.col("url").cast("string").alias("target_uri"), F.lit(date).alias("warc_date"), payload.alias("payload"), own.alias("warc_header"))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records for every page."""
    return derive(responses_of(table(spark, sf_dir, "pages")))
