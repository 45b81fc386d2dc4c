"""Operator 10: WARC derivatives of responses.

Every response gives two records that refer to it: a ``metadata`` record, whose block is JSON with the
response's WARC and HTTP headers and what its HTML says about itself (title, metas, links with
their text), and a ``conversion`` record, whose block is its plain text. Both keep the response's
identifier in WARC-Refers-To with its target URI and date, and carry the SHA-1 digest of their
own block; the metadata record also keeps the response's payload and block digests. A record's
identifier follows from the response's identifier and the record's type, so a lost task makes the same
records again. One response is read at a time inside Spark tasks; no shuffle is needed.

Defined cases: a null payload is an empty one: its text is empty and its metadata hold no title or links. A
response without an identifier gets one from its URI and payload. A null URI or date is left
out of the headers. Line breaks in header values become spaces. Equal responses give equal
records, one pair each. An unclosed comment, script or style runs to the end of the page.
An empty table gives no rows. Other columns of the responses are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, payload_digest string, source_headers string, block string"
)
#: Elements that end a line of text, and those whose content is not text.
LINES = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
HIDDEN = "script|style|noscript|template|textarea|iframe"

# Possessive throughout, so a long run without the closing character is read once.
SKIP = re.compile(rf"<!--.*?(?:-->|\Z)|<({HIDDEN})\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.I | re.S)
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"']*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""(?<![^\s=/"'<>])([^\s=/"'<>]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>]++))""")
REST = re.compile(r"<[/!?a-zA-Z][^<>]*+>")
BREAK = re.compile(rf"(?:{LINES})\Z", re.I)
SPACE = re.compile(r"[^\S\n]+")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(parts).encode('utf-8', 'replace')).digest(), version=5)}>"


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def squeeze(text: str) -> str:
    lines = (SPACE.sub(" ", line).strip() for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def read_page(payload: str, base: str | None) -> tuple[str, dict]:
    """(plain text, what the page says about itself) of an HTML page."""
    page = SKIP.sub(" ", payload)
    out, at = [], 0
    title, metas, links = None, [], []
    opened: list[tuple[str, int]] = []  # the link or title that is open, and where its text begins
    language = None
    for m in TAG.finditer(page):
        out.append(page[at : m.start()])
        at = m.end()
        name, closes = m[2].lower(), bool(m[1])
        if BREAK.match(name):
            out.append("\n")
        if name == "a":
            if closes and opened and opened[-1][0] == "a":
                links[-1]["text"] = squeeze("".join(out[opened.pop()[1] :])).replace("\n", " ")
            elif not closes:
                opened = [x for x in opened if x[0] != "a"]
                if "href" in (found := attributes(m[3])):
                    links.append({"url": link(base, found["href"]), "text": ""} | ({"rel": found["rel"]} if "rel" in found else {}))
                    opened.append(("a", len(out)))
        elif name == "title":
            if closes and opened and opened[-1][0] == "title":
                title = squeeze("".join(out[opened.pop()[1] :])).replace("\n", " ")
            elif not closes and title is None:
                opened.append(("title", len(out)))
        elif name == "meta" and not closes:
            metas.append(attributes(m[3]))
        elif name == "link" and not closes and "href" in (found := attributes(m[3])):
            links.append({"url": link(base, found["href"]), "text": ""} | ({"rel": found["rel"]} if "rel" in found else {}))
        elif name in ("img", "source") and not closes and "src" in (found := attributes(m[3])):
            links.append({"url": link(base, found["src"]), "text": found.get("alt", ""), "rel": name})
        elif name == "base" and not closes and "href" in (found := attributes(m[3])):
            base = link(base, found["href"])
        elif name == "html" and not closes:
            language = attributes(m[3]).get("lang")
    out.append(page[at:])
    return squeeze(REST.sub(" ", "".join(out))), {"title": title, "language": language, "metas": metas, "links": links}


def link(base: str | None, url: str) -> str:
    try:
        return urljoin(base or "", url.strip())
    except ValueError:  # not an address at all
        return url


def head(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value)).strip()


def derive(responses: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response, one row each.

    ``responses``: page_id, record_id, target_uri, date, http_headers (the text before the
    payload) and payload; all but payload may be null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                payload, http = r.payload or "", r.http_headers or ""
                raw = payload.encode("utf-8", "replace")
                whole = http.encode("utf-8", "replace") + b"\r\n" + raw
                uri = None if r.target_uri is None else head(r.target_uri)
                source = r.record_id or record_id("response", uri or "", payload)
                text, facts = read_page(payload, uri)
                own = {"WARC-Type": "response", "WARC-Record-ID": source, "WARC-Target-URI": uri, "WARC-Date": r.date, "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(whole)), "WARC-Block-Digest": digest(whole), "WARC-Payload-Digest": digest(raw)}
                own = {k: v for k, v in own.items() if v is not None}
                status, *fields = [line for line in http.split("\r\n") if line]or [None]
                envelope = {
                    "Envelope": {
                        "WARC-Header-Metadata": own,
                        "Payload-Metadata": {
                            "HTTP-Response-Metadata": {"Response-Message": status, "Headers": [[head(x) for x in f.split(":", 1)] for f in fields if ":" in f], "Entity-Length": len(raw), "Entity-Digest": own["WARC-Payload-Digest"], "HTML-Metadata": facts},
                        },
                    }
                }
                headers = "".join(f"{k}: {v}\r\n" for k, v in own.items())
                for kind, content, block in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True, separators=(",", ":"))), ("conversion", "text/plain; charset=utf-8", text)):
                    body = block.encode("utf-8", "replace")
                    rows.append((r.page_id, kind, record_id(source, kind), source, uri, r.date, content, len(body), digest(body), own["WARC-Payload-Digest"], headers, block))
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in FIELDS.split(", ")])
            yield out.astype({"page_id": "Int64", "content_length": "int64"})

    wanted = [F.col("page_id").cast("long").alias("page_id"), *[F.col(c).cast("string").alias(c) for c in ("record_id", "target_uri", "date", "http_headers", "payload")]]
    return responses.select(*wanted).mapInPandas(run, FIELDS)


def from_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Responses of a table of pages (page_id, url, html), under plain headers and the given date."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("\r\n"))
    return pages.select("page_id", F.lit(None).cast("string").alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), http.alias("http_headers"), F.col("html").alias("payload"))


def serialised(records: DataFrame) -> DataFrame:
    """``records`` with the whole WARC record as bytes in ``warc``."""
    line = lambda name, column: F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n"))).otherwise("")
    fields = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date")]
    fields += [("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("Content-Type", "content_type"), ("Content-Length", "content_length"), ("WARC-Block-Digest", "block_digest")]
    whole = F.concat(F.lit("WARC/1.1\r\n"), *[line(*f) for f in fields], F.lit("\r\n"), F.col("block"), F.lit("\r\n\r\n"))
    return records.withColumn("warc", F.encode(whole, "UTF-8"))


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one serialised record."""
    top, rest = record.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]
