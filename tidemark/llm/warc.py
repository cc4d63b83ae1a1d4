"""Metadata and plain-text conversion records from web responses."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What ends a tag name; ``\b`` would also end it within a custom element such as <title-bar>.
_NAME_END = r"(?=[\s/>])"
_HIDDEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title){_NAME_END}[^>]*+(?:>|\Z).*?(?:</\1\s*>|\Z)",
    re.S | re.I,
)
_BLOCK = (
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hr html li main nav ol option p pre section table tbody td tfoot th thead tr ul"
)
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+>|</?[a-zA-Z!?][^>]*+>?")
_OPENED = re.compile(r"<([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TITLE = re.compile(rf"<title{_NAME_END}[^>]*+(?:>|\Z)(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LANGUAGE = re.compile(r"[A-Za-z-]+")
_BLOCKS = frozenset(_BLOCK.split())


def plain_text(page: str | None) -> str:
    """Visible text of a page, one line per block, blanks collapsed.

    Comments, scripts, styles and the title are left out; what a cut-off page
    leaves open runs to its end.
    """

    def gap(m: re.Match[str]) -> str:
        return "\n" if (m[1] or "").lower() in _BLOCKS else ""

    text = _TAG.sub(gap, _HIDDEN.sub("", page or "").replace("\n", " "))
    lines = (" ".join(html.unescape(line).split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def _attribute(tag: str, start: int, name: str) -> str | None:
    """The first value that an attribute of a tag is given; values in quotes are passed over as a whole."""
    for m in _ATTRIBUTE.finditer(tag, start):
        value = next((v for v in m.groups()[1:] if v is not None), None)
        if value is not None and m[1].lower() == name:
            return value
    return None


def page_facts(page: str | None) -> dict:
    """Title, language and links of a page.

    One walk over its tags; attributes are looked for inside each, so the time
    grows with the page, whatever its tags leave open.
    """
    page = page or ""
    shown = _HIDDEN.sub(lambda m: m[0] if (m[1] or "").lower() == "title" else "", page)
    title, lang, links = _TITLE.search(shown), None, []
    for m in _TAG.finditer(shown):
        opened = _OPENED.match(m[0])
        name = opened[1].lower() if opened else ""
        if name == "a":
            link = _attribute(m[0], opened.end(), "href")
            if link is not None:
                links.append(html.unescape(link))
        elif name == "html" and lang is None:
            found = _LANGUAGE.match(_attribute(m[0], opened.end(), "lang") or "")
            lang = found[0] if found else None
    return {"title": " ".join(html.unescape(title[1]).split()) if title else None, "lang": lang, "links": links}


def digest(block: bytes) -> str:
    """SHA-1 in base 32, as WARC headers carry it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    """The id of a derivative: always the same for the same source and kind."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}>"


def responses(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Response records of crawled pages: key, record_id, target_uri, date, http_headers, payload.

    The record id follows from key, address and content. The crawl date is not
    in the table, so it is given. A null page has an empty payload, a null
    address an empty target.
    """
    address, content = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(page), F.lit(""))
    hashed = F.md5(F.concat_ws("\n", F.coalesce(F.col(key).cast("string"), F.lit("")), address, F.md5(content)))
    return pages.select(
        F.col(key).alias("key"),
        F.regexp_replace(hashed, "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>").alias("record_id"),
        address.alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            F.octet_length(content).cast("string"),
            F.lit("\r\n\r\n"),
        ).alias("http_headers"),
        content.alias("payload"),
    )


FIELDS = {
    "type": "string",
    "record_id": "string",
    "refers_to": "string",
    "concurrent_to": "string",
    "target_uri": "string",
    "date": "string",
    "content_type": "string",
    "block_digest": "string",
    "source_payload_digest": "string",
    "content_length": "long",
    "block": "string",
}


def _derive(record_id: str, uri: str, date: str, headers: str, payload: str) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    text = plain_text(payload)
    source_digest = digest(payload.encode("utf-8", "surrogatepass"))
    ids = {kind: derived_id(record_id, kind) for kind in ("metadata", "conversion")}
    status, _, rest = headers.rstrip("\r\n").partition("\r\n")
    facts = {
        "Envelope": {
            "WARC-Header": {
                "WARC-Type": "response",
                "WARC-Record-ID": record_id,
                "WARC-Target-URI": uri,
                "WARC-Date": date,
                "WARC-Payload-Digest": source_digest,
            },
            "HTTP-Response": {
                "Status-Line": status,
                "Headers": [line.partition(": ")[::2] for line in rest.split("\r\n") if line],
            },
            "HTML": page_facts(payload),
        },
        "Conversion": ids["conversion"],
    }
    blocks = {
        "metadata": ("application/json", json.dumps(facts, ensure_ascii=False)),
        "conversion": ("text/plain; charset=utf-8", text),
    }
    out = []
    for kind, (content_type, block) in blocks.items():
        raw = block.encode("utf-8", "surrogatepass")
        other = ids["conversion" if kind == "metadata" else "metadata"]
        out.append(
            (kind, ids[kind], record_id, other, uri, date, content_type, digest(raw), source_digest, len(raw), block)
        )
    return out


def derivatives(source: DataFrame, block_rows: int = 512) -> DataFrame:
    """Two linked records for every response: ``metadata`` (JSON) and ``conversion`` (text).

    ``source`` has the columns of ``responses``. Both records refer to the
    response by ``refers_to``, keep its target and date and its payload digest,
    and name each other in ``concurrent_to``; the metadata holds the source's
    WARC and HTTP headers, title, language and links. Nulls read as empty
    strings; an empty page has an empty conversion. Repeated responses have
    records with the same ids. Other columns are ignored; the plan is narrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, block_rows):
                batch = whole.slice(start, block_rows)
                rows = [
                    record
                    for fields in zip(*(batch.column(i) for i in range(1, 6)))
                    for record in _derive(*(f.as_py() or "" for f in fields))
                ]
                at = pa.array([i for i in range(batch.num_rows) for _ in range(2)], pa.int64())
                columns = [pa.array(list(c), pa.int64() if n == "content_length" else pa.string()) for n, c in zip(FIELDS, zip(*rows))]
                yield pa.record_batch([batch.column(0).take(at), *columns], ["key", *FIELDS])

    source = source.select("key", "record_id", "target_uri", "date", "http_headers", "payload")
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, " + ", ".join(f"{k} {v}" for k, v in FIELDS.items()))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes derivative records as WARC/1.1 text, one file per partition.

    A record ends with two line breaks, which is what the text sink puts
    between rows, so files are written by whatever store Spark can reach.
    """
    names = {
        "WARC-Type": "type",
        "WARC-Record-ID": "record_id",
        "WARC-Refers-To": "refers_to",
        "WARC-Concurrent-To": "concurrent_to",
        "WARC-Target-URI": "target_uri",
        "WARC-Date": "date",
        "WARC-Block-Digest": "block_digest",
        # A field of our own: WARC-Payload-Digest would speak of the record's own payload.
        "WARC-Source-Payload-Digest": "source_payload_digest",
        "Content-Type": "content_type",
        "Content-Length": "content_length",
    }
    head = [F.lit("WARC/1.1\r\n")]
    for header, column in names.items():
        # Line breaks in an address would end the header.
        value = F.regexp_replace(F.col(column).cast("string"), "[\r\n]", "")
        head += [F.when(value != "", F.concat(F.lit(f"{header}: "), value, F.lit("\r\n"))).otherwise("")]
    row = F.concat(*head, F.lit("\r\n"), F.col("block"))
    records.select(row.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)
