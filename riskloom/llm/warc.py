"""Derivatives of WARC responses: linked metadata records and plain-text conversion records.

A response record is parsed into its WARC headers, its HTTP headers and its payload. The metadata
record holds, as JSON, the response's WARC and HTTP headers, its digests, the title and the links;
the conversion record holds the page's text. Both name the response in WARC-Refers-To, with its
target URI and date, and carry its payload digest on. Record IDs are made from what they name, so
that a task that runs again writes the same records.

Defined results: a page without HTML is a response with an empty payload and has an empty title and
text; one without URL has no target URI; a payload that is not UTF-8 is read with replacement
characters; repeated rows give the same records again; an empty table gives none. A record that
cannot be parsed is an error. Other columns are passed over.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VERSION = b"WARC/1.1"
_SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
_UNSEEN = ("script", "style", "template", "noscript", "head")
_OPENER = re.compile(rf"<(?:(!--)|(!doctype)|({'|'.join(_UNSEEN)})\b)", re.I)
_CLOSER = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_UNSEEN, "title")}
_BREAKS = re.compile(r"</?(?:p|br|div|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|main|blockquote|pre|hr|title)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]+>")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r"[^\S\n]*\n\s*")
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_LINKING = re.compile(r"<(a|area|link|img|script|iframe)\b", re.I)
_ADDRESS = re.compile(r"\s(href|src)\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")


@dataclass
class Record:
    """A WARC record: header fields in order, and the block."""

    fields: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        for key, value in self.fields:
            if key.lower() == name.lower():
                return value
        return None

    def dump(self) -> bytes:
        head = b"".join(f"{k}: {v}\r\n".encode() for k, v in self.fields)
        return VERSION + b"\r\n" + head + b"\r\n" + self.block + b"\r\n\r\n"

    def member(self) -> bytes:
        """The record as one gzip member; members one after the other are a WARC file."""
        return gzip.compress(self.dump(), compresslevel=6, mtime=0)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_ID, chr(10).join(names))}>"


def parse(data: bytes) -> Iterator[Record]:
    """The records of WARC bytes, which may be gzip members."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields: list[tuple[str, str]] = []
        for line in lines[1:]:
            if line[:1] in b" \t" and fields:  # a folded line goes on
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.decode().strip()}")
            else:
                key, _, value = line.decode().partition(":")
                fields.append((key, value.strip()))
        record = Record(fields, b"")
        size = int(record.get("Content-Length") or 0)
        record.block = data[head_end + 4 : head_end + 4 + size]
        if len(record.block) != size:
            raise ValueError("a WARC record ends early")
        yield record
        at = head_end + 4 + size + 4


def _line(value: str) -> str:
    """A header's value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def response(url: str | None, payload: bytes, date: str, status: str = "200 OK") -> Record:
    """A response record around a payload."""
    http = (
        f"HTTP/1.1 {status}\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block, body = http + payload, digest(payload)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", url or "", date, body)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _line(url)))
    fields += [
        ("WARC-Payload-Digest", body),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return Record(fields, block)


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, payload) of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    headers = [(k, v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    return lines[0], headers, payload


def _seen(page: str) -> str:
    """The page with a blank in place of each comment, document type and element that shows no text. One
    pass: an end that was once looked for in vain is not looked for again."""
    out, done, at, missing = [], 0, 0, set()
    while found := _OPENER.search(page, at):
        name = (found[1] or found[2] or found[3]).lower()
        end = -1
        if name not in missing:
            end = _end_of(page, name, found.end())
            if end < 0:
                missing.add(name)
        if end < 0:
            at = found.end()
            continue
        out += [page[done : found.start()], " "]
        done = at = end
    return "".join([*out, page[done:]])


def _end_of(page: str, name: str, at: int) -> int:
    """Where what begins there ends, -1 if it does not."""
    if name == "!--":
        end = page.find("-->", at)
        return end + 3 if end >= 0 else -1
    opened = page.find(">", at) + 1
    if not opened or name == "!doctype":
        return opened or -1
    closed = _CLOSER[name].search(page, opened)
    return closed.end() if closed else -1


def plain_text(page: str) -> str:
    """The text of a page: blocks as lines, blanks joined, entities resolved."""
    body = _seen(page).replace("\n", " ")
    last = body.rfind(">") + 1  # behind it no tag ends, so none is looked for
    body = _TAG.sub("", _BREAKS.sub("\n", body[:last])) + body[last:]
    body = _BLANKS.sub(" ", html.unescape(body))
    return _LINES.sub("\n", body).strip()


def links(page: str, base: str | None) -> list[dict[str, str]]:
    out, at = [], 0
    while tag := _LINKING.search(page, at):
        found = _link_in(page, tag.end())
        if not found:
            # No other tag before this one's end has an address either.
            at = page.find(">", tag.end()) + 1
            if not at:
                break
            continue
        kind, value, at = found
        target = html.unescape(value)
        if base:
            try:
                target = urljoin(base, target)
            except ValueError:
                pass  # the link stays as written
        out.append({"path": f"{tag[1].lower()}@/{kind}", "url": target})
    return out


def _link_in(page: str, at: int) -> tuple[str, str, int] | None:
    """(attribute, value, end) of the first address before the next ``>``."""
    end = page.find(">", at)
    end = len(page) if end < 0 else end
    while named := _ADDRESS.search(page, at, end):
        if value := _VALUE.match(page, named.end()):
            return named[1].lower(), next(v for v in value.groups() if v is not None), value.end()
        at = named.start() + 1
    return None


def title(page: str) -> str:
    opened = _TITLE.search(page[: page.rfind(">") + 1])
    closed = opened and _CLOSER["title"].search(page, opened.end())
    return " ".join(html.unescape(page[opened.end() : closed.start()]).split()) if closed else ""


def derive(source: Record) -> tuple[Record, Record]:
    """(metadata, conversion) of a response."""
    status, headers, payload = http_parts(source.block)
    page = payload.decode("utf-8", "replace")
    own_id, url = source.get("WARC-Record-ID") or "", source.get("WARC-Target-URI")
    date = source.get("WARC-Date") or ""
    envelope = {
        "warc": dict(source.fields),
        "http": {"status": status, "headers": [list(h) for h in headers], "length": len(payload)},
        "html": {"title": title(page), "links": links(page, url)},
    }
    body = json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode()
    return (
        _derived("metadata", "application/json", body, source, own_id, url, date),
        _derived("conversion", "text/plain; charset=utf-8", plain_text(page).encode(), source, own_id, url, date),
    )


def _derived(kind: str, content: str, block: bytes, source: Record, own_id: str, url: str | None, date: str) -> Record:
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(kind, own_id)),
        ("WARC-Date", date),
        ("WARC-Refers-To", own_id),
    ]
    if url is not None:
        fields += [("WARC-Target-URI", url), ("WARC-Refers-To-Target-URI", url)]
    fields.append(("WARC-Refers-To-Date", date))
    if source.get("WARC-Payload-Digest"):
        fields.append(("WARC-Payload-Digest", source.get("WARC-Payload-Digest") or ""))
    fields += [
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", content),
        ("Content-Length", str(len(block))),
    ]
    return Record(fields, block)


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """id and record: each page as a response record."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [
                response(u, (b or "").encode(), date).dump()
                for u, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], ["id", "record"])

    return pages.select(page_id, url, body).mapInArrow(run, f"id {kind}, record binary")


_DERIVED = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, "
    "payload_digest string, block_digest string, content_length long, record binary"
)


def derivatives(sources: DataFrame, source_id: str = "id", record: str = "record") -> DataFrame:
    """A metadata and a conversion record for each response; other record types give none."""
    kind = sources.schema[source_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            rows: list[tuple] = []
            for k, data in enumerate(batch.column(1)):
                for source in parse(data.as_py() or b""):
                    if source.get("WARC-Type") != "response":
                        continue
                    for made in derive(source):
                        at.append(k)
                        rows.append(
                            (
                                made.get("WARC-Type"), made.get("WARC-Record-ID"), made.get("WARC-Refers-To"),
                                made.get("WARC-Target-URI"), made.get("WARC-Date"), made.get("WARC-Payload-Digest"),
                                made.get("WARC-Block-Digest"), len(made.block), made.dump(),
                            )
                        )
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.string()] * 7 + [pa.int64(), pa.binary()]
            names = [f.split()[0] for f in _DERIVED.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["id", *names],
            )

    return sources.select(source_id, record).mapInArrow(run, f"id {kind}, {_DERIVED}")


def members(records: DataFrame, record: str = "record") -> DataFrame:
    """member: each record as a gzip member. The members of a partition, in order, are the content
    of one compressed WARC file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [gzip.compress(r.as_py(), 6, mtime=0) for r in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["member"])

    return records.select(record).where(F.col(record).isNotNull()).mapInArrow(run, "member binary")
