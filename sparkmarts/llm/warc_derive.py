"""WARC derivatives: each response record becomes a linked metadata record and
a plain-text conversion record.

Both refer to the response by ``WARC-Refers-To`` and keep its target URI, date,
headers and digests; their own ids follow from the response's id, so that a job
that runs again writes the same records."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmarts.llm.common import map_slices, texts_of
from sparkmarts.llm.html_render import Node, nodes, shown, title_in, tree

VERSION = b"WARC/1.1"
DATE = "2020-01-01T00:00:00Z"
_SPACE_ID = uuid.uuid5(uuid.NAMESPACE_URL, "urn:x-derived-records")
_LANG = re.compile(r"\s*([A-Za-z][A-Za-z0-9-]*)")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
ROW = (
    "array<struct<record_type:string,record_id:string,refers_to:string,target_uri:string,payload_digest:string,"
    "block_digest:string,source_digest_ok:boolean,content_length:bigint,problem:string,record:binary>>"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_ID, chr(0).join(parts))}>"


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record. Line ends in values become spaces; Content-Length is added."""
    lines = [f"{k}: {' '.join(v.split())}" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """Header lines; a line that begins with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in raw.replace(b"\r\n", b"\n").split(b"\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}".strip())
        elif ":" in text:
            k, v = text.split(":", 1)
            out.append((k.strip(), v.strip()))
    return out


def _cut(data: bytes) -> tuple[bytes, bytes]:
    """Header part and the rest, at the first empty line."""
    m = re.search(rb"\r?\n\r?\n", data)
    return (data[: m.start()], data[m.end() :]) if m else (data, b"")


def read_record(data: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(headers, block) of one uncompressed or gzipped record; ValueError if malformed."""
    if data[:2] == b"\x1f\x8b":
        try:
            data = zlib.decompressobj(31).decompress(data)
        except zlib.error as e:
            raise ValueError(f"bad gzip: {e}") from None
    head, rest = _cut(data)
    version, _, raw = head.partition(b"\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("no WARC version line")
    headers = _fields(raw)
    size = first(headers, "Content-Length") or ""
    if not (size.isascii() and size.isdigit()):
        raise ValueError("no Content-Length")
    if len(rest) < int(size):
        raise ValueError("record is cut short")
    return headers, rest[: int(size)]


def first(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def _unchunk(body: bytes) -> tuple[bytes, str | None]:
    """The chunks' data, and what is wrong with them. A body that does not begin
    with a chunk stays as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\n", at)
        if end < 0:
            return b"".join(out), "chunked body is cut short"
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return b"".join(out) if out else body, "bad chunk size"
        n = int(size, 16)
        if not n:
            return b"".join(out), None
        out.append(body[end + 1 : end + 1 + n])
        at = end + 1 + n
        if at > len(body):
            return b"".join(out), "chunked body is cut short"
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"


def _deflate(data: bytes):
    """With the zlib header that the standard asks for, or without, as some servers send it."""
    headed = len(data) > 1 and data[0] & 15 == 8 and int.from_bytes(data[:2], "big") % 31 == 0
    return zlib.decompressobj(15 if headed else -15)


#: content encoding -> a decompressor for one member
_CODECS = {
    "gzip": lambda data: zlib.decompressobj(31),
    "x-gzip": lambda data: zlib.decompressobj(31),
    "deflate": _deflate,
    "zstd": lambda data: zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj(),
}


def _decoded(body: bytes, coding: str) -> tuple[bytes, str | None]:
    """All members of an encoded body as far as they can be read, and what is wrong."""
    if coding in ("", "identity"):
        return body, None
    if coding not in _CODECS:
        return b"", f"unsupported content encoding: {coding}"
    out, left = [], body
    while left:
        one, at = _CODECS[coding](left), 0
        try:
            # by pieces, so that what stands before a fault is kept
            while at < len(left) and not one.eof:
                out.append(one.decompress(left[at : at + 4096]))
                at += 4096
        except (zlib.error, zstandard.ZstdError):
            return b"".join(out), f"corrupt {coding} body"
        if not one.eof:
            return b"".join(out), f"{coding} body is cut short"
        left = (one.unused_data + left[at:]).lstrip(b"\0")
    return b"".join(out), None


def http_body(block: bytes) -> tuple[str, list[tuple[str, str]], bytes, bytes, str | None]:
    """(status line, headers, payload as stored, payload without transfer and
    content encodings, what is wrong with these)."""
    head, payload = _cut(block)
    status, _, raw = head.partition(b"\n")
    headers = _fields(raw)
    body, problem = payload, None
    if "chunked" in (first(headers, "Transfer-Encoding") or "").lower():
        body, problem = _unchunk(body)
    codings = ",".join(v for k, v in headers if k.lower() == "content-encoding").lower().split(",")
    for coding in reversed(codings):
        body, wrong = _decoded(body, coding.strip())
        problem = problem or wrong
    return status.decode("latin-1").strip(), headers, payload, body, problem


def as_text(body: bytes, kind: str) -> str:
    """Payload to characters: the declared charset, else UTF-8."""
    m = _CHARSET.search(kind) or _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        return body.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def links(page: Node, base: str) -> Iterator[str]:
    """Distinct absolute targets of a tree's anchors, in the order of the page;
    relative ones start from the page's first base element, if it has one."""
    bases = (n.attrs["href"].strip() for n in nodes(page, "base") if "href" in n.attrs)
    try:
        base = urljoin(base, next(bases, ""))
    except ValueError:
        pass
    seen = set()
    for raw in dict.fromkeys(n.attrs["href"].strip() for n in nodes(page, "a") if "href" in n.attrs):
        try:
            target = urldefrag(urljoin(base, raw))[0] if raw else ""
        except ValueError:
            continue
        if target.startswith(("http://", "https://")) and target not in seen:
            seen.add(target)
            yield target


def derive(data: bytes) -> list[dict]:
    """The metadata and the conversion record of a response; nothing for other
    types; one row with ``problem`` for a malformed record. If the body's encoding
    is unsupported, corrupt or cut, both have ``problem``, and there is a
    conversion record only of what could be read."""
    try:
        headers, block = read_record(data)
    except ValueError as e:
        return [{"problem": str(e)}]
    if first(headers, "WARC-Type") != "response":
        return []
    source = first(headers, "WARC-Record-ID")
    if not source:
        return [{"problem": "response without WARC-Record-ID"}]
    status, http, payload, body, problem = http_body(block)
    kind = first(http, "Content-Type") or ""
    page = as_text(body, kind)
    markup = "html" in kind.lower() or not kind and "<html" in page[:1024].lower()
    uri = first(headers, "WARC-Target-URI") or ""
    known = {k: first(headers, k) for k in ("WARC-Payload-Digest", "WARC-Block-Digest")}
    checked = [(known["WARC-Payload-Digest"], payload), (known["WARC-Block-Digest"], block)]
    comparable = [(d, x) for d, x in checked if d and d.lower().startswith("sha1:")]
    ok = all(d.upper() == digest(x).upper() for d, x in comparable) if comparable else None
    shared = [("WARC-Refers-To", source)]
    shared += [(k, v) for k in ("WARC-Target-URI", "WARC-Date", "WARC-Warcinfo-ID") if (v := first(headers, k))]

    fields = [("http-status", status)]
    fields += [(f"source-{k.lower()}", v) for k, v in headers]
    fields += [(f"http-header-{k.lower()}", v) for k, v in http]
    if markup:
        root = tree(page)
        lang = _LANG.match(root.attrs.get("lang", ""))
        fields += [("title", title_in(root))] + ([("language", lang[1])] if lang else [])
        fields += [("outlink", x) for x in links(root, uri)]
    fields_block = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode()
    text = (shown(root) if markup else page).encode("utf-8", "replace")
    out = []
    for name, mime, content in (("metadata", "application/warc-fields", fields_block), ("conversion", "text/plain; charset=utf-8", text)):
        if name == "conversion" and problem and not body:
            continue
        own, sum_of = record_id(source, name), digest(content)
        own_headers = [("WARC-Type", name), ("WARC-Record-ID", own), *shared, ("WARC-Block-Digest", sum_of), ("Content-Type", mime)]
        if name == "conversion":
            own_headers += [("WARC-Source-Payload-Digest", v)] if (v := known["WARC-Payload-Digest"]) else []
        out.append(
            {
                "record_type": name, "record_id": own, "refers_to": source, "target_uri": uri or None,
                "payload_digest": known["WARC-Payload-Digest"], "block_digest": sum_of, "source_digest_ok": ok,
                "content_length": len(content), "problem": problem, "record": write_record(own_headers, content),
            }
        )
    return out


def response_record(page_id: str, url: str | None, page: bytes, date: str = DATE) -> bytes:
    """A page as a response record, as a crawler would have stored it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page)}\r\n\r\n"
    block = head.encode() + page
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", page_id, url or "")), ("WARC-Date", date)]
    headers += [("WARC-Target-URI", url)] if url else []
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(page)), ("WARC-Block-Digest", digest(block))]
    return write_record(headers, block)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, record) of every page. Null pages are empty; a null url leaves its header out."""
    kept = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"), F.col(html_col))

    def run(part: pa.RecordBatch) -> dict:
        ids = part.column(0).cast(pa.string()).to_pylist()
        urls = part.column(1).to_pylist()
        return {"record": [response_record(i or "", u, t) for i, u, t in zip(ids, urls, texts_of(part, "__text"), strict=True)]}

    return map_slices(kept, html_col, run, "record binary", keep=[id_col, "__url"]).drop("__url")


def derivatives(records: DataFrame, id_col: str, record_col: str = "record") -> DataFrame:
    """Rows of ``derive`` for every record, beside its id: two for a response
    (one if nothing of its body can be read), none for other types, one with ``problem`` for a malformed or null record."""

    def run(part: pa.RecordBatch) -> dict:
        return {"__rows": [derive(x) for x in texts_of(part, "__text")]}

    out = map_slices(records, record_col, run, f"__rows {ROW}", keep=[id_col])
    return out.select(id_col, F.explode("__rows").alias("r")).select(id_col, "r.*")
