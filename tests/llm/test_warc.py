import gzip
import zlib

import zstandard
from helpers_llm import SMOKE

from sparkmarts.llm.common import table
from sparkmarts.llm.html_render import render
from sparkmarts.llm.queries import op9_warc
from sparkmarts.llm.warc_derive import derivatives, derive, digest, first, http_body, read_record, response_record, responses, write_record


def test_records_round_trip():
    headers = [("WARC-Type", "resource"), ("X", "é: v")]
    for block in (b"", b"a\r\n\r\nb", bytes(range(256))):
        got = read_record(write_record(headers, block))
        assert got == ([*headers, ("Content-Length", str(len(block)))], block)
        assert read_record(gzip.compress(write_record(headers, block))) == got
    folded = b"WARC/1.0\nA: b\n  c\nContent-Length: 1\n\nx"
    assert read_record(folded) == ([("A", "b c"), ("Content-Length", "1")], b"x")


def test_pages_become_linked_records(spark):
    pages = {str(r.page_id): r for r in table(spark, SMOKE, "pages").collect()}
    sources = {r.page_id: read_record(bytes(r.record)) for r in responses(table(spark, SMOKE, "pages")).collect()}
    rows = op9_warc(spark, SMOKE).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page, (source, block) = pages[str(r.page_id)], sources[r.page_id]
        headers, body = read_record(r.record.encode())
        assert http_body(block)[2] == page.html.encode()
        assert first(headers, "WARC-Type") == r.record_type and first(headers, "WARC-Record-ID") == r.record_id
        assert first(headers, "WARC-Refers-To") == r.refers_to == first(source, "WARC-Record-ID")
        assert first(headers, "WARC-Target-URI") == r.target_uri == page.url
        assert first(headers, "WARC-Date") == first(source, "WARC-Date")
        assert first(headers, "WARC-Block-Digest") == r.block_digest == digest(body)
        assert r.payload_digest == digest(page.html.encode()) and r.source_digest_ok and r.content_length == len(body)
        if r.record_type == "conversion":
            assert body.decode() == render(page.html)
        else:
            fields = body.decode().split("\r\n")
            for k, v in source:
                assert f"source-{k.lower()}: {v}" in fields
            assert "http-header-content-type: text/html; charset=utf-8" in fields and "http-status: HTTP/1.1 200 OK" in fields
    assert len({r.record_id for r in rows}) == len(rows)


def test_encodings_and_damage():
    body = "<p>é".encode("latin-1")
    zipped = gzip.compress(body)
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(zipped), zipped)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + chunked
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Payload-Digest", "sha1:AAAA")]
    meta, conversion = derive(write_record(headers, http))
    assert read_record(conversion["record"])[1].decode() == "é"
    assert meta["source_digest_ok"] is False and meta["refers_to"] == "<urn:uuid:1>"
    assert derive(write_record([("WARC-Type", "request"), ("WARC-Record-ID", "<x>")], b"")) == []
    for bad in (b"", b"junk", write_record(headers, http)[:-60], b"WARC/1.0\r\nContent-Length: x\r\n\r\n", b"\x1f\x8bxx", write_record([("WARC-Type", "response")], b"")):
        assert list(derive(bad)[0]) == ["problem"]


def derived(body, *fields):
    head = "".join(f"{f}\r\n" for f in ("HTTP/1.1 200 OK", "Content-Type: text/plain", *fields))
    rows = derive(write_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>")], head.encode() + b"\r\n" + body))
    texts = [read_record(r["record"])[1] for r in rows]
    assert rows[0]["record_type"] == "metadata" and b"http-status: HTTP/1.1 200 OK" in texts[0]
    assert len({r["problem"] for r in rows}) == 1
    return texts[1] if len(rows) > 1 else None, rows[0]["problem"]


def test_encoded_bodies_are_whole_or_have_a_problem():
    text = b"".join(b"%d " % (i * i) for i in range(20_000))
    members = gzip.compress(text[:9]) + gzip.compress(text[9:]) + b"\0" * 8
    assert derived(members, "Content-Encoding: gzip") == (text, None)
    raw = zlib.compressobj(wbits=-15)
    for body in (zlib.compress(text), raw.compress(text) + raw.flush()):
        assert derived(body, "Content-Encoding: deflate") == (text, None)
    frames = zstandard.compress(text[:9]) + zstandard.compress(text[9:])
    assert derived(frames, "Content-Encoding: zstd") == (text, None)
    assert derived(zlib.compress(members), "Content-Encoding: gzip, deflate") == (text, None)
    assert derived(b"x", "Content-Encoding: br") == (None, "unsupported content encoding: br")
    assert derived(b"plain", "Content-Encoding: gzip") == (None, "corrupt gzip body")
    zipped = gzip.compress(text)
    for bad, problem in ((zipped[:-9000], "gzip body is cut short"), (zipped[:-4] + b"abcd", "corrupt gzip body")):
        got, why = derived(bad, "Content-Encoding: gzip")
        assert why == problem and len(got) > 10_000 and text.startswith(got)
    assert derived(b"", "Content-Encoding: gzip") == (b"", None)


def test_chunks_are_whole_or_have_a_problem():
    chunked = "Transfer-Encoding: chunked"
    assert derived(b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n", chunked) == (b"abcde", None)
    assert derived(b"3\r\nabc\r\nzz\r\nde\r\n", chunked) == (b"abc", "bad chunk size")
    assert derived(b"3\r\nabc\r\n9\r\nde", chunked) == (b"abcde", "chunked body is cut short")
    assert derived(b"3\r\nabc\r\n", chunked) == (b"abc", "chunked body is cut short")
    assert derived(b"no chunk\nat all", chunked) == (b"no chunk\nat all", "bad chunk size")


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a/", "<a href='b?x=1#f'>l</a>"), (2, "http://a/\nX: y", ""), (2, "http://a/\nX: y", "")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, record string")
    made = derivatives(responses(pages), "page_id").collect()
    assert len(made) == 8 and not any(r.problem for r in made)
    meta = next(r for r in made if r.page_id is None and r.record_type == "metadata")
    assert b"outlink: http://a/b?x=1\r\n" in bytes(meta.record)
    assert first(read_record(response_record("2", "http://a/\nX: y", b""))[0], "X") is None
    assert derivatives(responses(pages.limit(0)), "page_id").count() == 0
    assert [r.problem for r in derivatives(spark.createDataFrame([(1, None)], "id long, record binary"), "id").collect()] == ["no WARC version line"]
