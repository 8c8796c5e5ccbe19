"""Archives that other tools made, and pages met with and without a broadcast."""

import base64
import gzip
import hashlib

import pytest
import zstandard

from loomset.llm import warc

BODY = b"<html>body</html>"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def _sha(data, base32=True):
    raw = hashlib.sha1(data).digest()
    return "sha1:" + (base64.b32encode(raw).decode() if base32 else raw.hex().upper())


def _record(kind, block, **more):
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{kind}>", "Content-Length": len(block)}
    headers |= {k.replace("_", "-"): v for k, v in more.items()}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _read(spark, *records):
    pack = zstandard.ZstdCompressor().compress
    skipped = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    content = skipped.join([pack(x) for x in records])
    rows = spark.createDataFrame([(content,)], "content binary")
    return warc.read_archives(rows).collect()


def test_records_of_other_tools(spark):
    http = {"Content_Type": "application/http; msgtype=response", "WARC_Target_URI": "http://x/"}
    rows = _read(
        spark,
        _record("warcinfo", b"software: x\r\n", Content_Type="application/warc-fields"),
        _record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", Content_Type="application/http;msgtype=request"),
        _record("response", HTTP + BODY, WARC_Payload_Digest=_sha(BODY), WARC_Block_Digest=_sha(HTTP + BODY, False), **http),
        _record("response", HTTP + BODY, **http),
        _record("metadata", b"a: b"),
        _record("revisit", HTTP, WARC_Refers_To="<urn:uuid:response>", WARC_Payload_Digest=_sha(BODY), **http),
        _record("resource", BODY, WARC_Payload_Digest="sha256:" + hashlib.sha256(BODY).hexdigest()),
        _record("resource", BODY, WARC_Payload_Digest="crc9:1"),
    )
    assert [r.error for r in rows] == [None] * 8
    assert [r.record_type for r in rows] == "warcinfo request response response metadata revisit resource resource".split()
    body = hashlib.sha1(BODY).hexdigest()
    assert [r.payload_digest for r in rows[2:4]] == [body] * 2 and rows[5].payload_digest == body
    assert [bytes(r.payload) for r in rows[2:4]] == [BODY] * 2 and rows[1].payload == b""
    assert (rows[5].payload, rows[5].payload_bytes, rows[5].refers_to_record) == (None, None, rows[3].record_id)
    assert rows[2].payload_bytes == len(BODY) and rows[2].url == "http://x/"


def test_chunked_bodies_fit_either_digest(spark):
    head = HTTP.replace(b"\r\n\r\n", b"\r\nTransfer-Encoding: chunked\r\n\r\n")
    coded = b"6;x=1\r\n" + BODY[:6] + b"\r\n%x\r\n" % len(BODY[6:]) + BODY[6:] + b"\r\n0\r\n\r\n"
    kind = {"Content_Type": "application/http; msgtype=response"}
    rows = _read(
        spark,
        _record("response", head + coded, WARC_Payload_Digest=_sha(BODY), **kind),
        _record("response", head + coded, WARC_Payload_Digest=_sha(coded), **kind),
        _record("response", head + coded, WARC_Payload_Digest=_sha(b"else"), **kind),
    )
    assert [r.error is None for r in rows] == [True, True, False]
    assert [bytes(r.payload) for r in rows[:2]] == [BODY, coded]


@pytest.mark.parametrize(
    "headers",
    [
        {"WARC_Payload_Digest": _sha(b"else")},
        {"WARC_Block_Digest": _sha(b"else")},
        {"WARC_Payload_Digest": "sha1:short"},
        {"WARC_Payload_Digest": "sha1:!!"},
        {"X_Payload_Length": "3"},
    ],
)
def test_false_headers_are_told(spark, headers):
    good = _record("resource", BODY)
    rows = _read(spark, good, _record("resource", BODY, **headers), good)
    assert [r.error is None for r in rows] == [True, False, True]


def test_a_truncated_record_keeps_what_it_has(spark):
    (row,) = _read(spark, _record("resource", BODY, WARC_Truncated="length", WARC_Payload_Digest=_sha(b"all of it")))
    assert row.error is None and bytes(row.payload) == BODY


def test_other_compression_is_told(spark):
    rows = spark.createDataFrame([(gzip.compress(BODY),)], "content binary")
    assert [r.error is None for r in warc.read_archives(rows).collect()] == [False]


@pytest.mark.parametrize("limit", [0, 100])
def test_revisits_are_the_same_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", limit)
    rows = [(i, f"u{i}", f"{i % 3 and i}" * 1200) for i in range(50)] + [(None, "n", "0" * 1200), (7, "u7", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = warc.read_archives(warc.write_archives(pages)).collect()
    assert len(found) == 52 and all(r.error is None for r in found)
    for r in found:
        zero = r.page_id is not None and r.page_id % 3 == 0 and r.page_id != 48
        assert (r.record_type, r.refers_to) == (("revisit", 48) if zero else ("response", None))
