import gzip
import hashlib
import os
import tempfile
from collections import Counter

import pytest
from flexframe.llm import warc

from .conftest import SF


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of (page_id, html), by the contract."""
    out, groups = [], {}
    for page_id, html in rows:
        payload = (html or "").encode()
        groups.setdefault(payload, []).append(page_id)
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i if i is not None else 0), reverse=True)
        for n, i in enumerate(ids):
            again = len(payload) >= 1000 and n > 0
            out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r)[:5] for r in df.collect())


def test_given_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert rows_of(warc.round_trip(spark, df)) == brute([(r.page_id, r.html) for r in df.collect()])


HOSTILE = [
    (1, "http://a/x", None), (2, "http://a/y", ""), (3, None, "small"), (None, "http://n/", "no id"), (4, "http://a/b c\r\nX: y", "q"),
    (5, "not a url at all", "x" * 999), (6, "http://a/6", "x" * 999), (7, "http://a/7", "y" * 1000), (8, "http://a/8", "y" * 1000),
    (9, "http://a/9", "ü" * 500), (10, "http://a/10", "ü" * 500), (11, "http://a/11", "a\r\n\r\nb\r\n\r\n" * 200), (12, "http://a/12", "\r\n\r\n"),
    (13, "http://a/13", "\r\n"), (14, "http://a/14", "\r"), (15, "http://a/15", "\n\r\n\r\n\r\n\r"), (16, "http://a/16", "﻿bom\x00nul" * 300),
    (17, "http://a/17", "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 20),
    (18, "http://a/18", "y" * 1000), (18, "http://a/18", "y" * 1000), (18, "http://b/18", "y" * 1000), (19, "http://a/19", "long " * 400000),
    (None, "http://n/", "z" * 2000), (None, "http://n/", "z" * 2000), (-3, "http://n/", "w" * 2000), (-4, "http://n/", "w" * 2000),
]


@pytest.mark.parametrize("parts", [1, 5])
def test_hostile_payloads(spark, parts):
    df = spark.createDataFrame(HOSTILE, "page_id long, url string, html string").selectExpr(
        "*", "1 as uid", "2 as size", "'k' as sha256", "3 as keeper", "4 as value", "'c' as capture_id").repartition(parts)
    got = warc.round_trip(spark, df)
    assert rows_of(got) == brute([(i, h) for i, _, h in HOSTILE])
    uri = {r.page_id: r.target_uri for r in got.collect()}
    assert uri[4] == "http://a/b%20c%0D%0AX:%20y" and uri[3] is None
    assert rows_of(warc.round_trip(spark, df.where("false"))) == Counter()


def test_a_payload_of_a_third_of_all_rows_is_joined_by_broadcast(spark):
    df = spark.range(3000).selectExpr("id as page_id", "'http://h/' as url", "if(id % 3 = 0, repeat('hot', 400), repeat(cast(id div 2 as string), 1000)) as html")
    assert rows_of(warc.round_trip(spark, df)) == brute([(r.page_id, r.html) for r in df.collect()])


def record(kind, rid, block, *more, content_type="application/http"):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id: {rid}", f"Content-Type: {content_type}", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive():
    body = bytes(range(256)) * 5
    return [
        record("warcinfo", "<i>", b"software: x\r\n", content_type="application/warc-fields"),
        # the response names its request; the metadata names the response
        record("request", "<q>", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        record("response", "<r>", b"HTTP/1.1 404 Not Found\r\nX-A: 1\r\n 2\r\n\r\n" + body, "WARC-Concurrent-To: <q>", "WARC-Concurrent-To: <other>"),
        record("metadata", "<m2>", b"k: 2\r\n", "WARC-Concurrent-To: <r>", content_type="application/warc-fields"),
        record("metadata", "<m1>", b"k: 1\r\n", "WARC-Concurrent-To: <r>", content_type="application/warc-fields"),
        record("resource", "<s>", b"plain", content_type="text/plain"),
        record("request", "<lost>", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <nowhere>"),
        record("revisit", "<v>", b"HTTP/1.1 200 OK\r\nContent-Length: 77\r\n\r\n", "WARC-Refers-To: <r>", "WARC-Payload-Digest: sha1:" + "A" * 32),
    ], body


@pytest.mark.parametrize("form", ["plain", "gzip", "members"])
def test_archives_of_others(spark, form):
    parts, body = archive()
    folder = tempfile.mkdtemp()
    data = {"plain": b"".join(parts), "gzip": gzip.compress(b"".join(parts)), "members": b"".join(map(gzip.compress, parts))}[form]
    with open(os.path.join(folder, "a.warc" + ("" if form == "plain" else ".gz")), "wb") as f:
        f.write(data)
    found = warc.records(spark, folder)
    assert found.count() == len(parts)
    rows = {r.capture_id: r for r in warc.captures(spark, found).collect()}
    assert set(rows) == {"<r>", "<s>", "<v>"}
    r = rows["<r>"]
    assert bytes(r.answer.payload) == body and r.answer.status == 404 and r.answer.fields["x-a"] == "1 2"
    assert r.answer.payload_digest == hashlib.sha1(body).hexdigest()
    assert r.request.record_id == "<q>" and [m.record_id for m in r.metadata] == ["<m1>", "<m2>"]
    assert rows["<s>"].request is None and bytes(rows["<s>"].answer.payload) == b"plain"
    assert rows["<v>"].answer.payload_bytes == 77 and rows["<v>"].answer.payload_digest == "0" * 40 and rows["<v>"].answer.payload is None


@pytest.mark.parametrize("cut", [10, 200])
def test_broken_archives_raise(spark, cut):
    parts, _ = archive()
    folder = tempfile.mkdtemp()
    with gzip.open(os.path.join(folder, "a.warc.gz"), "wb") as f:
        f.write(parts[2][:-cut])
    with pytest.raises(Exception, match="cut off"):
        warc.records(spark, folder).collect()
