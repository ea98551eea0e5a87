import gzip
import hashlib
import io

import pytest

from hirelens.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, n int"
BIG = "é<p>" * 400


def rows():
    out = [(1, "http://a/ b\r\nX: y", BIG), (5, "http://b", BIG), (3, None, BIG), (5, "http://b", BIG), (None, "u", BIG),
           (7, "http://c", "small"), (8, "http://c", "small"), (9, None, None), (10, "", ""), (11, "http://d", "y" * 400_000),
           (12, "http://d2", "z" * 1000), (13, "http://d3", "z" * 1000), (14, "http://e", "\r\n\r\nWARC/1.1\r\n\r\n" * 50)]
    return [(*r, "clash", 1) for r in out]


def expected(data):
    out = []
    for i, _, html, *_ in data:
        body = (html or "").encode()
        ids = [j for j, _, h, *_ in data if (h or "") == (html or "") and j is not None]
        again = len(body) >= 1000 and (i is None or i < max(ids)) and ids
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_bytes", [1 << 30, 2000])
def test_round_trip(spark, max_bytes):
    out = warc.write_archives(spark.createDataFrame(rows(), SCHEMA).repartition(3), max_bytes=max_bytes)
    got = warc.read_archives(spark, out).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows())
    html = {r[0]: r[2] or "" for r in rows()}
    for r in got:
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html[r.page_id]
        else:
            assert r.payload is None
        assert r.url is None or "\n" not in r.url and " " not in r.url


def test_members_are_plain_gzip_and_tampering_is_noticed():
    rec = [warc.make_record(i, "http://x", f"page {i} ".encode() * 9000, hashlib.sha1(f"page {i} ".encode() * 9000).hexdigest(),
                            None, "1970-01-01T00:00:00Z") for i in range(3)]
    text = gzip.decompress(rec[0])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")
    assert [r["page_id"] for r in warc.records(io.BytesIO(b"".join(rec)))] == [0, 1, 2]
    for change in ((b"page 0 page", b"page 0 pagf"), (b"Content-Length: 63", b"Content-Length: 62")):
        assert change[0] in text
        bad = gzip.compress(text.replace(*change, 1))
        with pytest.raises(ValueError, match="record 0"):
            list(warc.records(io.BytesIO(bad + rec[1])))
    with pytest.raises(ValueError, match="record 2"):
        list(warc.records(io.BytesIO(b"".join(rec)[:-40])))


def test_empty(spark):
    assert warc.read_archives(spark, warc.write_archives(spark.createDataFrame([], SCHEMA))).collect() == []


def foreign(kind, block, *head, content="application/http; msgtype=response"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1b2c>", "WARC-Date: 2020-01-01T00:00:00Z", *head,
             f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nbody\r\n0\r\n\r\n"
    sha1 = hashlib.sha1(b"body").hexdigest()
    data = b"".join([
        foreign("warcinfo", b"software: y\r\n", content="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", content="application/http; msgtype=request"),
        foreign("response", http, "WARC-Target-URI: http://a"),
        foreign("response", http, f"WARC-Payload-Digest: SHA1:{sha1}", "WARC-Block-Digest: sha256:00"),
        foreign("response", chunked, f"WARC-Payload-Digest: sha1:{sha1}"),
        foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Refers-To: <urn:uuid:ffff>"),
        foreign("resource", b"plain", content="text/plain")])
    (tmp_path / "a.warc.gz").write_bytes(data)
    df = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "archive string")
    got = [(r.record_type, r.page_id, r.payload_bytes, r.payload_digest, r.refers_to_id, r.payload and bytes(r.payload))
           for r in warc.read_files(df).collect()]
    assert got == [("response", None, 4, sha1, None, b"body"), ("response", None, 4, sha1, None, b"body"),
                   ("response", None, 14, sha1, None, chunked.split(b"\r\n\r\n", 1)[1]), ("revisit", None, 0, None, "urn:uuid:ffff", None),
                   ("resource", None, 5, hashlib.sha1(b"plain").hexdigest(), None, b"plain")]
    assert warc.read_files(df, with_payload=False).columns[-1] == "refers_to_id"
    bad = foreign("response", http, f"WARC-Payload-Digest: sha1:{'0' * 40}")
    with pytest.raises(ValueError, match="payload digest"):
        list(warc.records(io.BytesIO(bad)))
