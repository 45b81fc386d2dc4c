import base64
import hashlib
import json

from glossa.llm import queries, warc
from tests.conftest import SF_SMALL

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A &amp; B
</title><meta name="d" content='x > y'><link rel=canonical href=/c><style>p{}</style><script>var t="</p><a href='no'>";</script></head>
<body><!-- <a href="gone">x</a> --><p>One<br>two &#x1F600; <b>bo</b>ld <a href="../n?a=1&amp;b=2" rel="nofollow">go <i>on</i></a> end</p>
<div>3 < 4 &lt;tag&gt;</div><img src="i.png" alt="pic">tail<script>open"""
KINDS = "page_id long, record_id string, target_uri string, date string, http_headers string, payload string, block string"


def run(spark, rows):
    return warc.derive(spark.createDataFrame(rows, KINDS))


def test_page():
    text, facts = warc.read_page(PAGE, "http://h.example/a/b/c.html")
    assert text.split("\n") == ["A & B", "One", "two \U0001f600 bold go on end", "3 < 4 <tag>", "tail"]
    assert facts["title"] == "A & B" and facts["language"] == "fr" and facts["metas"] == [{"name": "d", "content": "x > y"}]
    assert facts["links"] == [{"url": "http://h.example/c", "text": "", "rel": "canonical"}, {"url": "http://h.example/a/n?a=1&b=2", "text": "go on", "rel": "nofollow"}, {"url": "http://h.example/a/b/i.png", "text": "pic", "rel": "img"}]


def test_records_refer_to_their_response(spark):
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: b\r\n"
    rows = [(1, "<urn:uuid:1>", "http://h.example/a\r\nX: y", "2020-01-01T00:00:00Z", http, PAGE, "clash"), (1, "<urn:uuid:1>", "http://h.example/a\r\nX: y", "2020-01-01T00:00:00Z", http, PAGE, "clash"), (None, None, None, None, None, None, None), (3, None, "http://[bad", None, "", "<a href='http://[worse'>x</a>" + "<" * 20_000 + "y" * 50_000, None)]
    got = run(spark, rows).collect()
    assert len(got) == 8
    of = [r for r in got if r.page_id == 1]
    assert {r.record_type for r in of} == {"metadata", "conversion"} and {r.refers_to for r in of} == {"<urn:uuid:1>"} and len({r.record_id for r in of}) == 2
    meta = json.loads(next(r for r in of if r.record_type == "metadata").block)["Envelope"]
    assert meta["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"] == [["Content-Type", "text/html"], ["X-A", "b"]]
    assert meta["WARC-Header-Metadata"]["WARC-Target-URI"] == "http://h.example/a X: y"
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert meta["WARC-Header-Metadata"]["WARC-Payload-Digest"] == sha(PAGE.encode()) == of[0].payload_digest
    assert meta["WARC-Header-Metadata"]["WARC-Block-Digest"] == sha(http.encode() + b"\r\n" + PAGE.encode())
    empty = [r for r in got if r.page_id is None]
    assert {r.block for r in empty if r.record_type == "conversion"} == {""} and len({r.refers_to for r in empty}) == 1
    assert all(r.block_digest == sha(r.block.encode()) and r.content_length == len(r.block.encode()) for r in got)
    assert run(spark, []).count() == 0


def test_round_trip_on_the_whole_table(spark):
    records = warc.serialised(queries.op10_warc_derivatives(spark, SF_SMALL)).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    assert sorted(r.page_id for r in records) == sorted([*pages, *pages])
    for r in records:
        headers, block = warc.parsed(bytes(r.warc))
        assert headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Block-Digest"] == warc.digest(block) and block.decode() == r.block
        assert headers["WARC-Target-URI"] == pages[r.page_id].url and r.payload_digest == warc.digest(pages[r.page_id].html.encode())
        if r.record_type == "conversion":
            assert "<script" not in r.block and "track(" not in r.block and "</p>" not in r.block
            assert (r.block.split("\n")[0], r.block) == (warc.read_page(pages[r.page_id].html, r.target_uri)[0].split("\n")[0], r.block)
