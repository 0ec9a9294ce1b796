import base64
import hashlib

import pytest

from asofia.llm import warc as W
from asofia.llm.common import read_file, work_dir

from .helpers import bag

PAGES = "page_id long, url string, html string, kind string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


def run(spark, rows, **kw):
    return W.read_archives(spark, W.write_archives(pages(spark, rows), work_dir(spark, "w"), **kw))


def want(rows):
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(ids) if len([1 for _, _, g in rows if (g or "") == (h or "")]) > 1 and ids else None
        again = first is not None and (i is None or i > first)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first if again else None, "ok"))
    return sorted(out, key=str)


def test_pages(spark):
    big = "".join(chr(97 + k % 26) for k in range(100_000)) + "é"
    rows = [(5, "http://a/\r\nx y", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "u", None), (4, "u", ""), (7, "u", big), (8, "u", big), (3, "u", "<p>one</p>"), (None, "u", big), (None, "u", "only"), (1, "u", "\r\n0\r\n\r\n"), (2, "u", "x" * 4096), (-6, "u", "neg")]
    assert bag(run(spark, rows, segment_bytes=1000, file_bytes=5000), [*W._OUT, "status"]) == want(rows)
    assert bag(run(spark, rows), [*W._OUT, "status"]) == want(rows)


def test_hot_payload(spark):
    rows = [(k, "u", "hot" if k % 3 else f"own {k}") for k in range(600)]
    assert bag(run(spark, rows), [*W._OUT, "status"]) == want(rows)


def test_smaller_payloads_are_responses(spark):
    got = run(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_revisit=5)
    assert {r.page_id: r.record_type for r in got.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_rows(spark):
    assert run(spark, []).collect() == []


def test_chunked():
    for body in (b"", b"a", b"x" * 10_000):
        assert W.dechunked(W.chunked(body, 7)) == body
    assert W.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        W.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")


def test_reassembly(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + W.chunked(b"hello" * 50)
    cut = [block[:100], block[100:200], block[200:]]
    rows = []
    for origin, parts, total in (("<urn:page:1;a>", [0, 1, 2], len(block)), ("<urn:page:2;a>", [0, 2], len(block)), ("<urn:page:3;a>", [0, 1, 2], len(block) + 1), ("<urn:page:4;a>", [0, 1, 1, 2], len(block)), ("<urn:page:5;a>", [1, 2], len(block))):
        rows += [(origin, p + 1, total if p == 2 else None, int(origin[10]) if p == 0 else None, None, cut[p]) for p in parts]
    df = spark.createDataFrame(rows, "origin string, segment int, total long, page_id long, payload_digest string, block binary")
    got = {r.page_id: (r.payload_bytes, r.status) for r in W.reassemble(df.repartition(2, "origin").sortWithinPartitions("origin", "segment")).collect()}
    assert got == {1: (250, "ok"), 2: (None, "incomplete"), 3: (None, "incomplete"), 4: (250, "ok"), 5: (None, "incomplete")}


def test_revisits_name_a_record_that_is_there(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://x/{k}", "<p>same</p>" * 3000 if k % 2 else f"<p>{k}</p>") for k in range(1, 20)], "page_id long, url string, html string").repartition(3)
    fields = [f for file in W.write_archives(pages, f"file://{tmp_path}") for f, _ in W.records(read_file(file))]
    made = {f["warc-record-id"] for f in fields if f["warc-type"] == "response"}
    again = [f["warc-refers-to"] for f in fields if f["warc-type"] == "revisit"]
    assert len(again) == 9 and set(again) <= made and len({f["warc-record-id"] for f in fields}) == len(fields)
