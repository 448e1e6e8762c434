"""Archives and their index: nulls, repeated rows, hashed ids, order, broken files."""

import gzip
import io
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from eventide.llm import warc  # noqa: E402
from eventide.llm.common import importable  # noqa: E402

PAGES = "page_id long, url string, html string, digest string, first long"


@pytest.fixture(scope="module")
def rows(spark):
    importable(spark)
    long = "<p>" + "é" * 80 + "\r\n\r\n</p>"
    return [(10**13 + 7, "http://b.example.com:8080/x?q=1", long), (5, "http://a.example.com/x", long),
            (9, "https://www.b.example.com/X#top", long), (3, None, None), (4, "no url", ""), (6, "http://a.example.com/x", "short"),
            (7, "http://a.example.com/x", "short"), (5, "http://a.example.com/x", long), (None, "http://z.example.com", "n" * 200),
            (-(2**62), "http://a.example.com/ y", "WARC/1.1\r\n" * 40), (8, "http://z.example.com", "x" * 300_000)]


def test_archives_and_index(spark, rows):
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES)
    found = warc.archive_pages(pages).collect()
    assert len(found) == len(rows)
    html = [(p, (h or "").encode()) for p, _, h in rows]
    want = []
    for page, payload in html:
        same = [p for p, h in html if h == payload and p is not None]
        first = min(same) if same and len(payload) >= 100 else page
        want.append((page, len(payload), brute.sha(payload), "response" if page == first else "revisit",
                     None if page == first else first))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    ordered = sorted(found, key=lambda r: r.capture_order)
    assert [r.capture_order for r in ordered] == list(range(len(rows)))
    keys = [(r.urlkey, r.captured, r.page_id is None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert {r.urlkey for r in found} >= {"com,example,b:8080)/x?q=1", "com,example,b,www)/x", "com,example,a)/%20y", "no%20url", ""}


def test_no_pages(spark):
    importable(spark)
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_files_are_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_RECORDS", 10)
    pages = spark.range(95).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
                                   F.repeat(F.col("id").cast("string"), 60).alias("html")).coalesce(1)
    warc.write_archives(pages, f"file://{tmp_path}/a")
    files = [f for f in os.listdir(tmp_path / "a") if f.endswith(".gz")]
    assert len(files) == 10
    index = warc.capture_index(warc.index_runs(spark, f"file://{tmp_path}/a"))
    assert [r.page_id for r in index.orderBy("capture_order").collect()] == sorted(range(95), key=str)


def test_loser_tree():
    rng = random.Random(4)
    entry = lambda key, page, run: (key, "t", page, 0, "", "response", None, run, page)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((entry(rng.choice("abc"), rng.randint(0, 99), str(i)) for _ in range(rng.randint(0, 30))),
                       key=warc.order_of) for i in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert merged == sorted((e for r in runs for e in r), key=warc.order_of)


def record(payload=b"abc", length=None, head=b"WARC/1.1\r\n"):
    return head + b"Content-Length: %d\r\n\r\n" % (len(payload) if length is None else length) + payload + b"\r\n\r\n"


def test_broken_archives_are_errors():
    read = lambda raw: list(warc.read_records(io.BufferedReader(io.BytesIO(raw))))
    assert [b for _, _, b in read(record() + record(b""))] == [b"abc", b""]
    for raw in (record()[:-3], record(length=99), b"HTTP/1.1 200\r\n" + record()):
        with pytest.raises(warc.BadArchive):
            read(raw)
    head = {"WARC-Type": "response", "WARC-Payload-Digest": "sha256:00", "WARC-Record-ID": "<urn:page:1>",
            "WARC-Target-URI": "u", "WARC-Date": "d"}
    with pytest.raises(warc.BadArchive):
        warc.capture("a", 0, head, b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")
    assert gzip.decompress(gzip.compress(record())) == record()
