import gzip
import hashlib
import re

from pyarrow import fs
from scholarmetrics.llm import warc

PAGES = [
    (1, "http://a/1", "x" * 2000),
    (2, "http://a/2?q=ä b\r\nX: y", "x" * 2000),
    (3, None, "x" * 2000),
    (3, "http://a/again", "x" * 2000),
    (4, "http://b", "short"),
    (5, "http://c", "short"),
    (6, "", None),
    (7, "http://d", ""),
    (None, "http://e", "x" * 2000),
    (None, "http://f", "é\r\n\r\nWARC/1.1\r\n" * 100),
    (9, "http://g", "y" * 999),
    (10, "http://g", "y" * 999),
    (11, "http://h", "z" * 300000),
]


def pages(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3)


def test_archives_read_back(spark):
    index = warc.write(pages(spark))
    out = warc.read(index).collect()
    assert len(out) == len(PAGES)
    want = []
    for i, url, html in PAGES:
        body = (html or "").encode()
        largest = max(j for j, _, h in PAGES if h == html and j is not None) if len(body) >= 1000 and any(j is not None for j, _, h in PAGES if h == html) else None
        again = largest is not None and i != largest and sum(h == html for *_, h in PAGES) > 1
        want.append((i, url, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", largest if again else None, None if again else body))
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_selection_and_plain_reading(spark):
    index = warc.write(pages(spark))
    some = warc.read(index.where("page_id IN (4, 11)")).collect()
    assert sorted(r.page_id for r in some) == [4, 11]
    rows = index.where("page_id = 4").collect()
    disk, path = fs.FileSystem.from_uri(rows[0].archive)
    with disk.open_input_file(path) as f:
        whole = gzip.decompress(f.read())  # members follow each other: any WARC reader can read the archive
        member = gzip.decompress(f.read_at(rows[0].length, rows[0].offset))
    assert member in whole and member.startswith(b"WARC/1.1\r\n") and b"short" in member
    assert b"\r\nWARC-Type: response\r\n" in member and b"\r\n\r\nHTTP/1.1 200 OK\r\n" in member
    assert set(re.findall(rb"WARC-Type: (\w+)", whole)) <= {b"response", b"revisit"}


def test_reading_tasks_follow_the_archives_bytes(spark, monkeypatch):
    index = warc.write(pages(spark))
    monkeypatch.setattr(warc, "READ_BYTES", 200)  # many chunks of few bytes, a task for each
    out = warc.read(index)
    assert out.rdd.getNumPartitions() == index.selectExpr("archive", "floor(offset / 200)").distinct().count()
    assert out.count() == len(PAGES)


def test_neighbouring_ranges_are_one_read():
    row = lambda a, o, n: {"archive": a, "offset": o, "length": n}
    rows = [row("a", 0, 10), row("a", 10, 10), row("a", 20 + warc.GAP_BYTES, 5), row("a", 10**9, 5), row("b", 10**9 + 5, 5)]
    assert [len(x) for x in warc.ranges(rows)] == [3, 1, 1]


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(none)).count() == 0
