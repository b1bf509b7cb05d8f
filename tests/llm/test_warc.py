import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from gleanstar.llm import warc
from gleanstar.llm.files import RangeReader, new_folder
from gleanstar.llm.registry import table


def brute(rows, min_bytes=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = min(ids) if ids and len(body) >= min_bytes else None
        again = first is not None and i != first
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), sha, "revisit" if again else "response", first if again else None))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}.example.com/p/{i % 5}", f"<p>seite {i % 4} é</p>") for i in range(40)]
    rows += [(100, None, None), (101, "", ""), (None, "http://a.b/", None), (None, None, "only"), (102, "HTTP://User@A.b:80/x y\n#f", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rows += [(103, "http://a.b/", "x" * 300_000), (103, "http://a.b/", "x" * 300_000), (5, "http://h2.example.com/p/0", "other text")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "url as key", "'z' as payload")


def test_round_trip(pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    for least in (0, 20):
        got = warc.round_trip(pages, min_bytes=least, with_payload=True).collect()
        assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == brute(rows, least)
        assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_lookup_reads_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 50)
    many = spark.range(3000).selectExpr("id as page_id", "concat('http://www.s', id % 1000, '.org/a') as url", "concat('t', id) as html")
    folder = new_folder(spark, "warc")
    manifest = warc.archive(many.coalesce(3), folder)
    keys = spark.createDataFrame([("org,s77,www)/a",), ("org,absent)/",)], "key string")
    found = warc.lookup(keys, manifest).collect()
    assert sorted(r.id for r in found) == [77, 1077, 2077]
    file = next(m for m in manifest if m[1] <= "org,s77,www)/a" <= m[2])[0]
    index = warc.IndexFile(file)
    assert len(list(index.find("org,s77,www)/a"))) and index.blocks_read <= 2 < len(index.firsts)


def test_archives_are_gzip_members(spark, pages):
    folder = new_folder(spark, "warc")
    captures = warc.write_archives(pages.coalesce(1), folder, "page_id", "url", "html", 0).collect()
    assert len(captures) == pages.count()
    by_file = defaultdict(list)
    for c in captures:
        by_file[c.file].append((c.offset, c.length))
    for file, places in by_file.items():
        with RangeReader(file) as f:
            whole = gzip.decompress(f.read(0, f.size()).to_pybytes())
            parts = [gzip.decompress(f.read(a, n).to_pybytes()) for a, n in sorted(places)]
        assert whole == b"".join(parts) and whole.count(b"WARC-Record-ID") == len(places)


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com/A?b=C#d", "com,example,www)/A?b=C"),
        ("https://u:p@x.org:443", "org,x)/"),
        ("http://x.org:8080/a", "org,x:8080)/a"),
        ("http://10.0.0.1/a", "10.0.0.1)/a"),
        ("http://[::1]/a", "[::1])/a"),
        ("x.org?q", "org,x)/?q"),
        ("http://x.org/a b", "org,x)/a%20b"),
        ("", ")/"),
        (None, ""),
    ],
)
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_shared_data(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = warc.round_trip(pages).drop("url").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
