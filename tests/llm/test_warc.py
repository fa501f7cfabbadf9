import base64
import hashlib

import duckdb

from orbitlens.llm import warc
from orbitlens.llm.queries import QUERIES, SQL
from orbitlens.llm.shared import new_path


def test_query_equals_sql(spark, sf001):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf001}/pages.parquet'")
    want = con.execute("SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM (" + SQL["op10_warc"] + ")").fetchall()
    df = QUERIES["op10_warc"](spark, sf001)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.select("page_id", "payload_bytes", "payload_digest",
                                                                             "record_type", "refers_to").collect())


def test_url_keys():
    assert warc.surt("HTTP://User@Blog.Example.COM:80/a/B?x=1#top") == "com,example,blog)/a/B?x=1"
    assert warc.surt("https://example.com:8443") == "com,example:8443)/"
    assert warc.surt("example.com?q") == "com,example)?q" and warc.surt(None) == "" and warc.surt("#x") == ""


def expected(rows, page, html):
    data = (html or "").encode()
    same = [p for p, _, h in rows if (h or "") == (html or "")]
    low = min((p for p in same if p is not None), default=None)
    response = low is None or page == low
    return (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit",
            None if response else low)


def test_edges(spark):
    long = "<p>" + "é" * 300_000 + "</p>"
    rows = [(1, "http://a.example.com/x", "<p>1</p>"), (2, "http://a.example.com/x", "<p>1</p>"), (3, None, None), (4, "http://b.org", ""),
            (5, "http://a.example.com/x\r\nX: y", long), (6, "http://a.example.com/y\t", long), (None, "http://n.example.com/", "<p>1</p>"),
            (None, "http://n.example.com/", "alone"), (2, "http://a.example.com/x", "<p>1</p>"), (7, "", "WARC/1.1\r\n\r\n"), (0, "u", "\r\n\r\n")]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "page_id long, url string, html string, file string, offset long")
    got = warc.archive_round_trip(spark, df).drop("url").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(expected(rows, p, h)) for p, _, h in rows)
    assert warc.archive_round_trip(spark, df.limit(0)).count() == 0


def test_blocks_and_look_up_by_url(spark, sf01):
    pages = spark.read.parquet(f"{sf01}/pages.parquet")
    many = pages.unionByName(pages.selectExpr("page_id + 1000 as page_id", "url", "concat(html, 'x') as html"))
    root = new_path(spark, "warc")
    captures = warc.write_archives(many, root, max_file_bytes=50_000)
    index = warc.build_index(captures, block_lines=7)
    assert index.agg({"n": "sum"}).first()[0] == many.count() == captures.count()
    urls = [r.url for r in pages.orderBy("page_id").limit(9).collect()] + ["http://absent.example.com/"]
    asked = spark.createDataFrame([(u,) for u in urls], "url string")
    got = warc.read_records(warc.look_up(index, asked, id_col=None), root, with_payload=True).collect()
    keys = {warc.surt(u) for u in urls}
    want = {(r.page_id, r.html) for r in many.collect() if warc.surt(r.url) in keys}
    assert {(r.page_id, bytes(r.payload).decode()) for r in got} == want and len(got) == len(want)
    assert len({r.file for r in captures.collect()}) > 8


def test_read_back_is_spread_by_archive_bytes(spark, sf001, monkeypatch):
    """The number of reading tasks follows the archives' bytes, not the size of the capture rows."""
    pages = spark.read.parquet(sf001.replace("sf0.001", "sf0.1") + "/pages.parquet")
    assert pages.count() == 2500
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 20)
    root = new_path(spark, "warc")
    captures = warc.write_archives(pages, root)
    total = sum(r.length for r in captures.select("length").collect())
    tasks = warc.read_records(captures, root).rdd.getNumPartitions()
    assert tasks >= max(2, -(-total // (1 << 20)))
    index = warc.build_index(captures)
    assert warc.look_up(index, pages).rdd.getNumPartitions() == index.select("part").distinct().count() > 1
