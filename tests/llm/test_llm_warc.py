import gzip
import hashlib
import heapq
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lapengine.llm import warc as W
from lapengine.llm.registry import QUERIES, table
from lapengine.llm.storage import shared_dir

SF = "/root/testdata/sf0.01"
BIG = "<p>" + "é payload " * 30 + "</p>"
ROWS = [(5, "http://a.example.com/x", BIG), (2, "http://b.example.com/", BIG), (9, "http://a.example.com/x", BIG), (1, None, None), (3, "http://c/", ""),
        (4, "http://c/", "small"), (6, "http://c/?a=1\r\nEvil: header", "small"), (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "x" * 100), (11, "u", "x" * 100),
        (12, "HTTP://WWW.Example.COM/P?q#f", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb" + "\r\n" * 60), (13, "u", "\r\n\r\n" * 40), (14, "u", "y" * 300 + "\r\n"),
        (15, "u", "y" * 300 + "\r"), (None, "http://n/", BIG), (None, "http://n/", "only null ids " * 20), (None, "http://n/", "only null ids " * 20),
        (2, "http://b.example.com/", BIG), (16, "u", "ü" * 200000 + "\r\n\r\n")]


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and h and len(h.encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        b, m = (h or "").encode(), first.get(h)
        again = m is not None and i != m
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", m if again else None))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("parts", [1, 5])
def test_round_trip_and_edge_cases(spark, parts):
    df = spark.createDataFrame([(*r, "k", 1) for r in ROWS], "page_id long, url string, html string, key string, n int").repartition(parts)
    path = shared_dir(spark, "t")
    W.write(df, path, F.lit(86399) + F.col("page_id"))
    got = W.read(spark, path, payload=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted(brute(ROWS), key=key)
    texts = {r[0]: r[2] or "" for r in ROWS if r[0] is not None}
    assert all(r.payload == texts[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.url for r in got if r.page_id == 6} == {"http://c/?a=1%0D%0AEvil: header"} and {r.url for r in got if r.page_id == 1} == {None}
    assert {r.seconds for r in got if r.page_id == 5} == {86404}
    index = W.read(spark, path).withColumn("key", W.url_key(F.col("url")))
    for rows in (3, 1000):
        merged = sorted(W.merge_runs(index, rows).collect(), key=lambda r: (r.part, r.place))
        said = [(r.key, r.seconds, r.page_id is not None, r.page_id or 0, r.run, r.pos) for r in merged]
        assert said == sorted(said) and len(said) == len(ROWS)


def test_files_are_plain_warc(spark):
    path = shared_dir(spark, "t")
    W.write(spark.createDataFrame([(1, "http://x/", "hello")], "page_id long, url string, html string"), path, F.lit(0))
    import glob
    data = b"".join(gzip.open(f).read() for f in glob.glob(path + "/*.gz"))
    head, _, block = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"WARC-Date: 1970-01-01T00:00:00Z" in head and b"WARC-Target-URI: http://x/" in head
    assert block.endswith(b"\r\n\r\nhello\r\n\r\n") and f"Content-Length: {len(block) - 4}".encode() in head


def test_empty_table(spark):
    path = shared_dir(spark, "t")
    df = spark.createDataFrame([], "page_id long, url string, html string")
    W.write(df, path, F.lit(0))
    index = W.read(spark, path).withColumn("key", W.url_key(F.col("url")))
    assert W.merge_runs(index).collect() == []


def test_url_keys(spark):
    df = spark.createDataFrame([("http://WWW.Example.com/P?q",), (None,), ("",), ("x",), ("http://a.b",)], "u string")
    assert [r[0] for r in df.select(W.url_key(F.col("u"))).collect()] == ["com,example,www)/p?q", "", "", "x)", "b,a)"]


def test_loser_tree_is_a_stable_merge():
    rng = random.Random(4)
    for k in range(0, 12):
        runs = [sorted(rng.randrange(20) for _ in range(rng.randrange(15))) for _ in range(k)]
        want = list(heapq.merge(*[[(x, r, i) for i, x in enumerate(run)] for r, run in enumerate(runs)]))
        assert list(W.merge(runs)) == [(r, i) for _, r, i in want]


def test_query_is_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    got = QUERIES["op2_warc"](spark, SF).collect()
    assert sorted(map(tuple, got), key=key) == sorted(con.sql(W.ORACLE_SQL).fetchall(), key=key)
    con.execute("create table t0 (page_id bigint, html varchar)")
    con.executemany("insert into t0 values (?, ?)", [(r[0], r[2]) for r in ROWS])
    assert sorted(con.sql(W.ORACLE_SQL.replace("from pages", "from t0")).fetchall(), key=key) == sorted(brute(ROWS), key=key)
    assert len(got) == table(spark, SF, "pages").count()
