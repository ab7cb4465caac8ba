import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from lapengine.llm import decontaminate as D
from lapengine.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items):
    w = words(text)
    hit, own = set(), set()
    for i, t in items:
        v = words(t)
        m = min(13, len(v))
        for p in {tuple(v[s:s + m]) for s in range(len(v) - m + 1)} if m else ():
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) == p:
                    hit |= set(range(s, s + m))
                    own |= {str(i)} if i is not None else set()
    said = ",".join(sorted(own))
    return len(w), len(hit), len(own), hashlib.sha256(said.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


A = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, A), (2, "w5 w6"), (10, "É X"), (None, "zz zz"), (3, None), (4, " .,! "), (5, "aa " * 14), (5, "other short"), (6, A.upper()), (7, "solo")]
TEXTS = [None, "", "...", "w5", "W5, w6!", A, A.upper() + " tail", "x " * 700 + A + " y" * 300, "zz zz zz", "é x É X", "aa " * 40, "SOLO",
         " ".join(f"w{i}" for i in range(12)), "other\x00short", "q " * 50000 + "w5-w6", " ".join(f"w{i}" for i in range(3, 20)) * 2, "w5 w6"]


@pytest.mark.parametrize("part_chars", [1 << 20, 40])
def test_brute_force_and_edge_cases(spark, part_chars):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, n_words int, hit string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    h = F.col("_hits")
    got = D.find(docs, bench, part_chars=part_chars).select(
        "doc_id", "n_words", h["n_words"], h["n_hit"], F.size(h["items"]), F.sha2(F.array_join(h["items"], ","), 256), D.is_contaminated(h)).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        assert r[1] == 1 and tuple(r)[2:] == brute((TEXTS * 2)[r.doc_id], ITEMS), (TEXTS * 2)[r.doc_id]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r._hits)[:2] for r in D.find(docs, bench).collect()] == [(2, 0)]
    assert D.find(docs.limit(0), bench).collect() == []


def test_query_is_brute_force_and_sql(spark):
    docs, items = table(spark, SF, "documents").collect(), [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    assert len(got) == len(docs) and sum(r[-1] for r in got.values()) > 0
    grams = {w for _, t in items for w in zip(*[words(t)[k:] for k in range(13)])}
    for d in docs:
        w = words(d.text)
        hit = set()
        for s in range(len(w) - 12):
            if tuple(w[s:s + 13]) in grams:
                hit |= set(range(s, s + 13))
        assert got[d.doc_id][:2] == (len(w), len(hit)), d.doc_id
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert {r[0]: r[1:] for r in con.sql(D.ORACLE_SQL).fetchall()} == got
