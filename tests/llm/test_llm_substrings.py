import hashlib
import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from lapengine.llm import substrings as S
from lapengine.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, length):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[s:s + length]) for w in words for s in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = {s + k for s in range(len(w) - length + 1) if count[tuple(w[s:s + length])] > 1 for k in range(length)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(spark, texts, length, gram):
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, t1 string, lo int")
    got = {r.doc_id: tuple(r._rest) for r in S.remove(df, length=length, gram=gram).collect()}
    want = brute(texts, length)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == want[i], (i, (t or "")[:80])


def mixture(rng, n):
    """Texts put together from shared passages, variants of them, and periodic parts."""
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(4, 40))] for _ in range(12)]
    out = []
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(0, 6)):
            kind = rng.random()
            if kind < 0.6:
                p = list(rng.choice(passages))
                if rng.random() < 0.4 and p:
                    p[rng.randrange(len(p))] = "edit"
                w += p[rng.randrange(3):]
            elif kind < 0.8:
                w += [rng.choice(vocabulary[:3])] * rng.randrange(1, 30)
            else:
                w += [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
        out.append(rng.choice([" ", "\n", "  \t"]).join(w))
    return out


def test_mixtures_are_brute_force(spark):
    for seed, length, gram in ((1, 8, 3), (2, 6, 6), (3, 10, 1)):
        rng = random.Random(seed)
        texts = mixture(rng, 120)
        check(spark, texts + rng.sample(texts, 20) + [None, "", " \n", "a b", "same word " * 40], length, gram)


def test_production_length_and_edge_cases(spark):
    p = " ".join(f"p{i}" for i in range(60))
    q = " ".join(f"q{i}" for i in range(34))
    texts = [p, "x " + p + " y", "é\x0b" + p[:-3], q, q + " tail", q + " tail", "solo " * 34, "solo " * 36, "a " * 20000 + p, None, "", None,
             " ".join(f"u{i}" for i in range(50)), " ".join(f"u{i}" for i in range(10, 45)), " ".join(f"u{i}" for i in range(10, 44)) + " z"]
    check(spark, texts, S.LENGTH, S.GRAM)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove(df).collect() == []
    one = spark.createDataFrame([(1, p)], "doc_id long, text string")
    assert [tuple(r._rest) for r in S.remove(one).collect()] == [(60, 0, p)]


def test_full_bit_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_BITS", (6, 6))               # 64 bits: nearly every anchor passes
    check(spark, mixture(random.Random(9), 60), 8, 4)


def test_query_is_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = sorted(map(tuple, QUERIES["op3_substring_dedup"](spark, SF).collect()))
    assert got == sorted(con.sql(S.ORACLE_SQL).fetchall())
    docs = table(spark, SF, "documents").select("doc_id", F.col("text")).collect()
    want = brute([d.text for d in docs], S.LENGTH)
    assert got == sorted((d.doc_id, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, (n, m, t) in zip(docs, want, strict=True))
    assert sum(g[2] for g in got) > 0
