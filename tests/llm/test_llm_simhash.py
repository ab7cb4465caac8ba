import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lapengine.llm import simhash as S
from lapengine.llm.components import components
from lapengine.llm.registry import QUERIES, table
from lapengine.llm.storage import written

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= S.MAX_BITS:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


def test_query_is_brute_force(spark):
    docs = table(spark, SF, "documents").collect()
    fps = [brute_fp(d.text) for d in docs]
    comp = brute_components([d.doc_id for d in docs], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_near_dedup"](spark, SF).collect()}
    assert got == {d.doc_id: (f"{f:016x}", c) for d, f, c in zip(docs, fps, comp, strict=True)}
    assert any(k != c for k, (_, c) in got.items())


def test_null_empty_short_long_repeated(spark):
    texts = [None, "", " \t\n", "One", "one  two", "ONE TWO", "a b c d e f g " * 5000, "a b c d e f g " * 5000 + "x", "é ü ß", "a\x0bb\x1cc"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] * 2 + [(None, "one two", "x", 1), (None, "quite another text here", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int").drop("fp")
    got = df.select("doc_id", "text", S.fingerprint(F.col("text")).alias("fp"))
    fps = [(r.fp % 2**64, brute_fp(r.text)) for r in got.collect()]
    assert all(a == b for a, b in fps)
    w = written(got.select("doc_id", "fp"), "t")
    comp = {r.fp % 2**64: r.component_id for r in S.near_duplicates(w).collect()}
    want = brute_components([r[0] for r in rows], [b for _, b in fps])
    assert [comp[b] for _, b in fps] == want
    empty = written(got.where("false").select("doc_id", "fp"), "t")
    assert S.near_duplicates(empty).collect() == []


def near_fps(n, rng):
    """Chains and dense balls of near fingerprints among random ones."""
    base = rng.integers(0, 2**64, n // 8, dtype=np.uint64)
    out = [base]
    for _ in range(3):
        flips = np.zeros(len(base), np.uint64)
        for _ in range(5):
            flips |= np.uint64(1) << rng.integers(0, 64, len(base), dtype=np.uint64)
        out.append(out[-1] ^ flips)
    centre = rng.integers(0, 2**64, 1, dtype=np.uint64)[0]
    ball = [centre ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(24) for b in range(a)]
    return np.unique(np.concatenate([*out, np.array(ball, np.uint64)]))


def test_every_block_count_finds_the_same_components(spark):
    fps = near_fps(400, np.random.default_rng(3))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    want = brute_components(list(range(len(fps))), [int(x) for x in fps])
    for blocks in (5, 6, 7, 8):
        roots = {r.v % 2**64: r.root for r in components(S.links(df, 4, blocks)).collect()}
        names = {}
        for k, x in enumerate(fps):
            names.setdefault(roots.get(int(x), int(x.astype(np.int64))), set()).add(k)
        assert all(len({want[k] for k in g}) == 1 for g in names.values()), blocks
        assert len(names) == len(set(want)), blocks


def test_large_bucket_forest_and_pivot_filter():
    fps = near_fps(200, np.random.default_rng(5))
    pairs = S.bucket_links(np.zeros(len(fps), np.int64), fps, 4)
    assert len(pairs) < len(fps) and (np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) <= 4).all()
    i, j = np.triu_indices(len(fps), 1)
    table_ = np.bitwise_count(fps[None, :] ^ S.PIVOTS[:, None]).astype(np.int16)
    assert (S._close(fps, table_, i, j, 4) == (np.bitwise_count(fps[i] ^ fps[j]) <= 4)).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")) is None


def test_an_ordered_chain_takes_few_rounds(spark, monkeypatch):
    from lapengine.llm import components as C
    names, put = [], C.written
    monkeypatch.setattr(C, "written", lambda df, name: names.append(name) or put(df, name))
    got = {r.v: r.root for r in components(spark.range(1000).selectExpr("id as a", "id + 1 as b")).collect()}
    assert got == dict.fromkeys(range(1001), 0) and names.count("moves") <= 20
