import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapengine.llm import negatives as N
from lapengine.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def whole(v):
    return tuple(math.floor(256 * float(np.float32(x))) for x in v)


def brute(rows, is_anchor, positives=5, negatives=3):
    """rows: (id, label, whole-number vector)."""
    rows, out = sorted(set(rows)), set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, label, q in rows:
        if not is_anchor(i):
            continue
        others = sorted((-dot(q, v), j, m) for j, m, v in rows if j != i)
        for s, p, _ in [x for x in others if x[2] == label][:positives]:
            near = [x for x in others if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out |= {(i, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(near)}
    return out


def rows_of(df):
    return {tuple(r[c] for c in OUT) for r in df.collect()}


@pytest.mark.parametrize("kind", ["clustered", "unit", "tied", "scales"])
def test_tree_and_blocks_change_nothing(spark, kind):
    rng = np.random.default_rng(7)
    n, d = 400, 6
    x = rng.normal(size=(n, d)) * 60
    if kind == "clustered":
        x = x / 6 + rng.normal(size=(8, d))[rng.integers(8, size=n)] * 100
    if kind == "unit":
        x = 256 * x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "tied":
        x = rng.integers(-1, 2, (n, d)) * (rng.random((n, 1)) < 0.6)        # a third and more are alike
    if kind == "scales":
        x *= 10.0 ** rng.integers(-1, 4, (n, 1))
    rows = [(int(i), int(rng.integers(3)), tuple(int(c) for c in v)) for i, v in enumerate(np.floor(x))]
    df = spark.createDataFrame(rows, "vec_id long, label long, q array<long>")
    index = N.build(df, sample=150, ways=4, leaf_rows=30)
    assert index.tree.leaves >= (2 if kind == "tied" else 8)
    assert rows_of(N.hard_negatives(df, F.col("vec_id") % 10 == 0, index=index)) == brute(rows, lambda i: i % 10 == 0)
    if kind == "tied":                                      # one anchor's leaf cut into many small blocks
        asks = index.rows.where("vec_id < 40").withColumn("windows", F.expr("array(struct(-100L lo, 100L hi))"))
        got = N.search(index, asks, 3, False, rows_at_once=7, queries_at_once=2)
        one = N.search(index, asks, 3, False)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, one.collect())) and got.count() == 120


def test_ranges_leave_subtrees_out():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(12, 16))[rng.integers(12, size=3000)] * 100 + rng.normal(size=(3000, 16)) * 4)
    top = float((x * x).sum(axis=1).max())
    tree = N.fit(np.arange(3000), np.zeros(3000, np.int64), x, top, 1.0, 6, 60)
    leaf, ranges = N.dealt(tree, x)
    for node in tree.nodes:
        node.low, node.high = np.full((len(node.points),) * 2, np.inf), np.full((len(node.points),) * 2, -np.inf)
    for (node, child), (lo, hi) in ranges.items():
        tree.nodes[node].low[:, child], tree.nodes[node].high[:, child] = lo, hi
    q, scores = x[:200], x[:200] @ x.T
    own = (q * q).sum(axis=1)
    low, high = (0.8 * own)[:, None], (0.95 * own)[:, None]
    at, leaves = N.reached(tree, q, low, high)
    seen = set(zip(at.tolist(), leaves.tolist(), strict=True))
    i, j = np.nonzero((scores >= low) & (scores <= high))
    assert all((a, int(leaf[b])) in seen for a, b in zip(i.tolist(), j.tolist(), strict=True)) and len(i)
    assert len(seen) < 0.5 * 200 * tree.leaves              # and most leaves are not visited


def test_scan_ties_and_steps(monkeypatch):
    monkeypatch.setattr(N, "STEP_QUERIES", 3)
    x, ids = np.ones((50, 2)), np.arange(50)
    q, w, at, s = N.scan(ids, ids % 2, x, np.array([4, 5, 60, 61]), np.array([0, 1, 0, 1]), np.ones((4, 2)), np.full((4, 1), 2), np.full((4, 1), 2), 3, True)
    got = {k: sorted(at[q == k].tolist()) for k in range(4)}
    assert got == {0: [0, 2, 6], 1: [1, 3, 7], 2: [0, 2, 4], 3: [1, 3, 5]} and set(s.tolist()) == {2}


def test_matrix_of_unlike_lengths():
    assert N.matrix(pa.array([[1], [], [1, 2, 3]], pa.list_(pa.int64())), 3).tolist() == [[1, 0, 0], [0, 0, 0], [1, 2, 3]]


def test_nulls_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    good = [(i, int(rng.integers(2)), [float(np.float32(v)) for v in rng.normal(size=3)]) for i in range(60)]
    odd = [(None, 1, [1.0, 2.0, 3.0]), (61, None, [1.0] * 3), (62, 1, None), (63, 1, [1.0, None, 2.0]), (64, 0, [float("nan"), 0.0, 1.0]),
           (65, 0, [float("inf"), 0.0, 1.0]), (66, 0, [1e30, 0.0, 0.0]), (70, 1, [0.5]), (71, 0, []), good[3], good[3], good[10], (10, 1, [0.25, 0.5, 0.75])]
    df = spark.createDataFrame([(*r, 1, "x", r[0]) for r in good + odd], "vec_id long, label int, embedding array<float>, q int, windows string, row long")
    rows = [(i, m, whole(v)) for i, m, v in good + odd if i is not None and m is not None and v is not None and i not in (63, 64, 65, 66)]
    use = N.usable(df, "vec_id", "label", "embedding")
    assert sorted((r.vec_id, r.label, tuple(r.q)) for r in use.collect()) == sorted(set(rows))
    index = N.build(use, sample=30, ways=3, leaf_rows=8)
    assert rows_of(N.hard_negatives(use, F.col("vec_id") % 5 == 0, index=index)) == brute(rows, lambda i: i % 5 == 0)
    assert N.hard_negatives(use.limit(0)).collect() == []


def test_query_is_sql_and_brute_force(spark):
    got = rows_of(QUERIES["op11_hard_negatives"](spark, SF))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(f"SELECT {','.join(OUT)} FROM ({ORACLE['op11_hard_negatives']})").fetchall()
    assert len(want) == len(got) and set(want) == got
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, whole(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got == brute(rows, lambda i: i % 50 == 0)
