"""Trees from histograms: against growth of one leaf at a time in plain numpy, and their properties."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapengine.operators import boosting as bo
from lapengine.operators import models as ml

BINS = bo.BINS
SIZES = np.array([BINS, BINS, 2, BINS, BINS])
SETTINGS = {
    "depth": bo.TreeSettings(4, 0.3, depth=3),
    "deeper with penalty, shares of rows and columns": bo.TreeSettings(4, 0.3, depth=5, rows=0.7, columns=0.6, l2=2.0),
    "leaves": bo.TreeSettings(4, 0.3, leaves=12, least_rows=9),
    "leaves and depth": bo.TreeSettings(3, 0.3, leaves=9, depth=4, columns=0.8),
    "forest": bo.TreeSettings(5, leaves=20),
    "forest without bound": bo.TreeSettings(2),
}


def _matrix(n=600, features=5, seed=0):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, BINS, (features, n)).astype(np.uint8)
    bins[2] = rng.random(n) < 0.3                               # a 0/1 column
    y = np.round(bins[0] * 3.0 - np.where(bins[1] > 20, 40, 0) * bins[2] + rng.normal(size=n), 3)
    return bo.Block(bins, rng.integers(0, 3, n).astype(np.int32), y, rng.integers(0, 2**63, n).astype(np.uint64), np.zeros((0, n)))


def plain(b, s, fold, tree, residuals, unit):
    """One tree, leaf by leaf, each best split looked for among all rows of the leaf."""
    w = bo.row_weights(s, tree, b.hashes)
    w = np.ones(len(b.y)) if w is None else w.astype(float)
    w = w * (b.fold != fold)
    r = np.rint(residuals / unit) * w
    used = np.flatnonzero(bo.Growing(s, len(b.bins), tree).used)

    def best(rows):
        g, n = r[rows].sum(), w[rows].sum()
        top = (0.0, None)
        for f in used:
            for cut in range(BINS - 1):
                go = b.bins[f, rows] <= cut
                gl, nl = r[rows][go].sum(), w[rows][go].sum()
                if nl >= max(1, s.least_rows) and n - nl >= max(1, s.least_rows):
                    gain = gl**2 / (nl + s.l2) + (g - gl) ** 2 / (n - nl + s.l2) - g**2 / (n + s.l2)
                    if gain > top[0] and gain > 1e-12 * g**2 / n:
                        top = (gain, (f, cut))
        return top
    value = np.zeros(len(b.y))
    leaves = [(best(np.arange(len(b.y))), np.arange(len(b.y)), 0)]
    while len(leaves) < (s.leaves or 1 << 30):
        able = [i for i, (x, _, d) in enumerate(leaves) if x[1] is not None and (s.depth is None or d < s.depth)]
        if not able:
            break
        i = max(able, key=lambda i: leaves[i][0][0])
        (_, (f, cut)), rows, d = leaves.pop(i)
        go = b.bins[f, rows] <= cut
        leaves += [(best(own), own, d + 1) for own in (rows[go], rows[~go])]
    for _, rows, _ in leaves:
        n = w[rows].sum()
        value[rows] = (s.rate or 1.0) * r[rows].sum() * unit / (n + s.l2) if n + s.l2 else 0.0
    return value, len(leaves)


@pytest.mark.parametrize("name", SETTINGS)
def test_trees_are_grown_leaf_by_leaf(spark, name):
    s, b = SETTINGS[name], _matrix()
    halves = [bo.Block(b.bins[:, p], b.fold[p], b.y[p], b.hashes[p], b.said[:, p]) for p in (np.arange(0, 250), np.arange(250, 250), np.arange(250, 600))]
    halves = [h for h in halves if len(h.y)]
    got = bo.fit(spark.sparkContext.parallelize(halves, 2), SIZES, [(s, 1), (s, -1)])
    for fold, m in zip((1, -1), got, strict=True):
        own = b.fold != fold
        start = b.y[own].mean()
        assert np.isclose(m.start, start)
        unit = 2.0 ** np.ceil(np.log2(4 * np.abs(b.y - start).max() * len(b.y) / 2.0**52))
        said = np.zeros(len(b.y))
        assert len(m.trees) == s.trees
        for t, tree in enumerate(m.trees):
            value, leaves = plain(b, s, fold, t, b.y - m.start - (said if s.rate else 0), unit)
            assert (tree.left == np.arange(len(tree.left))).sum() == leaves
            assert np.allclose(tree.predict(b.bins), value, rtol=1e-9, atol=1e-9)
            said += value
        assert np.allclose(m.predict(b.bins), m.start + (said if s.rate else said / s.trees))


def test_partitions_and_kinds_side_by_side_change_nothing(spark, monkeypatch):
    b = _matrix(900, seed=4)
    mixed = np.random.default_rng(1).permutation(900)
    cut = lambda order, k: [bo.Block(b.bins[:, p], b.fold[p], b.y[p], b.hashes[p], b.said[:, p]) for p in np.array_split(order, k)]
    wanted = [(s, f) for s in SETTINGS.values() for f in (0, 2)]
    one = bo.fit(spark.sparkContext.parallelize(cut(np.arange(900), 1), 1), SIZES, wanted)
    monkeypatch.setattr(bo, "REFRESH", 2)
    monkeypatch.setattr(bo, "MANY_BLOCKS", 3)                   # sums by a tree of tasks
    many = bo.fit(spark.sparkContext.parallelize(cut(mixed, 9), 7), SIZES, wanted, side_by_side=3)
    for x, y in zip(one, many, strict=True):
        assert x.start == pytest.approx(y.start, abs=1e-12) and len(x.trees) == len(y.trees)
        assert np.allclose(x.predict(b.bins), y.predict(b.bins), atol=1e-9)


def test_no_rows_no_spread_and_one_row(spark):
    b = _matrix(50)
    same = bo.Block(b.bins, b.fold, np.full(50, 7.0), b.hashes, b.said)
    one = bo.Block(b.bins[:, :1], b.fold[:1], b.y[:1], b.hashes[:1], b.said[:, :1])
    for block, want in ((same, 7.0), (one, b.y[0])):
        for m in bo.fit(spark.sparkContext.parallelize([block], 1), SIZES, [(s, -1) for s in SETTINGS.values()]):
            assert np.allclose(m.predict(block.bins), want)
    own = int(one.fold[0])
    assert bo.fit(spark.sparkContext.parallelize([one], 1), SIZES, [(SETTINGS["depth"], own)])[0].trees == []
    assert bo.fit(spark.sparkContext.parallelize([], 1), SIZES, [(SETTINGS["depth"], 0)])[0].predict(b.bins).tolist() == [0.0] * 50


def test_bins_of_nulls_unknown_levels_and_edges(spark):
    df = spark.createDataFrame([(float(i), None if i % 10 == 0 else "abc"[i % 3], 1.0) for i in range(100)] + [(None, "c", 2.0)], "x double, c string, y double")
    b = bo.find_bins(df, ["x", "y"], ["c"], 4)
    assert b.names == ["x", "y", "c_a", "c_b", "c_c"] and len(b.edges[0]) == 3
    cols = [pa.array([None, -5.0, b.edges[0][0], b.edges[0][0] + 0.1, 1e9]), pa.array([1.0] * 5), pa.array(["a", None, "zz", "c", "b"])]
    assert b.bins(cols).tolist() == [[0, 0, 0, 1, 3], [0] * 5, [1, 0, 0, 0, 0], [0, 0, 0, 0, 1], [0, 0, 0, 1, 0]]
    assert bo.find_bins(df.limit(0), ["x"], ["c"]).names == ["x"]


def test_cross_validation_predicts_every_row_by_models_of_other_folds(spark):
    rng = np.random.default_rng(3)
    rows = [(str(i), float(x), float(z), "pq"[i % 2], float(3 * x - 2 * (z > 0.5) + 4 * (i % 2))) for i, (x, z) in enumerate(rng.random((1500, 2)))]
    df = spark.createDataFrame(rows, "id string, x double, z double, c string, t double")
    settings = {"GradientBoosting": bo.TreeSettings(40, 0.2, depth=3), "RandomForest": bo.TreeSettings(10, leaves=64)}
    out = ml.cross_validate_trees(df, settings, ["x", "z"], ["c"], "id", "t", 3, refit=True)
    for name, cv in out.items():
        p = cv.predictions.toPandas()
        assert sorted(p.id) == sorted(r[0] for r in rows)
        fold_r2 = [1 - ((g.y_true - g.y_pred) ** 2).sum() / ((g.y_true - g.y_true.mean()) ** 2).sum() for _, g in p.groupby("fold")]
        assert min(fold_r2) > 0.98 and cv.metrics.first().R2 == pytest.approx(np.mean(fold_r2))
        assert len(cv.model.trees) == settings[name].trees
    once = out["GradientBoosting"].predictions.select("id", "y_pred").toPandas().set_index("id").y_pred
    again = ml.cross_validate_trees(df.repartition(5), {"GradientBoosting": settings["GradientBoosting"]}, ["x", "z"], ["c"], "id", "t", 3)
    assert np.allclose(once.sort_index(), again["GradientBoosting"].predictions.toPandas().set_index("id").y_pred.sort_index())


def test_zoo_settings():
    z = ml.tree_zoo()
    assert list(z) == [m for m in ml.MODEL_ORDER if m != "Lasso"]
    assert (z["RandomForest"].trees, z["RandomForest"].depth, z["RandomForest"].rate, z["RandomForest"].columns) == (300, None, None, 1.0)
    assert (z["GradientBoosting"].trees, z["GradientBoosting"].rate, z["GradientBoosting"].depth) == (100, 0.1, 3)
    assert (z["XGBoost"].trees, z["XGBoost"].rate, z["XGBoost"].depth, z["XGBoost"].rows, z["XGBoost"].columns) == (400, 0.05, 4, 0.9, 0.9)
    assert (z["LightGBM"].trees, z["LightGBM"].rate, z["LightGBM"].leaves, z["LightGBM"].depth) == (400, 0.05, 31, None)
    assert ml.tree_zoo({"n_estimators": 7, "max_depth": 2})["RandomForest"].depth == 2


@pytest.mark.parametrize("n", [0, 1, 4, 5, 103])
def test_exact_folds_differ_by_one_row(spark, n):
    df = spark.range(n).selectExpr("cast(id as string) id", "1 as _x").repartition(7)
    got = ml.with_exact_fold(df, "id", 5)
    sizes = sorted((r["count"] for r in got.groupBy("fold").count().collect()), reverse=True)
    assert sizes == [s for s in (n // 5 + (i < n % 5) for i in range(5)) if s] and got.columns == ["id", "_x", "fold"]
    assert sorted(got.select("id", "fold").collect()) == sorted(ml.with_exact_fold(df.repartition(2), "id", 5).select("id", "fold").collect())


def test_sketch_quantiles_of_a_hot_group_are_within_the_stated_error(spark):
    from lapengine.operators import aggregates as agg
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 7 as string)) g", "(id * 7919) % 10007 as v")
    probs = [0.25, 0.5, 0.75]
    errors = agg.rank_errors(df, "g", "v", agg.sketch_quantiles(df, "g", "v", probs, 100), probs).collect()
    assert len(errors) == 24 and all(r.error <= 0.01 + 1 / r.n for r in errors)
    exact, sketch = (agg.box_stats(df, "g", "v", exact=e).orderBy("g").collect() for e in (True, False))
    assert all(abs(a.median - b.median) <= 10 and a.n == b.n for a, b in zip(exact, sketch, strict=True))
    from io import StringIO
    from contextlib import redirect_stdout
    with redirect_stdout(StringIO()) as said:
        agg.sketch_quantiles(df, "g", "v", probs).explain()
    assert "rangepartitioning" not in said.getvalue()


class Here:
    """An RDD's calls in this process."""

    def __init__(self, parts):
        self.parts = parts

    def flatMap(self, f):
        return Here([[y for x in p for y in f(x)] for p in self.parts])

    def map(self, f):
        return Here([[f(x) for x in p] for p in self.parts])

    def mapPartitions(self, f):
        return Here([list(f(iter(p))) for p in self.parts])

    def persist(self, *_):
        return self

    unpersist = checkpoint = persist

    def count(self):
        return len(self.collect())

    def collect(self):
        return [x for p in self.parts for x in p]

    def getNumPartitions(self):
        return len(self.parts)


def test_a_finished_tree_is_evaluated_once_a_block(monkeypatch):
    calls = []
    whole = bo.Tree.predict
    monkeypatch.setattr(bo.Tree, "predict", lambda t, bins: calls.append(id(t)) or whole(t, bins))
    for s in (SETTINGS["depth"], SETTINGS["leaves"]):
        bo.fit(Here([[_matrix()]]), SIZES, [(s, 0), (s, 1)])
    assert len(calls) <= 4 * 4


def test_groups_of_columns_count_what_single_columns_do(monkeypatch):
    b, off = _matrix(3000), np.concatenate([[0], np.cumsum(SIZES)])
    groups = bo.column_groups(SIZES)
    assert sorted(f for g in groups for f in g) == list(range(5)) and len(groups) == 3 and max(SIZES[g].prod() for g in groups) <= bo.JOINT_CELLS
    (whole,) = bo.prepared(iter([b]), SIZES, 1)
    for name, s in SETTINGS.items():
        m, = bo.fit(Here([[b]]), SIZES, [(s, 1)])
        used, tree = bo.Growing(s, 5, 0).used, m.trees[0]
        nodes = [v for v in range(len(tree.left)) if tree.left[v] == v][:3]
        ask = (0, 0 if s.rate else None, 1, m.start, 2.0**-40, s, 0, tree, used, nodes)
        got = []
        for least in (0, 1 << 30):
            monkeypatch.setattr(bo, "JOINT_ROWS", least)
            got.append(bo.count_block(whole, [ask], off, groups))
        assert np.array_equal(*got) and got[0].any(), name
        w = bo.row_weights(s, 0, b.hashes)
        for k, v in enumerate(nodes):
            own = (tree.leaf(b.bins) == v) & (b.fold != 1)
            f = np.flatnonzero(used)[0]
            want = np.bincount(b.bins[f][own], None if w is None else w[own], SIZES[f])
            assert np.array_equal(got[0][k, off[f]:off[f + 1], 1], want), name


def test_blocks_are_joined_and_rows_found_leaf_by_leaf():
    b = _matrix(500)
    parts = [bo.Block(b.bins[:, p], b.fold[p], b.y[p], b.hashes[p], b.said[:, p]) for p in np.array_split(np.arange(500), 7)]
    (one,) = bo.prepared(iter(parts), SIZES, 2)
    assert np.array_equal(one.bins, b.bins) and one.said.shape == (2, 500) and list(bo.prepared(iter([]), SIZES, 2)) == []
    m, = bo.fit(Here([[b]]), SIZES, [(SETTINGS["leaves"], 0)])
    for t in m.trees:
        said = np.zeros(500)
        t.add_to(said, b.bins)
        assert np.array_equal(said, t.predict(b.bins))


def test_blocks_of_one_row_group_are_dealt_out_to_all_cores(spark, tmpdir_path):
    spark.range(8000).selectExpr("id", "int(id % 5) AS fold", "double(id % 97) AS label", "double(hash(id)) AS x").coalesce(1).write.parquet(f"{tmpdir_path}/rows")
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "100"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.read.parquet(f"{tmpdir_path}/rows")
        blocks = bo.blocks_of(df, bo.find_bins(df, ["x"], []), "id", f"{tmpdir_path}/bins")
        rows = [sum(len(b.y) for b in part) for part in blocks.glom().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    assert sum(rows) == 8000 and sum(n > 0 for n in rows) >= cores and max(rows) <= 2 * 8000 / cores


def test_boosted_counts_of_drawn_rows_are_weighted_sums():
    b = _matrix(500)
    b.said = np.vstack([np.arange(500) * 0.25])
    s, off = bo.TreeSettings(1, 0.3, rows=0.6), np.concatenate([[0], np.cumsum(SIZES)])
    grown = bo.Growing(s, 5, 0)
    got = bo.count_block(b, [(0, 0, 1, 2.0, 0.5, s, 0, grown.partial(), grown.used, [0])], off, [[f] for f in range(5)])[0]
    w = bo.row_weights(s, 0, b.hashes) * (b.fold != 1)
    r = np.rint((b.y - 2.0 - b.said[0]) / 0.5) * w
    for f in range(5):
        assert (got[off[f]:off[f + 1], 0] == np.bincount(b.bins[f], r, SIZES[f])).all()
        assert (got[off[f]:off[f + 1], 1] == np.bincount(b.bins[f], w, SIZES[f])).all()


def _table(spark, n=3000, rows_a_batch=250):
    rng = np.random.default_rng(11)
    rows = [(i, int(f), float(np.round(3 * a - 40 * (b > 0.6) * (c == "p") + e, 3)), float(a) if i % 17 else None, float(b), c if i % 13 else None)
            for i, (f, a, b, c, e) in enumerate(zip(rng.integers(0, 3, n), rng.random(n) * 30, rng.random(n), rng.choice(list("pqrs"), n), rng.normal(size=n)))]
    return spark.createDataFrame(rows, "id long, fold int, label double, a double, b double, c string")


def test_rows_of_a_table_are_counted_in_the_jvm_to_the_same_trees(spark, tmpdir_path, monkeypatch):
    from lapengine.operators import jvm
    df = _table(spark)
    binning = bo.find_bins(df, ["a", "b"], ["c"])
    blocks = bo.blocks_of(df, binning, "id", f"{tmpdir_path}/bins")
    wanted = [(s, f) for s in SETTINGS.values() for f in (0, 2, -1)]
    want = bo.fit(blocks.filter(lambda b: True), binning.sizes, wanted)        # no frame: in Python

    def never(*_):
        raise AssertionError("blocks went to Python")
    monkeypatch.setattr(bo, "count", never)
    for many in (64, 0):                                        # sums on the driver, by a tree of tasks
        monkeypatch.setattr(jvm, "MANY_PARTS", many)
        monkeypatch.setattr(bo, "REFRESH", 2)
        got = bo.fit(blocks, binning.sizes, wanted, side_by_side=7)
        for x, y in zip(got, want, strict=True):
            assert x.start == pytest.approx(y.start, abs=1e-12) and len(x.trees) == len(y.trees)
            for p, q in zip(x.trees, y.trees, strict=True):
                assert all(np.array_equal(getattr(p, c), getattr(q, c)) for c in ("feature", "cut", "left", "right")) and np.allclose(p.value, q.value, atol=1e-9)


def test_rows_are_scored_by_their_folds_models(spark, tmpdir_path):
    df = _table(spark)
    binning = bo.find_bins(df, ["a", "b"], ["c"])
    blocks = bo.blocks_of(df, binning, "id", f"{tmpdir_path}/bins")
    for s in (SETTINGS["forest"], SETTINGS["leaves"]):
        models = dict(zip((0, 1, 2), bo.fit(blocks, binning.sizes, [(s, f) for f in (0, 1, 2)]), strict=True))
        got = sorted(map(tuple, bo.scored(blocks.frame, binning.sizes, models).collect()))
        want = sorted(map(tuple, df.select("fold", "label", bo.predicted(df, binning, models, F.col("fold"))).collect()))
        assert len(got) == 3000 and np.allclose(got, want, atol=1e-9)


def test_shared_nodes_of_a_forest_are_counted_once():
    from lapengine.operators import jvm
    b = _matrix(900)
    s, every = SETTINGS["forest"], np.ones(5, bool)
    tree = bo.fit(Here([[b]]), SIZES, [(s, 0)])[0].trees[0]
    leaf = int(np.flatnonzero(tree.left == np.arange(len(tree.left)))[-1])
    m = jvm.Matrix.__new__(jvm.Matrix)
    m.folds, m.places = [0, 1], 3
    agree = [(i, None, i, 0.0, 1.0, s, 0, tree, every, [leaf]) for i in (0, 1)]
    lists, units = m._trie(agree, [0, 1], {}, 0, {})
    assert units == 3 and sum(u >= 0 for u in lists[1]) == 1    # one node for both, by fold
    found, apart = {}, [agree[0], (1, None, 1, 0.0, 1.0, s, 0, bo.Growing(s, 5, 0).partial(), every, [0])]
    assert m._trie(apart, [0, 1], {}, 0, found)[1] == 3 + 1
    assert set(found) == {(0, leaf), (1, 0)} and not found[0, leaf][1] and found[1, 0][1]


def test_permuted_rows_are_scored_in_the_jvm(spark, tmpdir_path, monkeypatch):
    from lapengine.operators import attribution as attr
    from lapengine.operators import jvm
    df = _table(spark).where("a IS NOT NULL AND c IS NOT NULL").withColumn("key", F.col("id").cast("string"))
    binning = bo.find_bins(df, ["a", "b"], ["c"])
    blocks = bo.blocks_of(df, binning, "key", f"{tmpdir_path}/bins")
    calls, run = [], jvm.permuted_errors
    monkeypatch.setattr(jvm, "permuted_errors", lambda rows, *args: calls.append(rows.columns) or run(rows, *args))
    for s in (SETTINGS["forest"], SETTINGS["leaves"]):
        model = bo.fit(blocks, binning.sizes, [(s, -1)])[0]
        got = {r.feature: r.value for r in attr.ensemble_permutation_importance(model, binning, df, ["c", "b"], "label", "key", 300).collect()}
        rows = df.select("key", "label", "a", "b", "c", attr._bucket("key", df.count(), 300, 42).alias("at"), *[attr._turn("key", i, 42).alias(f"t{i}") for i in (0, 1)]).toPandas()
        rows = rows.sort_values("key").reset_index(drop=True)

        def errors(x):
            return np.abs(model.predict(binning.bins([pa.array(x[c]) for c in "abc"])) - x.label).mean()
        for i, c in enumerate("cb"):
            other = rows.copy()
            for _, own in rows.groupby("at"):
                other.loc[own.index, c] = own.sort_values(f"t{i}")[c].to_numpy()
            assert np.isclose(got[c], errors(other) - errors(rows), atol=1e-9) and got[c] > 0.01
    assert calls == [["n", "y", "bins", "turned"]] * 2
