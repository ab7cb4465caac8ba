"""Classes of this package that executors run in their own JVM.

``Trees.java`` is compiled on the driver by Janino, which Spark brings along and
compiles its own plans with, and handed to the executors as a jar; no compiler
or library has to be installed anywhere.  ``Matrix`` gives the passes of
``boosting`` over blocks that stay in the executors' JVMs: no rows go to Python.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark import SparkContext
from pyspark.core.rdd import _load_from_socket
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_CELLS, MANY_PARTS, RESULT_BYTES = 128, 64, 256 << 20
# of a partition: one read back from disk is held whole by Java's deserialisation, with predictions two of them; a forest's sums are large, so fewer parts
PART_BYTES, FOREST_PART_BYTES = 64 << 20, 160 << 20
MASK = 0x9E3779B97F4A7C15
_loaders: dict[str, object] = {}


def make(sc: SparkContext, name: str, *args):
    """An object of a class of ``Trees.java``."""
    jvm, gateway = sc._jvm, sc._gateway
    if sc.applicationId not in _loaders:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(Path(__file__).with_name("Trees.java").read_text())
        path = f"{tempfile.mkdtemp(prefix='lapengine-jar-')}/lapengine-trees.jar"
        with zipfile.ZipFile(path, "w") as jar:
            for k, code in compiler.getBytecodes().items():
                jar.writestr(f"{k.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(path)
        urls = gateway.new_array(jvm.java.net.URL, 1)
        urls[0] = jvm.java.io.File(path).toURI().toURL()
        _loaders[sc.applicationId] = jvm.java.net.URLClassLoader(urls, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    given = gateway.new_array(jvm.java.lang.Object, len(args))
    for i, x in enumerate(args):
        given[i] = x
    return _loaders[sc.applicationId].loadClass(f"lapengine.Trees${name}").getConstructors()[0].newInstance(given)


def ints(x) -> bytes:
    return np.array([len(x), *x], "<i4").tobytes()


def longs(*x: int) -> bytes:
    return (np.array(x, dtype=object) % 2**64).astype("<u8").tobytes()


def doubles(x) -> bytes:
    return np.asarray(x, "<f8").tobytes()


def splits(pairs: list[tuple[int, int]], group: np.ndarray, factor: np.ndarray, sizes: np.ndarray) -> bytes:
    """Group and left codes of each (feature, cut)."""
    f, cut = np.array(pairs, int).reshape(-1, 2).T
    left = np.arange(256) // factor[f][:, None] % sizes[f][:, None] <= cut[:, None]
    return ints(group[f]) + left.astype(np.uint8).tobytes()


def whole_trees(trees: list, group: np.ndarray, factor: np.ndarray, sizes: np.ndarray) -> bytes:
    """Trees for ``Added``; None: a tree without nodes."""
    number: dict[tuple[int, int], int] = {}
    plan = []
    for t in trees:
        if t is None:
            plan.append(ints([]) * 3)
            continue
        split = [number.setdefault((f, c), len(number)) if a != v else 0 for v, (f, c, a) in enumerate(zip(t.feature.tolist(), t.cut.tolist(), t.left.tolist(), strict=True))]
        plan.append(ints(split) + ints(t.left) + ints(t.right) + doubles(t.value))
    return splits(list(number), group, factor, sizes) + np.array(len(trees), "<i4").tobytes() + b"".join(plan)


def grouped(sizes: np.ndarray, groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each column its group and its factor in the group's code."""
    group, factor = np.zeros(len(sizes), int), np.ones(len(sizes), int)
    for i, own in enumerate(groups):
        for j, f in enumerate(own):
            group[f], factor[f] = i, int(np.prod(sizes[own[j + 1:]]))
    return group, factor


def _frame(spark, rdd, schema: str) -> DataFrame:
    return DataFrame(spark._jsparkSession.createDataFrame(rdd, spark._jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)), spark)


def scored(frame: DataFrame, sizes: np.ndarray, groups: list[list[int]], models: dict) -> DataFrame:
    """``fold, y_true, y_pred`` of the binned rows of ``frame``, each by the ensemble of its fold."""
    group, factor = grouped(sizes, groups)
    folds = sorted(models)
    plan = ints(folds)
    for f in folds:
        m = models[f]
        own = whole_trees(m.trees, group, factor, sizes)
        plan += doubles([m.start, max(1, len(m.trees)) if m.settings.rate is None else 1]) + np.array(len(own), "<i4").tobytes() + own
    sc = frame.sparkSession.sparkContext
    rows = frame.select("n", "fold", "y", "h", "bins").repartition(sc.defaultParallelism)._jdf.toJavaRDD()
    blocks = rows.mapPartitions(make(sc, "Prepare", ints(folds) + ints(group) + ints(factor)))
    return _frame(frame.sparkSession, blocks.mapPartitions(make(sc, "Score", plan)), "fold int, y_true double, y_pred double")


def permuted_errors(rows: DataFrame, sizes: np.ndarray, input_of: list[int], inputs: int, model) -> DataFrame:
    """``s``: rows, absolute errors and those with each input permuted, summed over some of ``rows`` (n, y, bins, turned)."""
    own = whole_trees(model.trees, np.arange(len(sizes)), np.ones(len(sizes), int), sizes)
    plan = doubles([model.start, max(1, len(model.trees)) if model.settings.rate is None else 1]) + ints(input_of) + np.array(inputs, "<i4").tobytes() + own
    spark = rows.sparkSession
    return _frame(spark, rows._jdf.toJavaRDD().mapPartitions(make(spark.sparkContext, "Permuted", plan)), "s array<double>")


class Matrix:
    """The binned rows of ``frame`` (see ``boosting.blocks_of``) and what the boosted models say of them so far."""

    def __init__(self, frame: DataFrame, sizes: np.ndarray, folds: list[int], boosted: int, groups: list[list[int]], poisson: np.ndarray) -> None:
        self.sc, self.sizes, self.folds, self.boosted, self.groups = frame.sparkSession.sparkContext, sizes, sorted({f for f in folds if f >= 0}), boosted, groups
        self.off = np.concatenate([[0], np.cumsum(sizes)])
        self.group, self.factor = grouped(sizes, groups)
        wide = [int(np.prod(sizes[own])) for own in groups]
        self.first, self.cells = np.concatenate([[0], np.cumsum(wide)])[:-1].astype(int), sum(wide)
        cells = [(int(first) + c, int(self.off[f]) + c // int(self.factor[f]) % int(sizes[f])) for first, n, own in zip(self.first, wide, groups, strict=True)
                 for f in own for c in range(n)]
        self.single = ints([a for a, _ in cells]) + ints([b for _, b in cells])     # cells by group, cells by column
        self.steps = np.ceil(poisson * 2.0**53).astype(np.int64)
        rows = frame.agg(F.sum("n").alias("n")).first().n or 0
        cores = self.sc.defaultParallelism
        self.parts = cores * max(1, -(-rows * (len(groups) + 17 + 8 * boosted) // (cores * (PART_BYTES if boosted else FOREST_PART_BYTES))))
        self.level = self.sc._jvm.org.apache.spark.api.java.StorageLevels.MEMORY_AND_DISK
        own = frame.select("n", "fold", "y", "h", "bins").repartition(self.parts)._jdf.toJavaRDD()
        self.blocks = own.mapPartitions(make(self.sc, "Prepare", ints(self.folds) + ints(self.group) + ints(self.factor))).persist(self.level)
        self.said, self.behind = None, None
        if boosted:
            # what is said of the rows lies beside them, so a lost block must come back with its rows in the same order
            self.blocks.checkpoint()
        self.places = len(self.folds)

    def stats(self) -> dict[int | None, list[tuple]]:
        """Fold (None: any that no model leaves out) -> rows, sum, least and most of the target of each block."""
        out: dict[int | None, list[tuple]] = {}
        for x in self._collected(self.blocks.mapPartitions(make(self.sc, "Stats", len(self.folds)))):
            f, n, *rest = np.frombuffer(x, "<f8").tolist()
            out.setdefault(self.folds[int(f)] if f < len(self.folds) else None, []).append((int(n), *rest))
        self.places = len(self.folds) + (None in out)
        if self.boosted:
            self.said = self.blocks.mapPartitions(make(self.sc, "Zeros", self.boosted)).persist(self.level)
        return out

    def _collected(self, rdd) -> Iterator[bytes]:
        """One after another: the driver's Python holds one at a time."""
        return _load_from_socket(self.sc._jvm.PythonRDD.collectAndServe(rdd.rdd()), NoOpSerializer())

    def _splits(self, pairs: list[tuple[int, int]]) -> bytes:
        return splits(pairs, self.group, self.factor, self.sizes)

    def add(self, fresh: list, checkpoint: bool) -> None:
        """A new tree of each boosted model (None: none) is added to the predictions; the pass that reads them first persists them."""
        self.behind, self.said = self.said, self.blocks.zipPartitions(self.said, make(self.sc, "Add", whole_trees(fresh, self.group, self.factor, self.sizes))).persist(self.level)
        if checkpoint:
            self.said.checkpoint()

    def count(self, asks: list[tuple]) -> np.ndarray:
        """``boosting.count``: sums of residuals and rows of every node asked for, node x cell x 2.

        The trees of a forest that draw the same rows (those of all folds) are followed together as far as they agree,
        and what they share is counted once, by fold.
        """
        number: dict[tuple[int, int], int] = {}
        together: dict[tuple, list[int]] = {}
        for i, (_, slot, _, start, unit, s, t, *_) in enumerate(asks):
            share = 2**53 if s.rate is None else int(np.ceil(s.rows * 2.0**53))
            kind = 2 if s.rate is None else 1 if s.rows < 1 else 0
            draw = (kind, s.seed * 1_000_003 + t if kind else 0, share)
            together.setdefault((*draw, -1 if slot is None else slot, start, unit), []).append(i)
        tries, units, found = [], 0, {}
        for (kind, salt, share, slot, start, unit), own in sorted(together.items()):
            lists, units = self._trie(asks, own, number, units, found)
            tries.append(np.array(kind, "<i4").tobytes() + longs(salt * MASK, share) + np.array(slot, "<i4").tobytes() + doubles([start, unit])
                         + b"".join(map(ints, lists)))
        plan = (self._splits(list(number)) + ints(self.first) + self.single + np.array([self.cells, units, self.off[-1]], "<i4").tobytes() + longs(*self.steps.tolist())
                + np.array(len(tries), "<i4").tobytes() + b"".join(tries))
        if self.said is None:
            parts = self.blocks.mapPartitions(make(self.sc, "Count", plan))
        else:
            parts = self.blocks.zipPartitions(self.said, make(self.sc, "CountSaid", plan))
        if self.parts > MANY_PARTS or self.parts * units * int(self.off[-1]) * 16 > RESULT_BYTES:
            sums = np.frombuffer(parts.treeReduce(make(self.sc, "Sum"), 2), "<f8")
        else:
            sums = np.zeros(units * int(self.off[-1]) * 2)
            for x in self._collected(parts):
                sums += np.frombuffer(x, "<f8")
        if self.behind is not None:
            self.behind.unpersist()
            self.behind = None
        return self._own(asks, sums.reshape(units, int(self.off[-1]), 2), found)

    def _trie(self, asks: list[tuple], own: list[int], number: dict, units: int, found: dict) -> tuple[list, int]:
        """The nodes of some trees as one: their numbers for ``Trie``; ``found``: where the sums of an ask's node will be."""
        wanted, tree, asked = {}, {}, {}
        for i in own:
            t, nodes = asks[i][7], asks[i][9]
            feature, cut, left, right = (x.tolist() for x in (t.feature, t.cut, t.left, t.right))
            need = [False] * len(left)
            for v in nodes:
                need[v] = True
            for v in range(len(left) - 1, -1, -1):
                need[v] = need[v] or need[left[v]] or need[right[v]]
            wanted[i], tree[i], asked[i] = need, (feature, cut, left, right), set(nodes)
        ban, unit_of, by_fold, kids, split, to_left, to_right = [], [], [], [0], [], [], []
        queue = [[(i, 0) for i in own]]
        for members in queue:
            folds = {asks[i][2] for i, _ in members}
            only = folds.pop() if len(folds) == 1 else -1
            ban.append(self.folds.index(only) if only >= 0 else -1)
            mixed = bool(folds)
            here = [(i, v) for i, v in members if v in asked[i]]
            unit_of.append(units if here else -1)
            by_fold.append(int(mixed))
            for x in here:
                found[x] = (units, mixed)
            if here:
                units += self.places if mixed else 1
            ways: dict[tuple[int, int], list] = {}
            for i, v in members:
                feature, cut, left, right = tree[i]
                if left[v] != v and (wanted[i][left[v]] or wanted[i][right[v]]):
                    ways.setdefault((feature[v], cut[v]), []).append((i, left[v], right[v]))
            for way, some in ways.items():
                split.append(number.setdefault(way, len(number)))
                for side, out in ((1, to_left), (2, to_right)):
                    on = [(x[0], x[side]) for x in some if wanted[x[0]][x[side]]]
                    out.append(len(queue) if on else -1)
                    if on:
                        queue.append(on)
            kids.append(len(split))
        return [ban, unit_of, by_fold, kids, split, to_left, to_right], units

    def _own(self, asks: list[tuple], each: np.ndarray, found: dict) -> np.ndarray:
        """For each node asked for its own sums, from those by fold where trees share it."""
        out = np.empty((sum(len(a[9]) for a in asks), *each.shape[1:]))
        at, of = 0, np.repeat(np.arange(len(self.sizes)), self.sizes)
        for i, a in enumerate(asks):
            fold, used, nodes = a[2], a[8], a[9]
            for v in nodes:
                unit, mixed = found[i, v]
                if mixed:
                    out[at] = sum(each[unit + p] for p in range(self.places) if fold < 0 or p != self.folds.index(fold))
                else:
                    out[at] = each[unit]
                at += 1
            if not used.all():
                out[at - len(nodes):at, ~used[of]] = 0
        return out

    def close(self) -> None:
        for x in (self.said, self.behind, self.blocks):
            if x is not None:
                x.unpersist()


def supported(frame: DataFrame | None, sizes: np.ndarray, folds: list[int]) -> bool:
    return frame is not None and len(sizes) > 0 and int(sizes.max(initial=0)) <= 256 and len(set(folds)) <= 100
