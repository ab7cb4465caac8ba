"""Tree regressors grown from histograms over all rows.

The feature matrix is binned once: numeric columns at quantiles of all rows
(one mergeable sketch aggregate), categorical ones as 0/1 columns of their
levels.  The bins are written as blocks of rows and stay with the executors.

A tree grows best leaf first.  One pass over the blocks gives, for every node
that is asked for, the sums of residuals and of rows by feature and bin; the
driver, which sees node x feature x bin sums and never a row, picks the splits.
Which leaf comes next depends on the gains of the children of the one before,
so a pass asks for the children of all leaves that could come next, and what
turns out not to come is cut off again: the tree is the one that growth leaf by
leaf gives, in a tenth of the passes.  Only the smaller child is counted, its
sibling is the difference.

All trees that can grow side by side share the passes: the models of all folds,
several kinds of models, and, in a forest, many trees.  Each row keeps its
prediction for each boosted model.  The first pass of a round adds the trees of
the one before and persists what it has; every ``REFRESH`` rounds it is
checkpointed too, so a lost executor costs the passes since then.  The
passes are RDD jobs over the persisted blocks: they carry state from job to job
and there are thousands of them, which rules out planning a query each time.

What a pass costs is mostly the counting, so a task counts several columns as
one: the bins of a group of columns are one number, kept with the block, and
what is counted by it is summed up to the single columns afterwards.  Nodes of
few rows are counted column by column.

Rows of a DataFrame are counted by classes of our own in the executors' JVMs
(``jvm``): thousands of passes would else send every block to a Python worker
each time.  The trees of a forest's folds draw the same rows; as far as they
agree they are followed as one there, and their rows counted once, by fold.
Blocks that are handed in as Python objects are counted in numpy, to the same
sums.

Residuals are counted in whole units (a power of two, chosen so that the sum
over all rows stays exact), so sums do not depend on the order of rows, tasks or
retries, and neither do trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapengine.operators import jvm

BINS, MAX_LEVELS, REFRESH = 32, 64, 8
FOREST_LEAVES, FOREST_SIDE_BY_SIDE = 128, 60
MANY_BLOCKS, NODES_AT_ONCE, PACK_ROWS = 64, 512, 2048
BLOCK_ROWS, JOINT_CELLS, JOINT_ROWS = 1 << 16, 1024, 600      # rows of a block, cells of a group of columns, rows a node from which groups are counted


@dataclass(frozen=True)
class TreeSettings:
    """``rate`` None: a forest, each tree on bootstrapped rows, predictions averaged.  Otherwise each tree fits the residuals so far."""

    trees: int
    rate: float | None = None
    depth: int | None = None
    leaves: int | None = None
    rows: float = 1.0               # share of rows and of columns that a tree sees
    columns: float = 1.0
    l2: float = 0.0
    least_rows: int = 1
    seed: int = 42


def spread(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform 64-bit numbers from hashes and a salt."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


POISSON = np.cumsum([np.exp(-1)] + [np.exp(-1) / np.prod(np.arange(1, i + 1)) for i in range(1, 9)])


def row_weights(s: TreeSettings, tree: int, hashes: np.ndarray) -> np.ndarray | None:
    """How often each row counts for one tree; None: once each."""
    if s.rate is not None and s.rows >= 1:
        return None
    u = (spread(hashes, s.seed * 1_000_003 + tree) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    if s.rate is not None:
        return (u < s.rows).astype(np.int64)
    out = np.zeros(len(u), np.int8)
    for p in POISSON:
        out += u >= p
    return out.astype(np.int64)


# ------------------------------------------------------------------ the binned matrix

@dataclass
class Binning:
    """Cut points of the numeric columns and levels of the categorical ones."""

    num: list[str]
    cat: list[str]
    edges: list[np.ndarray]
    levels: list[list[str]]

    @property
    def sizes(self) -> np.ndarray:
        """Bins of each feature."""
        return np.array([*[len(e) + 1 for e in self.edges], *[2 for own in self.levels for _ in own]], np.int64)

    @property
    def names(self) -> list[str]:
        return [*self.num, *[f"{c}_{v}" for c, own in zip(self.cat, self.levels, strict=True) for v in own]]

    def columns(self) -> list[Column]:
        """What ``bins`` reads."""
        return [*[F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(self.num)], *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(self.cat)]]

    def bins(self, cols: list[pa.Array]) -> np.ndarray:
        """Features x rows.  A value goes left of a cut if it is at most the cut; a null number stands in the first bin."""
        out = [np.searchsorted(e, c.fill_null(-np.inf).to_numpy(zero_copy_only=False), "left") for e, c in zip(self.edges, cols, strict=False)]
        for own, c in zip(self.levels, cols[len(self.num):], strict=True):
            said, number = c.dictionary_encode(), {v: i for i, v in enumerate(own)}
            level = np.array([*[number.get(x, -1) for x in said.dictionary.to_pylist()], -1], np.int64)     # the last one is null's
            code = level[said.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
            out += [code == i for i in range(len(own))]
        return np.stack(out).astype(np.uint8)


def find_bins(df: DataFrame, num: list[str], cat: list[str], bins: int = BINS) -> Binning:
    """Quantile cuts from one aggregate; of a categorical column the ``MAX_LEVELS`` commonest levels, in order."""
    edges: list[np.ndarray] = []
    if num:
        at = [i / bins for i in range(1, bins)]
        cuts = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 100 * bins).alias(f"e{i}") for i, c in enumerate(num)]).first()
        edges = [np.unique(np.array([x for x in cuts[f"e{i}"] or [] if np.isfinite(x)], float)) for i in range(len(num))]
    levels = [sorted(r.v for r in df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
                     .orderBy(F.col("count").desc(), "v").limit(MAX_LEVELS).collect()) for c in cat]
    return Binning(list(num), list(cat), edges, levels)


@dataclass
class Block:
    """Some rows: their bins (features x rows), fold, target, hash, for each boosted model the prediction so far, and the bins of groups of columns."""

    bins: np.ndarray
    fold: np.ndarray
    y: np.ndarray
    hashes: np.ndarray
    said: np.ndarray
    joint: np.ndarray | None = None


def blocks_of(df: DataFrame, binning: Binning, key: str, path: str) -> RDD:
    """The matrix of ``df`` (with ``label`` and ``fold``), written to ``path`` and read back as blocks."""
    b = binning

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PACK_ROWS):          # pages and records of MBs would be copied by several buffers at once
                some = batch.slice(at, PACK_ROWS)
                cols = some.columns
                parts = [cols[0].to_numpy().astype(np.int32), cols[1].to_numpy().astype(np.float64), cols[2].to_numpy().astype(np.int64),
                         b.bins(cols[3:])]
                yield pa.RecordBatch.from_arrays([pa.array([some.num_rows], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], ["n", "fold", "y", "h", "bins"])

    rows = df.select(F.col("fold"), F.col("label"), F.xxhash64(key).alias("_h"), *b.columns())
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:                     # a table of a few files: else most cores would idle
        rows = rows.repartition(cores)
    rows.mapInArrow(pack, "n bigint, fold binary, y binary, h binary, bins binary").write.parquet(path)

    def unpack(r) -> Block:
        return Block(np.frombuffer(r.bins, np.uint8).reshape(-1, r.n), np.frombuffer(r.fold, np.int32), np.frombuffer(r.y, np.float64),
                     np.frombuffer(r.h, np.int64).view(np.uint64), np.zeros((0, r.n)))
    back = df.sparkSession.read.parquet(path)
    # dealt out: a file that is cut into many partitions but has one row group gives all its blocks to one of them
    blocks = back.repartition(max(cores, back.rdd.getNumPartitions())).rdd.map(unpack)
    blocks.frame = back                                         # ``fit`` packs its own blocks of these rows
    return blocks


def column_groups(sizes: np.ndarray, most: int = JOINT_CELLS) -> list[list[int]]:
    """The columns in groups of at most ``most`` cells, the widest columns first."""
    groups: list[list[int]] = []
    cells: list[int] = []
    for f in np.argsort(-sizes, kind="stable").tolist():
        at = next((i for i, c in enumerate(cells) if c * sizes[f] <= most), None)
        if at is None:
            groups.append([])
            cells.append(1)
            at = -1
        groups[at].append(f)
        cells[at] *= int(sizes[f])
    return groups


def prepared(it: Iterator[Block], sizes: np.ndarray, boosted: int) -> Iterator[Block]:
    """The blocks of a task in blocks of ``BLOCK_ROWS`` rows and more, with what the passes need."""
    groups = column_groups(sizes)

    def whole(some: list[Block]) -> Block:
        bins = np.concatenate([b.bins for b in some], axis=1)
        joint = np.zeros((len(groups), bins.shape[1]), np.uint16)
        for code, own in zip(joint, groups, strict=True):
            for f in own:
                code *= np.uint16(sizes[f])
                code += bins[f]
        fold, y, hashes = (np.concatenate([getattr(b, c) for b in some]) for c in ("fold", "y", "hashes"))
        return Block(bins, fold, y, hashes, np.zeros((boosted, len(y))), joint)

    some: list[Block] = []
    for b in it:
        some.append(b)
        if sum(len(x.y) for x in some) >= BLOCK_ROWS:
            yield whole(some)
            some = []
    if some:
        yield whole(some)


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """Node arrays; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray                 # goes left if the bin is at most this
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        n = bins.shape[1]
        node, at, flat = np.zeros(n, np.int64), np.arange(n), bins.ravel()
        row, kids = self.feature.astype(np.int64) * n, np.stack([self.left, self.right], axis=1).ravel().astype(np.int64)
        for _ in range(self.depth):
            node = kids.take(2 * node + (flat.take(row.take(node) + at) > self.cut.take(node)))
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(bins)] if self.depth else np.full(bins.shape[1], self.value[0])

    def rows_of(self, nodes: list[int], bins: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Those of ``rows`` that come to each of ``nodes``, in order; other branches are not followed."""
        wanted = np.zeros(len(self.left), bool)
        wanted[nodes] = True
        for v in range(len(wanted) - 1, -1, -1):                # children stand behind their parents
            wanted[v] |= wanted[self.left[v]] | wanted[self.right[v]]
        at: list[np.ndarray | None] = [None] * len(wanted)
        at[0] = rows
        for v in np.flatnonzero(wanted).tolist():
            a, b = self.left[v], self.right[v]
            if a != v and (wanted[a] or wanted[b]):
                go = bins[self.feature[v]].take(at[v]) <= self.cut[v]
                if wanted[a]:
                    at[a] = at[v].compress(go)
                if wanted[b]:
                    at[b] = at[v].compress(~go)
        return [at[v] for v in nodes]

    def add_to(self, said: np.ndarray, bins: np.ndarray) -> None:
        """Adds the predictions of many rows in place, leaf by leaf."""
        leaves = np.flatnonzero(self.left == np.arange(len(self.left))).tolist()
        for v, rows in zip(leaves, self.rows_of(leaves, bins, np.arange(bins.shape[1])), strict=True):
            said[rows] += self.value[v]


@dataclass
class Ensemble:
    """A fitted model over binned rows."""

    settings: TreeSettings
    start: float
    trees: list[Tree] = field(default_factory=list)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros(bins.shape[1])
        for t in self.trees:
            total += t.predict(bins)
        return self.start + (total / max(1, len(self.trees)) if self.settings.rate is None else total)


class Growing:
    """One tree that grows: what is known of its nodes, which ones have to be counted next."""

    def __init__(self, s: TreeSettings, features: int, tree: int) -> None:
        self.s = s
        self.feature, self.cut, self.left, self.right, self.depth, self.up = [0], [0], [0], [0], [0], [-1]
        self.sums: list[tuple[float, float] | None] = [None]        # residuals and rows
        self.best: list[tuple | None] = [None]                      # of the best split; None: not counted yet
        self.counts: dict[int, np.ndarray] = {}                     # cell x (residuals, rows), until the children have theirs
        self.asked, self.order = [0], []
        self.used = np.zeros(features, bool)                        # the columns that this tree sees
        self.used[np.random.default_rng([s.seed, tree]).permutation(features)[:max(1, round(s.columns * features))]] = True

    def split(self, v: int) -> None:
        """Gives ``v`` its two children."""
        _, f, cut, g, n = self.best[v]
        total = self.sums[v]
        self.feature[v], self.cut[v], self.left[v], self.right[v] = f, cut, len(self.cut), len(self.cut) + 1
        for own in ((g, n), (total[0] - g, total[1] - n)):
            me = len(self.cut)
            for x, y in ((self.feature, 0), (self.cut, 0), (self.left, me), (self.right, me), (self.depth, self.depth[v] + 1), (self.up, v),
                         (self.sums, own), (self.best, None)):
                x.append(y)

    def choose(self) -> None:
        """Grows best leaf first over what is known and notes which of the nodes that come up have to be counted."""
        budget = (self.s.leaves or 1 << 30) - 1
        heap, self.order, unknown = [], [], []

        def push(v: int) -> None:
            if self.s.depth is not None and self.depth[v] >= self.s.depth:
                return
            if self.best[v] is None:
                unknown.append(v)
            elif self.best[v][0] > 0:
                heapq.heappush(heap, (-self.best[v][0], v))
        push(0)
        while heap and len(self.order) < budget:
            v = heapq.heappop(heap)[1]
            if self.left[v] == v:
                self.split(v)
            self.order.append(v)
            if len(self.order) < budget:
                push(self.left[v])
                push(self.right[v])
        # of two siblings the smaller one is counted; they come up together
        self.asked = [v for v in unknown if (self.sums[v][1], v) < (self.sums[self.sibling(v)][1], self.sibling(v))]

    def sibling(self, v: int) -> int:
        up = self.up[v]
        return self.left[up] + self.right[up] - v

    def counted(self, v: int, own: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """What the counts of ``v`` give: its own and, by difference, its sibling's."""
        if v == 0:
            f = np.flatnonzero(self.used)[0]
            self.sums[0] = tuple(own[off[f]:off[f + 1]].sum(axis=0).tolist())
            self.counts[0] = own
            yield 0, own
        else:
            w = self.sibling(v)
            self.counts[v], self.counts[w] = own, self.counts.pop(self.up[v]) - own
            yield v, own
            yield w, self.counts[w]

    def done(self, unit: float) -> Tree:
        """The tree without what growth leaf by leaf would not have reached."""
        number, todo = {}, [0]
        chosen = set(self.order)
        while todo:
            v = todo.pop(0)
            number[v] = len(number)
            if v in chosen:
                todo += [self.left[v], self.right[v]]
        rows = sorted(number, key=number.get)
        kids = [(number[self.left[v]], number[self.right[v]]) if v in chosen else (number[v],) * 2 for v in rows]
        rate = 1.0 if self.s.rate is None else self.s.rate
        value = [rate * self.sums[v][0] * unit / (self.sums[v][1] + self.s.l2) if self.sums[v][1] + self.s.l2 > 0 else 0.0 for v in rows]
        return Tree(np.array([self.feature[v] for v in rows], np.int32), np.array([self.cut[v] if v in chosen else 255 for v in rows], np.uint8),
                    np.array([a for a, _ in kids], np.int32), np.array([b for _, b in kids], np.int32), np.array(value), max(self.depth[v] for v in rows))

    def partial(self) -> Tree:
        """The nodes so far, to find the rows of those that are asked for."""
        return Tree(np.array(self.feature, np.int32), np.array(self.cut, np.uint8), np.array(self.left, np.int32), np.array(self.right, np.int32),
                    np.empty(0), max(self.depth))


def best_splits(counts: np.ndarray, off: np.ndarray, total: np.ndarray, l2: np.ndarray, least: np.ndarray, used: np.ndarray) -> list[tuple]:
    """(gain, feature, cut, residuals and rows on the left) of each node; of equal gains the first.

    ``counts``: node x cell x (residuals, rows), where the bins of feature f are the cells ``off[f]:off[f + 1]``; ``total``: a
    node's sums; ``used``: node x feature.
    """
    of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    sums = np.cumsum(counts, axis=1)
    before = np.concatenate([np.zeros((len(counts), 1, 2)), sums], axis=1)[:, off[:-1]]
    g, n = np.moveaxis(sums - before[:, of], -1, 0)
    all_g, all_n, l2, floor = (x[:, None] for x in (total[:, 0], total[:, 1], l2, np.maximum(1, least)))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (n + l2) + (all_g - g) ** 2 / (all_n - n + l2) - all_g**2 / (all_n + l2)
    gain[(n < floor) | (all_n - n < floor) | ~used[:, of]] = -1
    at, i = np.argmax(gain, axis=1), np.arange(len(counts))
    most = gain[i, at]
    noise = 1e-12 * total[:, 0] ** 2 / np.maximum(1, total[:, 1])      # what is lost in rounding is no gain
    return list(zip(np.where(most > noise, most, 0.0).tolist(), of[at].tolist(), (at - off[of[at]]).tolist(), g[i, at].tolist(), n[i, at].tolist(), strict=True))


# ------------------------------------------------------------------ passes

@dataclass
class Model:
    """One ensemble that is fitted on the rows of all folds but ``fold``."""

    ensemble: Ensemble
    fold: int
    unit: float
    anchor: float                       # residuals are counted from here: all models of a forest share them
    slot: int | None = None             # of a boosted model's predictions in a block
    done: bool = False

    @property
    def shift(self) -> float:
        """Units from the anchor to the start."""
        return float(np.rint((self.ensemble.start - self.anchor) / self.unit))


def count_block(b: Block, asks: list[tuple], off: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Sums of residuals and rows of every node asked for: node x cell x 2."""
    sizes, at, residuals, weights = np.diff(off), 0, {}, {}
    out = np.zeros((sum(len(nodes) for *_, nodes in asks), int(off[-1]), 2))
    for m, slot, fold, start, unit, s, number, tree, used, nodes in asks:
        if slot is None and m not in residuals:                 # a forest's trees share them
            residuals[m] = np.rint((b.y - start) / unit)
        draw = (s.seed, number, s.rate is None, s.rows)         # the models of all folds draw the same rows
        if draw not in weights:
            weights[draw] = row_weights(s, number, b.hashes)
        weight = weights[draw]
        own = np.flatnonzero(b.fold != fold if weight is None else (b.fold != fold) & (weight > 0))
        parts = tree.rows_of(nodes, b.bins, own)
        rows, k = np.concatenate(parts) if len(parts) > 1 else parts[0], len(nodes)
        place = np.repeat(np.arange(k), [len(p) for p in parts]) if k > 1 else None
        # a boosted model's rows count once each or not at all
        w = weight.take(rows).astype(float) if slot is None and weight is not None else None
        if slot is None:
            r = residuals[m].take(rows) if w is None else residuals[m].take(rows) * w
        else:
            r = np.rint((b.y.take(rows) - start - b.said[slot].take(rows)) / unit)
        jointly = len(rows) >= JOINT_ROWS * k
        for i, group in enumerate(groups if jointly else [[f] for f in np.flatnonzero(used).tolist()]):
            wide = sizes[group]
            cells = int(wide.prod())
            code = (b.joint[i] if jointly else b.bins[group[0]]).take(rows).astype(np.intp)
            if place is not None:
                code += place * cells
            for j, x in enumerate((r, w)):
                sums = np.bincount(code, x, k * cells).reshape(k, *wide)
                for axis, f in enumerate(group):
                    if used[f]:
                        out[at:at + k, off[f]:off[f + 1], j] = sums.sum(axis=tuple(a + 1 for a in range(len(group)) if a != axis)) if len(group) > 1 else sums
        at += k
    return out


def count_part(asks: list[tuple], off: np.ndarray, groups: list[list[int]], it: Iterator[Block]) -> Iterator[np.ndarray]:
    total = None
    for b in it:
        own = count_block(b, asks, off, groups)
        total = own if total is None else total + own
    if total is not None:
        yield total


def count(blocks: RDD, asks: list[tuple], off: np.ndarray) -> np.ndarray:
    # functions of this module are sent by name: there are thousands of passes, and packing a closure's code takes longer than its data
    parts = blocks.mapPartitions(partial(count_part, asks, off, column_groups(np.diff(off))))
    if blocks.getNumPartitions() > MANY_BLOCKS:
        return parts.treeReduce(np.add, depth=2)
    return sum(parts.collect())


def with_trees(fresh: list[Tree | None], it: Iterator[Block]) -> Iterator[Block]:
    for b in it:
        said = b.said.copy()
        for own, t in zip(said, fresh, strict=True):
            if t is not None:
                t.add_to(own, b.bins)
        yield Block(b.bins, b.fold, b.y, b.hashes, said, b.joint)


def refreshed(blocks: RDD, fresh: list[Tree | None], checkpoint: bool) -> RDD:
    """The blocks with a new tree of each boosted model in their predictions; the pass that reads them first persists them."""
    out = blocks.mapPartitions(partial(with_trees, fresh)).persist(StorageLevel.MEMORY_AND_DISK)
    if checkpoint:
        out.checkpoint()
    return out


class Passes:
    """``fit``'s passes over an RDD of blocks in Python; ``jvm.Matrix`` has them for rows of a DataFrame."""

    def __init__(self, blocks: RDD, sizes: np.ndarray, boosted: int) -> None:
        self.off, self.raw, self.behind = np.concatenate([[0], np.cumsum(sizes)]), blocks, None
        self.blocks = blocks.mapPartitions(lambda it: prepared(it, sizes, boosted)).persist(StorageLevel.MEMORY_AND_DISK)

    def stats(self) -> dict[int, list[tuple]]:
        def of(b: Block) -> list[tuple]:
            return [(f, len(y), float(y.sum()), float(y.min()), float(y.max())) for f in np.unique(b.fold).tolist() for y in [b.y[b.fold == f]]]

        folds: dict[int, list] = {}
        for f, *own in self.raw.flatMap(of).collect():          # a row for each fold of a block
            folds.setdefault(f, []).append(tuple(own))
        return folds

    def count(self, asks: list[tuple]) -> np.ndarray:
        out = count(self.blocks, asks, self.off)
        if self.behind is not None:
            self.behind.unpersist()
            self.behind = None
        return out

    def add(self, fresh: list[Tree | None], checkpoint: bool) -> None:
        self.behind, self.blocks = self.blocks, refreshed(self.blocks, fresh, checkpoint)

    def close(self) -> None:
        self.blocks.unpersist()


def fit(blocks: RDD, sizes: np.ndarray, wanted: list[tuple[TreeSettings, int]], side_by_side: int = FOREST_SIDE_BY_SIDE) -> list[Ensemble]:
    """An ensemble for each (settings, fold), fitted on the rows of the other folds (fold -1: all rows); ``sizes``: bins of each feature."""
    off, frame = np.concatenate([[0], np.cumsum(sizes)]), getattr(blocks, "frame", None)
    boosted = sum(s.rate is not None for s, _ in wanted)
    if jvm.supported(frame, sizes, [f for _, f in wanted]):
        passes = jvm.Matrix(frame, sizes, [f for _, f in wanted], boosted, column_groups(sizes, jvm.GROUP_CELLS), POISSON)
    else:
        passes = Passes(blocks, sizes, boosted)
    folds = passes.stats()
    features = len(sizes)
    own = sorted(x for rows in folds.values() for x in rows)
    total = sum(x[0] for x in own)
    anchor = sum(x[1] for x in own) / total if total else 0.0
    models = []
    for s, fold in wanted:
        rows = sorted(x for f, xs in folds.items() if f != fold for x in xs)
        n = sum(x[0] for x in rows)
        start = sum(x[1] for x in rows) / n if n else 0.0
        own_anchor = start if s.rate is not None else anchor
        widest = 4 * max([abs(x[i] - own_anchor) for x in own for i in (2, 3)], default=0.0) * max(1, total)
        unit = 2.0 ** np.ceil(np.log2(widest / 2.0**52)) if widest else 1.0
        # without rows or columns to learn from the model is its start
        models.append(Model(Ensemble(s, start), fold, unit, own_anchor, done=not n or not features))
    for i, m in enumerate(m for m in models if m.ensemble.settings.rate is not None):
        m.slot = i
    growing: list[tuple[int, int, Growing]] = []                # model, number of the tree
    begun, grown = [0] * len(models), [{} for _ in models]
    fresh: list[Tree | None] = [None] * boosted                 # not in the rows' predictions yet
    rounds = 0

    def begin() -> bool:
        """Starts trees of forests, as many as grow side by side, and, when all boosted models have theirs, the next tree of each; whether it did."""
        again = not any(models[m].slot is not None for m, _, _ in growing)

        def start(m: int) -> None:
            growing.append((m, begun[m], Growing(models[m].ensemble.settings, features, begun[m])))
            begun[m] += 1

        able = [m for m, x in enumerate(models) if not x.done and (again or x.slot is None)]
        able = [m for m in able if begun[m] < models[m].ensemble.settings.trees]
        for m in able:
            if models[m].slot is not None:
                start(m)
        forests = [m for m in able if models[m].slot is None]
        while forests:                                          # the same tree of all folds side by side: they draw the same rows
            least = min(begun[m] for m in forests)
            some = [m for m in forests if begun[m] == least]
            if len(growing) + len(some) > max(side_by_side, len(some)):
                break
            for m in some:
                start(m)
            forests = [m for m in forests if begun[m] < models[m].ensemble.settings.trees]
        return again

    begin()
    while growing:
        asks = [(m, models[m].slot, models[m].fold, models[m].anchor, models[m].unit, g.s, t, g.partial(), g.used, list(g.asked)) for m, t, g in growing]
        counts, at = passes.count(asks), 0
        known: list[tuple[Growing, int, np.ndarray]] = []
        for m, _, g in growing:
            for v in g.asked:
                counts[at, :, 0] -= models[m].shift * counts[at, :, 1]
                known += [(g, w, own) for w, own in g.counted(v, counts[at].copy(), off)]     # a view would keep those of all nodes
                at += 1
        for i in range(0, len(known), NODES_AT_ONCE):
            some = known[i:i + NODES_AT_ONCE]
            l2, least = (np.array([getattr(g.s, c) for g, _, _ in some], float) for c in ("l2", "least_rows"))
            total, used = np.array([g.sums[v] for g, v, _ in some]), np.array([g.used for g, _, _ in some])
            for (g, v, _), best in zip(some, best_splits(np.stack([own for *_, own in some]), off, total, l2, least, used), strict=True):
                g.best[v] = best
        still = []
        for m, t, g in growing:
            g.choose()
            if g.asked:
                still.append((m, t, g))
                continue
            tree = g.done(models[m].unit)
            grown[m][t] = tree
            if models[m].slot is not None:
                fresh[models[m].slot] = tree
        growing[:] = still
        if begin() and growing and any(t is not None for t in fresh):
            rounds += 1
            passes.add(fresh, rounds % REFRESH == 0)
            fresh = [None] * boosted
    passes.close()
    for m, trees in zip(models, grown, strict=True):            # a forest's trees end in any order
        m.ensemble.trees = [trees[t] for t in sorted(trees)]
    return [m.ensemble for m in models]


# ------------------------------------------------------------------ columns

def predicted(df: DataFrame, binning: Binning, models: dict[int, Ensemble], fold: Column) -> Column:
    """Prediction of each row by the model of its fold.  ``models`` is bounded by the settings: trees x leaves."""
    said = df.sparkSession.sparkContext.broadcast((binning, models))

    def of(fold: pa.Array, cols: pa.Array) -> pa.Array:
        b, by_fold = said.value
        cols = cols.combine_chunks() if isinstance(cols, pa.ChunkedArray) else cols
        fold, bins = fold.to_numpy(zero_copy_only=False), b.bins(cols.flatten())
        out = np.zeros(len(fold))
        for f in np.unique(fold).tolist():
            own = np.flatnonzero(fold == f)
            out[own] = by_fold[f].predict(bins[:, own])
        return pa.array(out)
    return F.arrow_udf(of, "double")(fold, F.struct(*binning.columns()))


def scored(frame: DataFrame, sizes: np.ndarray, models: dict[int, Ensemble]) -> DataFrame:
    """``fold, y_true, y_pred`` of the rows that ``blocks_of`` wrote, by the model of each row's fold: what metrics need."""
    return jvm.scored(frame, sizes, column_groups(sizes, jvm.GROUP_CELLS), models)


def importances(ensemble: Ensemble, names: list[str]) -> dict[str, int]:
    """How often each feature splits."""
    out = dict.fromkeys(names, 0)
    for t in ensemble.trees:
        for f in t.feature[t.left != np.arange(len(t.left))].tolist():
            out[names[f]] += 1
    return out

