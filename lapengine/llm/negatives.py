"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Vectors have whole-number components, a score is the inner product.  With one
more component, sqrt(M - |x|^2) for rows and 0 for queries (M: the largest
squared norm), the squared distance of a query a to a row x is
|a|^2 + M - 2 score: a window of scores is an annulus around the query.

1. ``build``: the tree is fitted on a sample of about ``SAMPLE`` rows on the
   driver; every node has up to ``WAYS`` split points far apart, a row goes to
   the nearest one.  Then every row of the table is dealt to its leaf, and each
   split point gets the range of its distances to the rows of each sibling's
   subtree, from all rows.
2. ``search``: a window's lower end rises to the score of the k-th best sample
   row in it.  A query goes down the tree; a subtree stays if, seen from every
   split point, its range of distances meets the annulus.  What is reached are
   (query, leaf) pairs, one row a query.
3. Leaves are exact: queries and rows of a leaf meet in blocks, ``ROWS`` rows
   by ``QUERIES`` queries at most on average, so a leaf that holds a third of
   all rows is many tasks.  A block gives the k best of each window, the
   smaller id first among ties, and those are merged.
4. ``hard_negatives``: the positives are a search in the open window over rows
   of the same label, the negatives one in the positives' windows over rows of
   other labels.

No score is approximate: the tree only leaves out what cannot be in a window,
and what it keeps is compared exactly, so the result is that of a full scan.

Defined cases: rows with a null id, label or vector, or a component that is
null or not finite, take no part; nor do vectors so long that scores would not
be exact (a squared norm of 2^49 or more in whole numbers).  Vectors of unlike
length count as if the shorter ones had zeros behind.  Rows that are alike in
id, label and vector are one; rows that share an id only are rows of their own,
and neither is "another row" to the other.  Without rows the result is empty.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import written

SAMPLE, WAYS, LEAST_SAMPLE = 8192, 12, 24
LEAF_ROWS, ROWS, QUERIES = 4096, 4096, 16384
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95              # the window: LOW to HIGH hundredths of the positive's score
LIMIT, PLACES = 2.0**49, 13
STEP_ROWS, STEP_QUERIES = 1 << PLACES, 256
NO_KEY = np.iinfo(np.int64).min
OPEN_LOW, OPEN_HIGH = -(1 << 50), 1 << 50                   # beyond any score
_WINDOWS = "array<struct<lo:bigint,hi:bigint>>"


# ------------------------------------------------------------------ the tree

@dataclass
class Node:
    points: np.ndarray                                      # split points, with their further component
    children: list[int]                                     # a node's number, or -1 - a leaf's
    low: np.ndarray = field(default=None)                   # [split point, child]: range of distances to the child's rows
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    nodes: list[Node]                                       # the first one is the root; none: a single leaf
    leaves: int
    top: float                                              # M
    dim: int
    ids: np.ndarray                                         # the sample, to raise windows with
    labels: np.ndarray
    vectors: np.ndarray


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0, top - (x * x).sum(axis=1)))[:, None]], axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(0, square))


def split_points(x: np.ndarray, ways: int, rng: np.random.Generator) -> np.ndarray:
    """Distinct rows far apart: out of some random ones, each time the one whose nearest chosen one is farthest."""
    x = np.unique(x[rng.permutation(len(x))[:4 * ways]], axis=0)
    far, chosen = np.full(len(x), np.inf), []
    for _ in range(min(ways, len(x))):
        k = int(rng.integers(len(x))) if not chosen else int(np.argmax(far))
        chosen.append(k)
        far = np.minimum(far, distances(x, x[k:k + 1])[:, 0])
    return x[chosen]


def fit(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, top: float, rows_per_sample: float, ways: int = WAYS,
        leaf_rows: int = LEAF_ROWS, seed: int = 11) -> Tree:
    """A tree whose leaves hold about ``leaf_rows`` rows, and ``LEAST_SAMPLE`` sample rows or so at least."""
    rng, tree = np.random.default_rng(seed), Tree([], 0, top, vectors.shape[1], ids, labels, vectors)
    own = lifted(vectors, top)

    def grow(rows: np.ndarray) -> int:
        if len(rows) > LEAST_SAMPLE and len(rows) * rows_per_sample > leaf_rows:
            points = split_points(own[rows], ways, rng)
            at = np.argmin(distances(own[rows], points), axis=1)
            if len(points) > 1:
                me = len(tree.nodes)
                tree.nodes.append(Node(points, []))
                tree.nodes[me].children = [grow(rows[at == k]) for k in range(len(points))]
                return me
        tree.leaves += 1
        return -tree.leaves

    grow(np.arange(len(vectors)))
    return tree


def dealt(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]]:
    """Leaf of each row, and (node, child) -> the rows' smallest and largest distance to each split point of the node."""
    leaf, ranges, own = np.zeros(len(x), np.int64), {}, lifted(x, tree.top)
    todo = [(0, np.arange(len(x)))] if tree.nodes else []
    while todo:
        node, rows = todo.pop()
        d = distances(own[rows], tree.nodes[node].points)
        at = np.argmin(d, axis=1)
        for k, child in enumerate(tree.nodes[node].children):
            if (mine := at == k).any():
                ranges[node, k] = d[mine].min(axis=0), d[mine].max(axis=0)
                if child < 0:
                    leaf[rows[mine]] = -1 - child
                else:
                    todo.append((child, rows[mine]))
    return leaf, ranges


def reached(tree: Tree, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, leaf) where a score in one of the query's windows ``low..high`` (queries x windows) is possible."""
    square = (x * x).sum(axis=1)[:, None] + tree.top
    slack = 1e-7 * (1 + np.sqrt(square))
    some = (low <= high) & (square - 2 * low >= -slack)
    near = np.sqrt(np.maximum(0, square - 2 * high)) - slack     # the annulus of each window
    far = np.sqrt(np.maximum(0, square - 2 * low)) + slack
    if not tree.nodes:
        q = np.flatnonzero(some.any(axis=1))
        return q, np.zeros(len(q), np.int64)
    own = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
    out_q, out_leaf, todo = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [(0, np.flatnonzero(some.any(axis=1)))]
    while todo:
        k, q = todo.pop()
        node = tree.nodes[k]
        d = distances(own[q], node.points)
        for j, child in enumerate(node.children):
            lo, hi = node.low[:, j], node.high[:, j]
            least = np.maximum(0, np.maximum(d - hi, lo - d)).max(axis=1)      # no row of the subtree is nearer than this
            most = (d + hi).min(axis=1)
            stay = (some[q] & (least[:, None] <= far[q]) & (most[:, None] >= near[q])).any(axis=1)
            if stay.any():
                if child < 0:
                    out_q.append(q[stay])
                    out_leaf.append(np.full(int(stay.sum()), -1 - child))
                else:
                    todo.append((child, q[stay]))
    return np.concatenate(out_q), np.concatenate(out_leaf)


def best_keys(scores: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest (score, earlier place) of each row as numbers, NO_KEY for none."""
    keys = np.where(ok, (scores << PLACES) + (STEP_ROWS - 1 - np.arange(scores.shape[1])), NO_KEY)
    return np.partition(keys, keys.shape[1] - k, axis=1)[:, -k:] if keys.shape[1] > k else keys


def scan(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q_labels: np.ndarray, q: np.ndarray, low: np.ndarray,
         high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, ...]:
    """Query, window, row and score of the ``k`` best rows in each window, rows of the query's own label or of others; ``ids`` ascend."""
    out = [[np.empty(0, np.int64)] for _ in range(4)]
    for a in range(0, len(q), STEP_QUERIES):
        mine = slice(a, a + STEP_QUERIES)
        for b in range(0, len(x), STEP_ROWS):
            rows = slice(b, b + STEP_ROWS)
            scores = (q[mine] @ x[rows].T).astype(np.int64)     # exact: below 2^49
            ok = ((q_labels[mine, None] == labels[None, rows]) == same) & (q_ids[mine, None] != ids[None, rows])
            for w in range(low.shape[1]):
                keys = best_keys(scores, ok & (scores >= low[mine, w, None]) & (scores <= high[mine, w, None]), k)
                of, at = np.nonzero(keys != NO_KEY)
                key = keys[of, at]
                for o, v in zip(out, (of + a, np.full(len(of), w), (STEP_ROWS - 1 - (key & (STEP_ROWS - 1))) + b, key >> PLACES), strict=True):
                    o.append(v)
    return tuple(np.concatenate(o) for o in out)


# ------------------------------------------------------------------ on Spark

def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, zeros behind shorter ones."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat, size = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64), col.value_lengths().to_numpy(zero_copy_only=False)
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(col), dim))
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def usable(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part, each once; ``q``: floor of ``scale`` times each component."""
    fine = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**25))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    q = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), q.alias("q"))
    norm = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return rows.where(norm < LIMIT).dropDuplicates(["vec_id", "label", "q"])


@dataclass
class Index:
    tree: Tree
    rows: DataFrame                                         # vec_id, label, q, row (hash), leaf
    sizes: dict[int, int]                                   # rows of each leaf


def build(rows: DataFrame, sample: int = SAMPLE, ways: int = WAYS, leaf_rows: int = LEAF_ROWS) -> Index | None:
    """The index of ``usable`` rows, or None without any."""
    spark = rows.sparkSession
    rows = written(rows.withColumn("row", F.xxhash64("vec_id", "label", "q")), "vectors")
    square = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x * x)
    stats = rows.agg(F.count("*").alias("n"), F.max(square).alias("top"), F.max(F.size("q")).alias("dim")).first()
    if not stats.n:
        return None
    share = min(1.0, sample / stats.n)
    # about `sample` rows: the bound on what the tree is fitted on
    got = rows.where(F.pmod("row", F.lit(1 << 30)) < int(share * (1 << 30))).select("row", "vec_id", "label", "q").toArrow().sort_by("row")
    vectors = matrix(got["q"], stats.dim)
    tree = fit(got["vec_id"].to_numpy(), got["label"].to_numpy(), vectors, float(stats.top), stats.n / max(1, len(vectors)), ways, leaf_rows)
    said = spark.sparkContext.broadcast(tree)               # the sample and the split points out of it

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, _ = dealt(said.value, matrix(b.column(2), said.value.dim))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], [*b.schema.names, "leaf"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for at, (lo, hi) in dealt(said.value, matrix(b.column(0), said.value.dim))[1].items():
                had = found.get(at, (lo, hi))
                found[at] = np.minimum(had[0], lo), np.maximum(had[1], hi)
        for (node, child), (lo, hi) in found.items():
            n = len(lo)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, node)), pa.array(np.full(n, child)), pa.array(np.arange(n)), pa.array(lo), pa.array(hi)],
                                             ["node", "child", "point", "lo", "hi"])

    rows = written(rows.mapInArrow(leaves, "vec_id bigint, label bigint, q array<bigint>, row bigint, leaf bigint"), "leaves")
    each = rows.select("q").mapInArrow(ranges, "node bigint, child bigint, point bigint, lo double, hi double")
    for node in tree.nodes:                                 # subtrees without rows are never reached
        node.low, node.high = np.full((len(node.points),) * 2, np.inf), np.full((len(node.points),) * 2, -np.inf)
    # one number for each pair of siblings of the tree
    for r in each.groupBy("node", "child", "point").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        tree.nodes[r.node].low[r.point, r.child], tree.nodes[r.node].high[r.point, r.child] = r.lo, r.hi
    return Index(tree, rows, {r.leaf: r["count"] for r in rows.groupBy("leaf").count().collect()})


def _windows(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends, queries x windows; an empty window where a query has fewer."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size, flat = col.value_lengths().to_numpy(zero_copy_only=False), col.flatten()
    low = np.full((len(col), int(size.max(initial=0))), 1, np.int64)
    high = np.zeros_like(low)
    row = np.repeat(np.arange(len(col)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    low[row, at], high[row, at] = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
    return low, high


def search(index: Index, queries: DataFrame, k: int, same: bool, rows_at_once: int = ROWS, queries_at_once: int = QUERIES) -> DataFrame:
    """``row, w, rank, vec_id, score``: the ``k`` best rows in each window of ``queries(row, vec_id, label, q, windows)``, of the
    query's own label (``same``) or of all others.  ``w`` counts a query's windows from 0, ``rank`` from 1."""
    spark, dim = queries.sparkSession, index.tree.dim
    said = spark.sparkContext.broadcast(index.tree)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = said.value
        order = np.argsort(t.ids, kind="stable")
        for b in batches:
            if not b.num_rows:
                continue
            x, (low, high) = matrix(b.column(3), dim), _windows(b.column(4))
            ids, labels = b.column(1).to_numpy(), b.column(2).to_numpy()
            q, w, _, s = scan(t.ids[order], t.labels[order], t.vectors[order], ids, labels, x, low, high, k, same)
            worst = np.full(low.shape, OPEN_HIGH, np.int64)
            np.minimum.at(worst, (q, w), s)
            count = np.zeros(low.shape, np.int64)
            np.add.at(count, (q, w), 1)
            low = np.where(count >= k, worst, low)          # k rows are known that are as good
            q, leaf = reached(t, x, low.astype(float), high.astype(float))
            order_q = np.lexsort((leaf, q))
            off = np.searchsorted(q[order_q], np.arange(b.num_rows + 1))
            ends = pa.array(np.arange(b.num_rows + 1) * low.shape[1], pa.int32())
            pairs = pa.StructArray.from_arrays([pa.array(low.ravel()), pa.array(high.ravel())], ["lo", "hi"])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.ListArray.from_arrays(ends, pairs), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(leaf[order_q]))],
                                             [*b.schema.names[:4], "windows", "leaves"])

    cols = ["row", "vec_id", "label", "q", "windows"]
    planned = written(queries.select(*cols).mapInArrow(plan, f"row bigint, vec_id bigint, label bigint, q array<bigint>, windows {_WINDOWS}, leaves array<bigint>"), "planned")
    visits = planned.select(*cols, F.explode("leaves").alias("leaf"))
    # a row for each leaf of the tree, whatever the table's size
    asked = {r.leaf: r["count"] for r in visits.groupBy("leaf").count().collect()}
    blocks = spark.createDataFrame([(leaf, -(-index.sizes[leaf] // rows_at_once), -(-n // queries_at_once)) for leaf, n in asked.items()],
                                   "leaf bigint, blocks bigint, asks bigint")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = index.rows.join(F.broadcast(blocks), "leaf").select("leaf", F.pmod("row", "blocks").alias("block"), each("asks").alias("ask"), "vec_id", "label", "q")
    right = visits.join(F.broadcast(blocks), "leaf").select("leaf", each("blocks").alias("block"), F.pmod("row", "asks").alias("ask"), *cols)

    def meet(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not rows.num_rows or not asks.num_rows:
            return schema.empty_table()
        rows = rows.sort_by("vec_id")
        ids, asked = rows["vec_id"].to_numpy(), asks["row"].to_numpy()
        low, high = _windows(asks["windows"])
        q, w, at, s = scan(ids, rows["label"].to_numpy(), matrix(rows["q"], dim), asks["vec_id"].to_numpy(), asks["label"].to_numpy(),
                           matrix(asks["q"], dim), low, high, k, same)
        return pa.table([pa.array(asked[q]), pa.array(w), pa.array(s), pa.array(ids[at]), pa.array(rows["label"].to_numpy()[at])], schema=schema)

    schema = pa.schema([(c, pa.int64()) for c in ("row", "w", "score", "vec_id", "label")])
    key = ["leaf", "block", "ask"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "row bigint, w bigint, score bigint, vec_id bigint, label bigint")
    # k rows a block at most; each task drops what is behind its own k-th before the shuffle
    order = Window.partitionBy("row", "w").orderBy(F.col("score").desc(), "vec_id", "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("row", "w", "rank", "vec_id", "score")


def hard_negatives(rows: DataFrame, anchors: DataFrame | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, index: Index | None = None) -> DataFrame:
    """The first ``negatives`` rows of other labels whose score is from ``low`` to ``high`` hundredths of the positive's, for each of
    the ``positives`` best rows of the anchor's label.  ``rows`` are ``usable`` ones; ``anchors``: a condition on them (all, if None)."""
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    index = index or build(rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], out)
    asks = index.rows if anchors is None else index.rows.where(anchors)
    window = lambda lo, hi: F.struct(lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    everything = F.array(window(F.lit(OPEN_LOW), F.lit(OPEN_HIGH)))
    first = search(index, asks.select("row", "vec_id", "label", "q", everything.alias("windows")), positives, True)
    first = written(first.select("row", F.col("rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # low * s <= 100 * score <= high * s, in whole numbers rounded inwards
    lo = -F.expr(f"({-low} * positive_score - pmod({-low} * positive_score, 100)) div 100")
    hi = F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100")
    windows = F.transform(F.sort_array(F.collect_list(F.struct("rank", window(lo, hi).alias("w")))), lambda x: x["w"])
    of = asks.join(first.groupBy("row").agg(windows.alias("windows")), "row").select("row", "vec_id", "label", "q", "windows")
    second = search(index, of, negatives, False).select("row", (F.col("w") + 1).cast("int").alias("p"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    both = second.join(first.withColumnRenamed("rank", "p"), ["row", "p"]).join(asks.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM fine a JOIN fine b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@register("op11_hard_negatives", SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id", "label", "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)
