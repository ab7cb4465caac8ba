"""SimHash near-duplicates by pivot distance tables.

1. ``fingerprint``: each text's 64-bit SimHash over word shingles.
2. Equal fingerprints collapse to one row, so groups of copies cost nothing more.
3. Two fingerprints at most ``max_bits`` apart agree on at least
   ``blocks - max_bits`` of ``blocks`` blocks of bits, so every pair of that
   kind meets in a bucket of one block combination.  The number of blocks
   follows the number of fingerprints; any number finds the same pairs.
4. In a bucket a table of Hamming distances to ``PIVOTS`` reference
   fingerprints is computed once.  By the triangle inequality a pair whose
   largest coordinate difference exceeds ``max_bits`` cannot link and is
   discarded; the survivors' distance is computed exactly.  A bucket gives
   the links of a spanning forest of its own, never all its pairs.
5. Links join to components by contraction.

Defined cases: a null text has no word, so its fingerprint is zero, linked like
any other.  A null doc_id is never the smallest; a component of null ids has a
null component_id.  Repeated rows are one fingerprint and each get their row.
Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.components import components
from lapengine.llm.registry import register, table
from lapengine.llm.storage import written
from lapengine.llm.textarrays import row_bytes

SHINGLE, MAX_BITS = 4, 4
PIVOTS = np.random.Generator(np.random.PCG64(64)).integers(0, 2**64, 32, dtype=np.uint64)
SMALL_BUCKET = 16
STEP = 1 << 17


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text: A-Z lower-cased, a bit is set if it is in over half of the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    starts, ends, digest = starts[:n], ends[k - 1:], xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, STEP):
        said = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[lo:lo + STEP].tolist(), ends[lo:lo + STEP].tolist(), strict=True)])
        ones += np.unpackbits(np.frombuffer(said, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Column of signed 64-bit fingerprints."""
    def of(col: pa.Array) -> pa.Array:
        data, off = row_bytes(col)
        out = np.fromiter((simhash(data[a:b].tobytes(), shingle) for a, b in zip(off[:-1], off[1:], strict=True)),
                          np.uint64, len(off) - 1)
        return pa.array(out.view(np.int64))
    return F.arrow_udf(of, "bigint")(text)


def block_count(n: int, max_bits: int, expected: int = 4) -> int:
    """Fewest blocks for which ``n`` random fingerprints share a bucket with ``expected`` others or less."""
    for blocks in range(max_bits + 1, 2 * max_bits + 5):
        if n <= expected * 2 ** (64 * (blocks - max_bits) // blocks):
            return blocks
    return 2 * max_bits + 4


def bucket_keys(fp: Column, max_bits: int, blocks: int) -> Column:
    """Array of one key for each choice of ``blocks - max_bits`` blocks: the bits there and the choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    signed = lambda m: m - 2**64 if m >= 2**63 else m
    return F.array(*[F.xxhash64(F.lit(t), fp.bitwiseAND(F.lit(signed(sum(c))).cast("bigint")))
                     for t, c in enumerate(combinations(masks, blocks - max_bits))])


def _close(fps: np.ndarray, table_: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs link: first the pivot coordinates, then the distance itself."""
    ok = np.ones(len(i), bool)
    for d in table_:                                            # one pivot's distances after another
        live = np.flatnonzero(ok)
        if not len(live):
            return ok
        ok[live] = np.abs(d[i[live]] - d[j[live]]) <= max_bits
    live = np.flatnonzero(ok)
    ok[live] = np.bitwise_count(fps[i[live]] ^ fps[j[live]]) <= max_bits
    return ok


def _forest(pairs: np.ndarray) -> np.ndarray:
    """The pairs that join two trees, in order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    keep = np.zeros(len(pairs), bool)
    for k, (a, b) in enumerate(pairs.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra], keep[k] = rb, True
    return pairs[keep]


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (pairs of row numbers) that connect what links in each bucket of the sorted ``keys``."""
    table_ = np.bitwise_count(fps[None, :] ^ PIVOTS[:, None]).astype(np.int16)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    out = [np.empty((0, 2), np.int64)]
    small = np.repeat(size <= SMALL_BUCKET, size)
    pairs = []
    for step in range(1, SMALL_BUCKET):                         # row i with row i + step of the same small bucket
        i = np.flatnonzero(small[:-step] & (keys[:-step] == keys[step:])) if step < len(keys) else np.empty(0, np.int64)
        if not len(i):
            break
        i = i[_close(fps, table_, i, i + step, max_bits)]
        pairs.append(np.stack([i, i + step], axis=1))
    if pairs:
        out.append(_forest(np.concatenate(pairs)))
    for k in np.flatnonzero(size > SMALL_BUCKET):               # breadth first: what is reached is compared no more
        rest = np.arange(first[k], first[k] + size[k])
        front: list[int] = []
        while len(rest):
            if not front:
                front, rest = [int(rest[0])], rest[1:]
                continue
            x = front.pop()
            near = _close(fps, table_, np.full(len(rest), x), rest, max_bits)
            if near.any():
                hit = rest[near]
                out.append(np.stack([np.full(len(hit), x), hit], axis=1))
                front += hit.tolist()
                rest = rest[~near]
    return np.concatenate(out)


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """``a, b``: links that connect all distinct ``fp`` at most ``max_bits`` apart."""
    blocks = blocks or block_count(fps.count(), max_bits)
    rows = fps.select("fp", F.explode(bucket_keys(F.col("fp"), max_bits, blocks)).alias("key"))

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole buckets at a time; the last bucket of a batch waits for the next batch."""
        def found(keys: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
            got = own.view(np.int64)[bucket_links(keys, own, max_bits)].reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(got.min(axis=1)), pa.array(got.max(axis=1))], ["a", "b"])

        keep_k, keep_f = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for batch in batches:
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))                # first row of the last bucket
            if cut or keep_k[-1].size and keep_k[-1][-1] != k[0]:
                yield found(np.concatenate([*keep_k, k[:cut]]), np.concatenate([*keep_f, f[:cut]]))
                keep_k, keep_f = [], []
            keep_k.append(k[cut:])
            keep_f.append(f[cut:])
        if keep_k[-1].size:
            yield found(np.concatenate(keep_k), np.concatenate(keep_f))

    return (rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
            .mapInArrow(of_partition, "a bigint, b bigint").distinct())


def near_duplicates(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id, keeper_fp`` for each distinct fingerprint of ``rows(doc_id, fp)``.

    ``component_id`` is the component's smallest doc_id, ``keeper_fp`` the
    smallest fingerprint of the rows with that id.
    """
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    roots = components(links(fps.select("fp"), max_bits))
    if roots is None:
        of = fps.withColumn("root", F.col("fp"))
    else:
        of = fps.join(roots.toDF("fp", "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = of.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("m"))
    best = best.select("root", F.col("m.least").alias("component_id"), F.col("m.fp").alias("keeper_fp"))
    return of.select("fp", "root").join(best, "root").select("fp", "root", "component_id", "keeper_fp")


@register("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = written(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "docfps")
    of = near_duplicates(rows).select("fp", "component_id")
    return rows.join(of, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
