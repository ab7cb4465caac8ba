"""Spelling variants: words that differ by one code point, grouped under the far commoner form.

1. ``vocabulary``: words of all texts, counted.  Each batch hands on its own
   sums, so a frequent word is a row a batch, not a row an occurrence.
2. ``near_words``: search schemes over bidirectional FM-indexes.  Two words
   one edit apart share the first half of the one or else its second half.  So
   the vocabulary is dealt once by its first and once by its last three code
   points (both halves of a word of six have as many), and each share, its
   words delimited, gets an index of its own.  A word is searched in both its
   shares: one half is matched exactly from the middle outwards up to the
   delimiter, then the interval pair is extended the other way over the other
   half with one replaced, added or left out code point.  A hit of the second
   scheme that has the whole first half too is the first one's and is dropped,
   so the two give each pair once.
3. ``variants``: number of near words, the commonest of them as the form, and
   the root at the end of the chain of forms, by pointer doubling.

The index holds the sorted rotations of ``$word$word...`` and of its mirror
image, each as a wavelet matrix of the symbols before the rotations.  A pattern
is an interval in both; extending it to one side counts in that side's matrix
and moves the other interval by the number of smaller symbols.

Shares hold ``BLOCK`` code points on average.  A key (three code points) that
has more is cut into blocks by hash, and each block of its words is searched in
each of its blocks, so no task holds more than two blocks whatever the key.

Defined cases: a null or empty text has no word; a null doc_id is written as
nothing before the colon.  Repeated rows count each.  Ties between forms go to
the smaller word in code-point order.  Without words the result is empty.  Other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import written
from lapengine.llm.textarrays import row_bytes

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, SLIP = 6, 5, 5, 199
KEY, BLOCK, QUERIES_AT_ONCE, KEPT = 3, 1 << 18, 4096, 1 << 18
_PACK = 8


# ------------------------------------------------------------------ vocabulary

def slipped(run: str, doc: int, slip: int) -> str:
    """``run``, without one code point if its hash with the document's (``doc``: CRC-32 of the id and a colon) is a multiple of ``slip``."""
    h = zlib.crc32(run.encode(), doc)
    if h % slip:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``word, n`` of the runs of letters in whole texts, A-Z lower-cased."""
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")          # shorter runs can't become words

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def said() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            data, off = row_bytes(batch.column(1))
            for doc, a, b in zip(batch.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, k in Counter(runs.findall(data[a:b].tobytes().lower().decode())).items():     # bytes: only A-Z
                    total[slipped(run, start, slip)] += k
                if len(total) > KEPT:
                    yield said()
        yield said()

    rows = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text")).mapInArrow(of, "word string, n bigint")
    return rows.where(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ index

def rotations(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the sorted rotations, by prefix doubling from ``_PACK`` symbols on."""
    n = len(codes)
    bits = max(1, (symbols - 1).bit_length())
    width = min(_PACK, 62 // bits)
    rank, at = np.zeros(n, np.int64), np.arange(n)
    for k in range(width):
        rank = (rank << bits) | codes[(at + k) % n]
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.concatenate([[0], np.cumsum(rank[order[1:]] != rank[order[:-1]])])
        if new[-1] == n - 1:
            return order
        rank[order] = new
        rank = rank * n + rank[(at + width) % n]
        width *= 2


class Wavelet:
    """Rank and range queries over one sequence of symbols."""

    def __init__(self, seq: np.ndarray, symbols: int) -> None:
        self.zeros, self.n = [], len(seq)
        for level in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            one = (seq >> level) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            seq = np.concatenate([seq[~one], seq[one]])
        none = np.zeros(symbols, np.int64)
        self.first = self.range(np.arange(symbols), none, none)[0]       # where each symbol begins in the last level

    def range(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the symbols ``c`` of ``lo:hi`` stand in the last level, and how many smaller ones there are."""
        less = np.zeros(len(c), np.int64)
        for k, zeros in enumerate(self.zeros):
            one = (c >> (len(self.zeros) - 1 - k)) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            less += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return lo, hi, less

    def each(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each symbol of each range: number of the range, symbol, start and end in the last level."""
        of, c = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for zeros in self.zeros:
            a, b = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            of, c = np.concatenate([of, of]), np.concatenate([c << 1, c << 1 | 1])
            lo, hi = np.concatenate([a, zeros[-1] + lo - a]), np.concatenate([b, zeros[-1] + hi - b])
            some = np.flatnonzero(hi > lo)
            of, c, lo, hi = of[some], c[some], lo[some], hi[some]
        return of, c, lo, hi


@dataclass
class Intervals:
    """Patterns as intervals of the text's rotations (0) and of its mirror image's (1)."""

    lo: list[np.ndarray]
    size: np.ndarray

    def take(self, which: np.ndarray) -> Intervals:
        return Intervals([x[which] for x in self.lo], self.size[which])


class FmIndex:
    """Bidirectional index of distinct words; symbol 0 is the delimiter before each word."""

    def __init__(self, words: list[str]) -> None:
        points = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)                       # the delimiter is the smallest
        codes = np.searchsorted(self.alphabet, points)
        self.n, self.symbols = len(codes), len(self.alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=self.symbols))])[:-1]
        self.words, self.word_at = len(words), np.cumsum(codes == 0) - 1
        self.order, self.side = [], []
        for seq in (codes, codes[::-1]):
            order = rotations(seq, self.symbols)
            self.order.append(order)
            self.side.append(Wavelet(seq[order - 1], self.symbols))

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points, -2 for one that no word has."""
        at = np.minimum(np.searchsorted(self.alphabet, points), self.symbols - 1)
        return np.where(self.alphabet[at] == points, at, -2)

    def everything(self, count: int) -> Intervals:
        return Intervals([np.zeros(count, np.int64), np.zeros(count, np.int64)], np.full(count, self.n))

    def extended(self, p: Intervals, to: int, c: np.ndarray) -> Intervals:
        """Each pattern with its symbol ``c`` added on the left (``to`` 0) or the right (1); empty for a symbol below 0."""
        known = np.maximum(c, 0)
        lo, hi, less = self.side[to].range(known, p.lo[to], p.lo[to] + p.size)
        own = self.before[known] + lo - self.side[to].first[known]
        other = p.lo[1 - to] + less
        return Intervals([own, other] if to == 0 else [other, own], np.where(c < 0, 0, hi - lo))

    def located(self, to: int, lo: np.ndarray) -> np.ndarray:
        """Numbers of the words whose delimited form starts the rotations ``lo`` (of the text, or of its mirror image)."""
        at = self.order[to][lo]
        return self.word_at[at] if to == 0 else (self.word_at[self.n - 1 - at] - 1) % self.words


def one_error(index: FmIndex, points: np.ndarray, start: np.ndarray, length: np.ndarray, half: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) one edit apart that share the query's first half (``to`` 1: extended to the right) or second half (0)."""
    codes = index.codes(points)
    exact = np.where(to == 1, half, length - half)
    rest = length - exact
    step = 1 if to == 1 else -1
    seam = start + half                                         # first code point of the second half
    inner, outer = (seam - 1, seam) if to == 1 else (seam, seam - 1)

    def symbol(q: np.ndarray, j: np.ndarray | int) -> np.ndarray:
        """The ``j``-th symbol of the other half, outwards; -1 behind its end."""
        at = np.clip(outer[q] + step * j, 0, len(codes) - 1)
        return np.where(j < rest[q], codes[at], -1)

    q = np.arange(len(start))
    p = index.everything(len(q))
    for j in range(int(exact.max(initial=-1)) + 1):             # the exact half from the seam outwards, and its delimiter
        go = np.flatnonzero(j <= exact[q])
        c = np.where(j < exact[q[go]], codes[np.clip(inner[q[go]] - step * j, 0, len(codes) - 1)], 0)
        new = index.extended(p.take(go), 1 - to, c)
        for x, y in zip([*p.lo, p.size], [*new.lo, new.size], strict=True):
            x[go] = y
        live = np.flatnonzero(p.size > 0)
        q, p = q[live], p.take(live)
    found_q, found_v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    wave, j = index.side[to], 0

    def finish(q: np.ndarray, j: np.ndarray, lo: np.ndarray, size: np.ndarray) -> None:
        """What follows the error, exactly, and the delimiter; only the side that is extended is needed."""
        while len(q):
            c = symbol(q, j)
            end = c == -1
            live = np.flatnonzero((c >= 0) | end)
            q, j, lo, size, c, end = q[live], j[live], lo[live], size[live], np.maximum(c[live], 0), end[live]
            a, b, _ = wave.range(c, lo, lo + size)
            lo, size = index.before[c] + a - wave.first[c], b - a
            done = np.flatnonzero(end & (size > 0))
            found_q.append(q[done])
            found_v.append(index.located(to, lo[done]))
            live = np.flatnonzero(~end & (size > 0))
            q, j, lo, size = q[live], j[live] + 1, lo[live], size[live]

    while len(q):
        c, own = symbol(q, j), p.lo[to]
        of, d, a, b = wave.each(own, own + p.size)
        other = np.flatnonzero((d != 0) & (d != c[of]))         # neither the delimiter nor the symbol that is due
        of, d, lo, size = of[other], d[other], (index.before[d] + a - wave.first[d])[other], (b - a)[other]
        due = c[of] != -1
        finish(q[of[due]], np.full(int(due.sum()), j + 1), lo[due], size[due])          # replaced
        finish(q[of], np.full(len(of), j), lo, size)                                    # added
        out = np.flatnonzero((c != -1) & ((j == 0) | (c != symbol(q, j - 1))))          # of equal neighbours the first one
        finish(q[out], np.full(len(out), j + 1), own[out], p.size[out])                 # left out
        p = index.extended(p, to, c)                            # no error yet
        live = np.flatnonzero(p.size > 0)
        q, p, j = q[live], p.take(live), j + 1
    return np.concatenate(found_q), np.concatenate(found_v)


def search(index: FmIndex, words: list[str], queries: list[str], to: int) -> tuple[np.ndarray, np.ndarray]:
    """``one_error`` of all queries, some thousands at a time; each pair once."""
    out = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        own = queries[at:at + QUERIES_AT_ONCE]
        points = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
        length = np.array([len(w) for w in own], np.int64)
        q, v = one_error(index, points, np.cumsum(length) - length, length, length // 2, to)
        pairs = np.unique(np.stack([q, v], axis=1), axis=0)
        if to == 0:                                             # the scheme of the first half has found those that share it
            pairs = pairs[[not words[v].startswith(own[q][:len(own[q]) // 2]) for q, v in pairs.tolist()]]
        out.append(pairs + [at, 0])
    both = np.concatenate(out) if out else np.empty((0, 2), np.int64)
    return both[:, 0], both[:, 1]


# ------------------------------------------------------------------ on Spark

def _share_pairs(rows: pa.Table) -> pa.Table:
    """Near pairs of one share of the vocabulary: its queries against its index."""
    words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
    indexed, asked = (np.flatnonzero(rows[c].to_numpy(zero_copy_only=False)) for c in ("indexed", "asked"))
    if not len(indexed) or not len(asked):
        return _PAIRS.empty_table()
    own = [words[i] for i in indexed.tolist()]
    q, v = search(FmIndex(own), own, [words[i] for i in asked.tolist()], int(rows["side"][0].as_py()))
    q, v = asked[q], indexed[v]
    return pa.table([rows["word"].take(pa.array(q)).cast(pa.string()), pa.array(n[q]), rows["word"].take(pa.array(v)).cast(pa.string()), pa.array(n[v])], schema=_PAIRS)


_PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def shares(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows that are searched together: ``side, share, of, against``, with ``asked`` and ``indexed`` words."""
    size = F.length("word").cast("long") + 1
    total = vocab.agg(F.coalesce(F.sum(size), F.lit(0)).alias("s")).first().s
    ends = F.array(F.struct(F.lit(1).alias("side"), F.substring("word", 1, KEY).alias("key")),
                   F.struct(F.lit(0).alias("side"), F.substring(F.col("word"), -KEY, KEY).alias("key")))
    rows = vocab.select("word", "n", F.explode(ends).alias("e")).select("word", "n", "e.side", "e.key")
    large = rows.groupBy("side", "key").agg(F.sum(size).alias("s")).where(F.col("s") > block)
    rows = rows.join(large, ["side", "key"], "left")
    blocks = F.ceil(F.col("s") / block)
    own = F.pmod(F.xxhash64("word"), blocks)
    # a word of a cut key is asked against all its blocks, and stands in its own for the words of all
    each = F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1),
                                 lambda k: F.array(F.struct(own.alias("of"), k.alias("against")), F.struct(k.alias("of"), own.alias("against")))))
    place = F.when(F.col("s").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("of"), F.lit(0).cast("long").alias("against")))).otherwise(F.array_distinct(each))
    share: Column = F.when(F.col("s").isNull(), F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // block)))).cast("string")).otherwise(F.concat(F.lit("#"), F.col("key")))
    placed = rows.select("word", "n", "side", share.alias("share"), F.col("s").isNull().alias("whole"), own.alias("own"), F.explode(place).alias("p"))
    return placed.select("side", "share", F.col("p.of").alias("of"), F.col("p.against").alias("against"), "word", "n",
                         (F.col("whole") | (F.col("p.of") == F.col("own"))).alias("asked"),
                         (F.col("whole") | (F.col("p.against") == F.col("own"))).alias("indexed"))


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of the words (of six code points or more) that are one edit apart.

    ``vocab`` is read several times: hand over a written table.
    """
    return shares(vocab, block).groupBy("side", "share", "of", "against").applyInArrow(_share_pairs, "word string, n bigint, near string, near_n bigint")


def variants(vocab: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b")     # commonest, then smallest
    near = near_words(vocab, block).groupBy("word").agg(F.count("near").alias("n_near"), best)
    of = vocab.join(near, "word", "left")
    form_n = F.when(-F.col("b.less") >= ratio * F.col("n"), -F.col("b.less"))
    of = written(of.select("word", F.when(form_n.isNotNull(), F.col("b.near")).alias("form"), "n",
                           F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form_n.alias("form_n")), "forms")
    return of.join(roots(of), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(of: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form.  A form is at least ``ratio`` times as common as its word, so chains are
    short (27 words at ratio 5 and 64-bit counts) and doubling ends after a few rounds."""
    up = written(of.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while not up.join(up.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = written(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return up


@register("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, its form and its root."""
    return variants(written(vocabulary(table(spark, sf_dir, "documents")), "vocabulary"))
