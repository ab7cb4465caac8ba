"""Substring dedup: seed and extend over word sequences.

A repeat is a run of ``LENGTH`` words or more that occurs at two places or
more, in one text or in several.

Seeds: k-grams of words are winnowed.  Every window of LENGTH words has one
anchor, its k-gram of least hash (leftmost on ties), so equal windows have
equal anchors at equal offsets.  Anchors are counted by partial aggregation;
those at two places or more are seeds, and one place of each is its leader.

Extension: every place of a seed is joined with the leader's and the match is
extended from the anchor both ways, one window at a time, as far as the
windows of which this anchor is the anchor.  Consecutive windows that match
form maximal repeats, of the place and of the leader.  Windows that differ
from the leader's can only repeat one another, and are matched by their hash.
So a seed of any number of places costs one comparison a place, never a pair
of places.  A bit map of fixed size drops most anchors that are no seeds
before they are shuffled; what it lets through is joined exactly.

Equal texts are one text with several rows: all their windows repeat.

Defined cases: a null text has no word.  A text of fewer than LENGTH words
has no window and keeps all words.  Repeated rows are copies of each other.
Other columns are kept; names that begin with an underscore are reserved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import written
from lapengine.llm.textarrays import Chunk, chunks, gram_hashes, mix

LENGTH, GRAM = 35, 16
FILTER_BITS = (20, 28)          # least and most bits of the bit map, as powers of two: 32 MB at most
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def place_id(t1: np.ndarray, t2: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Id of a word's place in a text."""
    return mix(mix(t1.view(np.uint64) + t2.view(np.uint64) * _A) + word.astype(np.uint64) * _B)


def anchors(c: Chunk, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor of a chunk: its hash, row, word, the first window of which it is the anchor, and
    how many windows follow; then all windows' hashes."""
    h = c.hashes()
    none = np.empty(0, np.int64)
    if len(h) < length:
        return none.view(np.uint64), none, none, none, none, none.view(np.uint64)
    g, row = gram_hashes(h, gram), c.row_of_word()
    at = sliding_window_view(g, length - gram + 1).argmin(axis=1) + np.arange(len(h) - length + 1)
    valid = row[:len(at)] == row[length - 1:]
    own = np.flatnonzero(valid)
    at = at[own]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(own) else none
    count = np.diff(np.r_[new, len(own)])
    return g[at[new]], row[own[new]], at[new], own[new], count, gram_hashes(h, length)


def passes(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(h), bool)
    k = h & np.uint64(len(bits) * 64 - 1)
    return (bits[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_map(spark: SparkSession, hashes: DataFrame, n: int) -> Broadcast:
    """Broadcast bit map of the bigint column ``h``: about 16 bits a value, within FILTER_BITS."""
    size = 1 << min(max(int(16 * max(1, n)).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    k = F.col("h").bitwiseAND(F.lit(size - 1))
    words = (hashes.select(F.shiftright(k, 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())     # at most size / 64 rows
    bits = np.zeros(size // 64, np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


_PLACES = "a bigint, place bigint, t1 bigint, t2 bigint, word int, first int, hashes binary"


def places(texts: DataFrame, length: int, gram: int, seeds: Broadcast | None = None, leaders: Broadcast | None = None, hashes: bool = True) -> DataFrame:
    """Anchors of ``texts(t1, t2, text)`` that pass the bit maps, with the hashes of their windows if asked."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for c in chunks(batch.column(2)):
                a, row, word, first, count, windows = anchors(c, length, gram)
                own1, own2 = t1[c.lo:c.hi][row], t2[c.lo:c.hi][row]
                begin = c.word_off[row]
                place = place_id(own1, own2, word - begin)
                ok = passes(seeds and seeds.value, a) & passes(leaders and leaders.value, place)
                cols = [pa.array(a[ok].view(np.int64)), pa.array(place[ok].view(np.int64))]
                if hashes:
                    said = [windows[s:s + n].tobytes() for s, n in zip(first[ok].tolist(), count[ok].tolist(), strict=True)]
                    cols += [pa.array(own1[ok]), pa.array(own2[ok]), pa.array((word - begin)[ok], pa.int32()),
                             pa.array((first - begin)[ok], pa.int32()), pa.array(said, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["a", "place", "t1", "t2", "word", "first", "hashes"][:len(cols)])

    return texts.select("t1", "t2", "text").mapInArrow(of, _PLACES if hashes else "a bigint, place bigint")


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a binary column, and the rows' sizes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]] if len(col) else np.empty(0, np.uint8)
    return np.frombuffer(data.tobytes(), np.uint64), np.diff(off) // 8


_MATCHED = "t1 bigint, t2 bigint, lo int, hi int, g bigint, place bigint"


def extend(joined: DataFrame, length: int) -> DataFrame:
    """Places joined with their leader (columns l_*) -> repeats ``lo:hi`` of a text's words (g null), and the
    windows that differ from the leader's, with a hash ``g`` of anchor, offset and words."""
    names = ["a", "place", "t1", "t2", "word", "first", "hashes", "l_place", "l_t1", "l_t2", "l_word", "l_first", "l_hashes"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {n: batch.column(k) for k, n in enumerate(names)}
            (h, n), (lh, ln) = _flat(x["hashes"]), _flat(x["l_hashes"])
            x = {k: v.to_numpy() for k, v in x.items() if "hashes" not in k}
            row = np.repeat(np.arange(len(n)), n)
            j = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            shift = (x["l_word"] - x["l_first"]) - (x["word"] - x["first"])     # the leader's window at the same offset
            k = j + shift[row]
            other = x["place"] != x["l_place"]
            inside = (k >= 0) & (k < ln[row]) & other[row]
            same = np.zeros(len(h), bool)
            same[inside] = lh[(np.cumsum(ln) - ln)[row[inside]] + k[inside]] == h[inside]
            edge = np.r_[True, row[1:] != row[:-1]] if len(row) else np.empty(0, bool)
            begun = np.flatnonzero(same & (edge | ~np.r_[False, same[:-1]]))
            ended = np.flatnonzero(same & (np.r_[edge[1:], True] | ~np.r_[same[1:], False])) if len(row) else begun
            r = row[begun]
            lo, hi = x["first"][r] + j[begun], x["first"][r] + j[ended] + length
            l_lo, l_hi = x["l_first"][r] + k[begun], x["l_first"][r] + k[ended] + length
            _, once = np.unique(mix(place_id(x["l_t1"][r], x["l_t2"][r], l_lo) + l_hi.astype(np.uint64) * _A), return_index=True)
            yield _rows(x["t1"][r], x["t2"][r], lo, hi)
            yield _rows(x["l_t1"][r][once], x["l_t2"][r][once], l_lo[once], l_hi[once])
            rest = np.flatnonzero(~same & other[row]) if len(row) else begun
            r = row[rest]
            at = x["first"][r] + j[rest]
            g = mix(mix(x["a"][r].view(np.uint64) + (x["word"][r] - at).astype(np.uint64) * _A) ^ h[rest])
            yield _rows(x["t1"][r], x["t2"][r], at, at + length, g, place_id(x["t1"][r], x["t2"][r], at))

    return joined.select(*names).mapInArrow(of, _MATCHED)


def _rows(t1, t2, lo, hi, g=None, place=None) -> pa.RecordBatch:
    none = pa.nulls(len(t1), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(t1), pa.array(t2), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
         none if g is None else pa.array(g.view(np.int64)), none if place is None else pa.array(place.view(np.int64))],
        ["t1", "t2", "lo", "hi", "g", "place"])


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``t1, t2, text``: each row's text and its 128-bit id."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2"), text.alias("text"))


def repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``t1, t2, copied, ranges``: of each text that holds a repeat, whether it is several rows', and
    the word ranges of its repeats with other places."""
    spark, texts = docs.sparkSession, keyed(docs, text_col)
    copied = texts.select("t1", "t2").groupBy("t1", "t2").count().where("count > 1").select("t1", "t2", F.lit(True).alias("copied"))
    seeds = written(places(texts, length, gram, hashes=False).groupBy("a").agg(F.min("place").alias("l_place"), F.max("place").alias("last"))
                    .where("l_place <> last").select("a", "l_place"), "seeds")
    n = seeds.count()
    by_hash, by_place = (bit_map(spark, seeds.select(F.col(c).alias("h")), n) for c in ("a", "l_place"))
    leaders = (places(texts, length, gram, by_hash, by_place).withColumnsRenamed({c: "l_" + c for c in ("place", "t1", "t2", "word", "first", "hashes")})
               .join(seeds, ["a", "l_place"]).dropDuplicates(["a"]))
    leaders = written(leaders, "leaders")
    found = written(extend(places(texts, length, gram, by_hash).join(leaders, "a"), length), "matches")
    rest = found.where("g is not null")
    twice = written(rest.groupBy("g").agg(F.min("place").alias("p"), F.max("place").alias("q")).where("p <> q").select("g"), "windows")
    ranges = found.where("g is null").select("t1", "t2", "lo", "hi").union(rest.join(twice, "g").select("t1", "t2", "lo", "hi"))
    of_text = ranges.groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))      # at most one a window of the text
    return written(of_text.join(copied, ["t1", "t2"], "full"), "repeats")


def _kept(length: int, text: pa.Array, copied: pa.Array, ranges: pa.Array) -> pa.Array:
    total, removed, kept = [], [], []
    for t, all_, own in zip(text, copied.to_pylist(), ranges, strict=True):
        words = (t.as_py() or b"").split()
        n = len(words)
        gone = np.zeros(n + 1, np.int32)
        if all_ and n >= length:
            gone[0] += 1
        for r in own.as_py() or ():
            gone[r["lo"]] += 1
            gone[r["hi"]] -= 1
        stay = np.cumsum(gone[:n]) == 0 if gone.any() else None
        if stay is not None:
            words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
        total.append(n)
        removed.append(n - len(words))
        kept.append(b" ".join(words).decode())
    return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                      ["n_words", "n_removed", "kept"])


def remove(docs: DataFrame, text_col: str = "text", to: str = "_rest", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the struct ``to``: n_words, n_removed and the kept words, joined by one space."""
    own = repeats(docs, text_col, length, gram).select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("copied").alias("_copied"),
                                                      F.col("ranges").alias("_ranges"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns({"_t1": F.xxhash64(text), "_t2": F.xxhash64(text, F.lit(1))}).join(own, ["_t1", "_t2"], "left")

    def of(text: pa.Array, copied: pa.Array, ranges: pa.Array) -> pa.Array:
        return _kept(length, text, copied, ranges)
    kept = F.arrow_udf(of, "struct<n_words:bigint,n_removed:bigint,kept:string>")(F.col(text_col).cast("binary"), F.col("_copied"), F.col("_ranges"))
    return rows.withColumn(to, kept).drop("_t1", "_t2", "_copied", "_ranges")


WORDS_SQL = r"[x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, {WORDS_SQL} as w from documents),
win as (select r, s, array_to_string(w[s:s + {LENGTH - 1}], ' ') as p from (select r, w, unnest(range(1, len(w) - {LENGTH - 2})) as s from d)),
twice as (select p from win group by p having count(*) > 1),
gone as (select distinct r, s + k as i from win join twice using (p), (select unnest(range({LENGTH})) as k)),
word as (select r, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from d),
kept as (select r, string_agg(x, ' ' order by i) as t, count(*) as n from word anti join gone using (r, i) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r)
"""


@register("op3_substring_dedup", ORACLE_SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated 35-word windows."""
    rest = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rest.select("doc_id", F.col("_rest.n_words").alias("n_words"), F.col("_rest.n_removed").alias("n_removed"),
                       F.sha2("_rest.kept", 256).alias("kept_sha256"))
