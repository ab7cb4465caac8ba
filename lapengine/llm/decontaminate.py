"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Words are runs of ASCII letters, digits and all characters above ASCII, with
A-Z lower-cased.  A pattern is a window of ``WINDOW`` consecutive words of a
benchmark item (an item with fewer words is one window).  Patterns of one
length m share a block shift table: for each block of ``b`` words, how far a
window that ends with it can be moved on.  Texts are searched in lanes of a
few hundred word positions, all lanes of a chunk at once: each lane looks up
the block that ends at its position and skips ahead by its shift; only at
shift zero does it look in the suffix-hash bucket of the block, whose patterns
are checked by their first word's hash and then compared word by word.

The benchmark's patterns are broadcast in parts of bounded size (``PART_CHARS``
of item text); a larger benchmark is searched part by part over the whole
table, and the parts' hits are united.

Defined cases: a null or wordless text has no word, no hit, no item and is
clean; a null or wordless item has no window.  A null item_id marks words but
is not counted as an item; repeated item_ids are one item.  Repeated documents
are judged row by row.  Other columns are kept.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.storage import written
from lapengine.llm.textarrays import BYTE_CODE, Chunk, chunks, gram_hashes

WINDOW = 13
LANE = 256
PART_CHARS = 32 << 20

SEPARATOR = np.ones(128, bool)
SEPARATOR[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = False
SEPARATOR = np.r_[SEPARATOR, np.zeros(128, bool)]
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[ord("A"):ord("Z") + 1] += 32
LOWER_CODE = BYTE_CODE[TO_LOWER]


def chunk_words(c: Chunk, lo: int, hi: int) -> bytes:
    """Words lo:hi of a chunk, lower-cased, joined by one space."""
    s, e = c.starts[lo:hi].tolist(), c.ends[lo:hi].tolist()
    return b" ".join([c.data[a:b].tobytes() for a, b in zip(s, e, strict=True)]).lower()


@dataclass
class Shifts:
    """Wu-Manber tables of all patterns of one length."""

    words: np.ndarray            # patterns x length word hashes, sorted by the suffix block's hash
    texts: list[bytes]           # the patterns' words, joined
    items: list[np.ndarray]      # positions in the sorted item list
    block: int = field(init=False)
    shift: np.ndarray = field(init=False)
    suffix: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n, m = self.words.shape
        self.block = min(3, m)
        ends = np.stack([gram_hashes(np.ascontiguousarray(row), self.block) for row in self.words])
        order = np.argsort(ends[:, -1], kind="stable")
        self.words, ends = self.words[order], ends[order]
        self.texts, self.items = [self.texts[i] for i in order], [self.items[i] for i in order]
        self.suffix = ends[:, -1].copy()
        bits = max(12, int(n * m).bit_length() + 3)
        self.shift = np.full(1 << min(bits, 24), m - self.block + 1, np.uint8)
        for j in range(ends.shape[1]):                          # the block that ends m - block - j words before the end
            np.minimum.at(self.shift, self.slot(ends[:, j]), m - self.block - j)

    def slot(self, h: np.ndarray) -> np.ndarray:
        return (h & np.uint64(len(self.shift) - 1)).astype(np.int64)

    def ends(self, word_off: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Word positions at which some pattern may end: those where the search comes to shift zero."""
        m = self.words.shape[1]
        first, stop = word_off[:-1] + m - 1, word_off[1:]
        n = np.maximum(0, -(-(stop - first) // LANE))
        row = np.repeat(np.arange(len(n)), n)
        at = first[row] + LANE * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
        stop = np.minimum(at + LANE, stop[row])
        step = self.shift[self.slot(blocks)]                    # by the block's first word
        out = [np.empty(0, np.int64)]
        while len(at):
            s = step[at - (self.block - 1)]
            out.append(at[s == 0])
            at = at + np.maximum(s, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return np.concatenate(out)

    def occurrences(self, c: Chunk, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of each occurrence in the chunk."""
        m = self.words.shape[1]
        none = np.empty(0, np.int64)
        blocks = gram_hashes(hashes, self.block)
        if not len(blocks):
            return none, none
        at = self.ends(c.word_off, blocks)
        own = blocks[at - (self.block - 1)]
        lo, hi = np.searchsorted(self.suffix, own, "left"), np.searchsorted(self.suffix, own, "right")
        start, pattern = [none], [none]
        live = np.flatnonzero(hi > lo)
        while len(live):                                        # the next pattern of every bucket
            a, p = at[live] - (m - 1), lo[live]
            ok = hashes[a] == self.words[p, 0]
            a, p = a[ok], p[ok]
            for j in range(1, m):
                ok = hashes[a + j] == self.words[p, j]
                a, p = a[ok], p[ok]
            sure = np.fromiter((chunk_words(c, x, x + m) == self.texts[y] for x, y in zip(a.tolist(), p.tolist(), strict=True)),
                               bool, len(a))
            start.append(a[sure])
            pattern.append(p[sure])
            lo[live] += 1
            live = live[lo[live] < hi[live]]
        return np.concatenate(start), np.concatenate(pattern)


def compile_patterns(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> tuple[list[Shifts], list[str]]:
    """Shift tables by pattern length, and the item ids sorted as strings."""
    ids = sorted({i for i, _ in items if i is not None})
    rank = {x: k for k, x in enumerate(ids)}
    found: dict[bytes, tuple[np.ndarray, set[int]]] = {}
    for c in chunks(pa.array([t for _, t in items], pa.string()), SEPARATOR):
        hashes = c.hashes(LOWER_CODE)
        for k in range(c.hi - c.lo):
            a, b = int(c.word_off[k]), int(c.word_off[k + 1])
            m = min(window, b - a)
            for s in range(a, b - m + 1 if m else a):
                _, of = found.setdefault(chunk_words(c, s, s + m), (hashes[s:s + m], set()))
                if items[c.lo + k][0] is not None:
                    of.add(rank[items[c.lo + k][0]])
    tables = []
    for m in sorted({len(h) for h, _ in found.values()}):
        own = [(t, h, of) for t, (h, of) in found.items() if len(h) == m]
        tables.append(Shifts(np.stack([h for _, h, _ in own]), [t for t, _, _ in own],
                             [np.array(sorted(of), np.int64) for _, _, of in own]))
    return tables, ids


def search(col: pa.Array, tables: list[Shifts], ids: list[str], hit: pa.Array | None = None, had: pa.Array | None = None) -> pa.Array:
    """``n_words, n_hit, hit (one bit a word), items`` of each text, united with an earlier part's."""
    n_words, n_hit, bits, items = [], [], [], []
    for c in chunks(col, SEPARATOR):
        hashes = c.hashes(LOWER_CODE)
        edge = np.zeros(len(hashes) + 1, np.int32)
        got: list[np.ndarray] = [np.empty(0, np.int64)]
        row_of = c.row_of_word()
        for t in tables:
            start, pattern = t.occurrences(c, hashes)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + t.words.shape[1], -1)
            pairs = np.unique(row_of[start] * len(t.texts) + pattern)
            got += [p // len(t.texts) * len(ids) + t.items[p % len(t.texts)] for p in pairs.tolist()]
        covered = np.cumsum(edge[:-1]) > 0
        pairs = np.unique(np.concatenate(got))
        by_row = np.searchsorted(pairs, np.arange(c.hi - c.lo + 1) * max(1, len(ids)))
        for k in range(c.hi - c.lo):
            own = covered[c.word_off[k]:c.word_off[k + 1]]
            if hit is not None and (old := hit[c.lo + k].as_py()):
                own = own | np.unpackbits(np.frombuffer(old, np.uint8), count=len(own)).astype(bool)
            said = [ids[p % len(ids)] for p in pairs[by_row[k]:by_row[k + 1]].tolist()]
            if had is not None and (old := had[c.lo + k].as_py()):
                said = sorted({*said, *old})
            n_words.append(len(own))
            n_hit.append(int(own.sum()))
            bits.append(np.packbits(own).tobytes() if n_hit[-1] else None)
            items.append(said)
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(bits, pa.binary()),
                                       pa.array(items, pa.list_(pa.string()))], ["n_words", "n_hit", "hit", "items"])


HITS = "struct<n_words:bigint,n_hit:bigint,hit:binary,items:array<string>>"
_tables: dict[str, tuple[list[Shifts], list[str]]] = {}


def _search_part(key: str, said: Broadcast, window: int, cols: tuple[pa.Array, ...]) -> pa.Array:
    """Search with the tables of one part, which a Python worker builds once and keeps."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = compile_patterns(said.value, window)
    return search(cols[0], *_tables[key], *cols[1:])


def _part(spark: SparkSession, items: list[tuple[str | None, str | None]], window: int):
    said, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def first(text: pa.Array) -> pa.Array:
        return _search_part(key, said, window, (text,))

    def later(text: pa.Array, hit: pa.Array, had: pa.Array) -> pa.Array:
        return _search_part(key, said, window, (text, hit, had))
    return first, later


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", to: str = "_hits",
         part_chars: int = PART_CHARS) -> DataFrame:
    """``docs`` with the struct ``to``: n_words, n_hit, hit and items of each text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where("t is not null")
    parts = max(1, -(-(items.agg(F.sum(F.length("t"))).first()[0] or 0) // part_chars))
    own = F.pmod(F.xxhash64("t"), F.lit(parts))
    out = docs
    for k in range(parts):
        said = [(r.i, r.t) for r in items.where(own == k).collect()]
        first, later = _part(spark, said, window)
        if k == 0:
            out = docs.withColumn(to, F.arrow_udf(first, HITS)(F.col(text_col)))
        else:
            out = written(out, "hits")
            out = out.withColumn(to, F.arrow_udf(later, HITS)(F.col(text_col), F.col(f"{to}.hit"), F.col(f"{to}.items")))
    return out


def is_contaminated(hits: Column) -> Column:
    return (hits["n_hit"] > 0) & (20 * hits["n_hit"] >= hits["n_words"])


WORDS_SQL = ("[x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']")
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, {WORDS_SQL} as w from documents),
b as (select item_id, w, least({WINDOW}, len(w)) as m from (select item_id, {WORDS_SQL} as w from benchmark) where len(w) > 0),
pat as (select distinct item_id, m, array_to_string(w[s:s + m - 1], ' ') as p from (select *, unnest(range(1, len(w) - m + 2)) as s from b)),
ms as (select distinct m from pat),
win as (select r, s, m, array_to_string(w[s:s + m - 1], ' ') as p
        from (select r, w, m, unnest(range(1, len(w) - m + 2)) as s from d, ms)),
occ as (select r, s, m, item_id from win join pat using (m, p)),
hit as (select r, count(distinct k) as n_hit from (select r, unnest(range(s, s + m)) as k from occ) group by r),
it as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as said
       from occ group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(said, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (r) left join it using (r)
"""


@register("op8_decontaminate", ORACLE_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every whole text of documents."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    h = F.col("_hits")
    return found.select("doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"), is_contaminated(h).alias("contaminated"))
