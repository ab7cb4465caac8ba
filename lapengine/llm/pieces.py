"""SentencePiece (merge type) encoding with seeded merge-dropout, and lossless decoding.

The vocabulary and its scores come from a public model file; nothing is
trained.  A text is its code points behind one space, each space written as
the piece mark.  An agenda per segment merges the best-scored neighbouring
pair first (leftmost on ties).  Each candidate merge is skipped if a keyed
hash of (seed, text key, place of the pair) falls below the dropout rate, so
seeds and keys give different segmentations, the same ones on every run.  At
rate 0 the result is the model's own encoding.

No piece holds a mark behind another character, and none holds a line feed,
so merges never cross into a run of spaces or over a line feed: segments are
cut there and encoded apart.  All segments of a chunk advance together, one
merge a round each; a segment longer than ``LONG`` has a heap of its own.

A character outside the vocabulary, and a mark that the text itself holds, is
written as its UTF-8 bytes' pieces, so every text decodes to itself.

Defined cases: a null or empty text has no token and decodes to the empty
text.  Repeated rows are encoded row by row, alike if their keys are.  A null
key counts as one key.  Other columns are kept.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.textarrays import mix, row_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
MARK, NONE, LONG, CHUNK = "▁", np.int32(2**31 - 1), 64, 1 << 18
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def load_pieces(path: str = MODEL) -> list[tuple[str, float, bool]]:
    """``piece, score, ordinary`` by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i), not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
            for i in range(sp.get_piece_size())]


class Vocabulary:
    """Lookup tables of a merge-type vocabulary with byte fallback."""

    def __init__(self, pieces: list[tuple[str, float, bool]]) -> None:
        own = {p: k for k, (p, _, ordinary) in enumerate(pieces) if ordinary}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in own):
            raise ValueError("pieces with an inner mark or a line feed are not supported")
        by_name = {p: k for k, (p, _, _) in enumerate(pieces)}
        self.byte_id = np.array([by_name[f"<0x{b:02X}>"] for b in range(256)], np.int32)
        self.raw = [p.replace(MARK, " ").encode() if p in own else b"" for p, _, _ in pieces]
        for b, k in enumerate(self.byte_id.tolist()):
            self.raw[k] = bytes([b])
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, k in own.items():
            if len(p) == 1 and p != MARK:
                self.of_char[ord(p)] = k
        self.of_char[ord(" ")] = own[MARK]
        scores = sorted({-pieces[k][1] for k in own.values()})
        place = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(len(pieces), NONE, np.int32)
        for k in own.values():
            self.rank[k] = place[-pieces[k][1]]
        pairs = {(own[p[:i]] * len(pieces) + own[p[i:]]): k
                 for p, k in own.items() for i in range(1, len(p)) if p[:i] in own and p[i:] in own}
        self.size = len(pieces)
        self.bits = np.uint64(64 - (len(pairs).bit_length() + 3))
        self.keys = np.full(1 << int(64 - self.bits), -1, np.int64)
        self.into = np.full(len(self.keys), -1, np.int32)
        todo, merged = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        at, self.probes = self.slot(todo), 0
        while len(todo):                                        # open addressing, one probe further a turn
            self.probes += 1
            free = np.flatnonzero(self.keys[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.into[at[put]] = todo[put], merged[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, merged, at = todo[rest], merged[rest], (at[rest] + 1) & (len(self.keys) - 1)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _A) >> self.bits).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that a pair merges into, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = self.slot(key)
        out = np.where(self.keys[at] == key, self.into[at], np.int32(-1))
        live = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -1))
        for _ in range(1, self.probes):
            if not len(live):
                break
            at[live] = (at[live] + 1) & (len(self.keys) - 1)
            had = self.keys[at[live]]
            hit = had == key[live]
            out[live[hit]] = self.into[at[live[hit]]]
            live = live[~hit & (had != -1)]
        out[(left < 0) | (right < 0)] = -1
        return out


@dataclass
class Dropout:
    """Which candidate merges are skipped: by text key, start, middle and end of the pair in its text."""

    rate: float
    seed: int

    def skips(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.rate <= 0:
            return np.zeros(len(start), bool)
        if self.rate >= 1:
            return np.ones(len(start), bool)
        place = start.astype(np.uint64) * _A + middle.astype(np.uint64) * _B + end.astype(np.uint64) * _C
        return mix(mix(place + np.uint64(self.seed % 2**64)) ^ key) < np.uint64(int(self.rate * 2**64))


def _pairs(v: Vocabulary, d: Dropout, sym, keys, row, pos, end, seg, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank (NONE: no candidate) and merged piece of the pairs (i, i + 1)."""
    into = v.merged(sym[i], sym[i + 1])
    into[seg[i] != seg[i + 1]] = -1
    live = np.flatnonzero(into >= 0)
    own = i[live]
    into[live[d.skips(keys[row[own]], pos[own], pos[own + 1], end[own + 1])]] = -1
    return np.where(into >= 0, v.rank[into], NONE), into


def _heap_segment(v: Vocabulary, d: Dropout, sym: np.ndarray, key: np.uint64, pos: np.ndarray, end: np.ndarray) -> list[int]:
    """One long segment: an agenda of (rank, place) over a linked list; returns symbols at their places, -2 if merged away."""
    n = len(sym)
    keys, one = np.array([key], np.uint64), np.zeros(n, np.int8)
    rank, into = _pairs(v, d, sym, keys, one, pos, end, one, np.arange(n - 1))
    s, stop = sym.tolist(), end.tolist()
    agenda = [(r, i, s[i], s[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), into.tolist(), strict=True)) if m >= 0]
    heapq.heapify(agenda)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    at = pos.tolist()

    def propose(i: int, j: int) -> None:
        r, m = _pairs(v, d, np.array([s[i], s[j]], np.int32), keys, one,
                      np.array([at[i], at[j]]), np.array([stop[i], stop[j]]), one, np.zeros(1, np.int64))
        if m[0] >= 0:
            heapq.heappush(agenda, (int(r[0]), i, s[i], s[j], int(m[0])))

    alive = [True] * n
    while agenda:
        _, i, left, right, m = heapq.heappop(agenda)
        j = after[i] if alive[i] else n
        if j >= n or s[i] != left or s[j] != right:
            continue
        s[i], stop[i], alive[j], after[i] = m, stop[j], False, after[j]
        if after[j] < n:
            before[after[j]] = i
            propose(i, after[j])
        if before[i] >= 0:
            propose(before[i], i)
    return [x if a else -2 for x, a in zip(s, alive, strict=True)]


def encode_points(v: Vocabulary, d: Dropout, points: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, one after another, and the rows' id offsets; ``points`` includes each row's leading space."""
    n = len(points)
    out = np.full(n, -2, np.int32)                              # the symbol that starts here; -1: to be written as bytes
    if n == 0:
        return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
    space, feed = points == 32, points == 10
    first = space | feed
    first[1:] &= ~space[:-1] | feed[1:]
    first[1:] |= feed[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    seg = np.cumsum(first, dtype=np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    sym = v.of_char[points]
    sym[points == ord(MARK)] = -1
    size = np.bincount(seg)
    for k in np.flatnonzero(size > LONG):
        lo = int(np.searchsorted(seg, k))
        hi = lo + int(size[k])
        out[lo:hi] = _heap_segment(v, d, sym[lo:hi], keys[row[lo]], place[lo:hi], place[lo:hi] + 1)
    at = np.flatnonzero(size[seg] <= LONG).astype(np.int32)
    sym, row, pos, seg = sym[at], row[at].astype(np.int32), place[at].astype(np.int32), seg[at].astype(np.int32)
    end = pos + 1
    rank, into = np.full(len(at), NONE, np.int32), np.full(len(at), -1, np.int32)
    if len(at) > 1:
        rank[:-1], into[:-1] = _pairs(v, d, sym, keys, row, pos, end, seg, np.arange(len(at) - 1))
    while len(at):
        starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(seg)]))
        keep = best < NONE
        done = np.flatnonzero(~keep)                            # no candidate is left in the segment
        out[at[done]] = sym[done]
        hit = np.flatnonzero((rank == best) & keep)
        if not len(hit):
            break
        hit = hit[np.r_[True, seg[hit[1:]] != seg[hit[:-1]]]]   # the leftmost of each segment
        sym[hit], end[hit] = into[hit], end[hit + 1]
        keep[hit + 1] = False
        live = np.flatnonzero(keep)
        sym, row, pos, end, seg, at, rank, into = (x[live] for x in (sym, row, pos, end, seg, at, rank, into))
        hit = np.searchsorted(live, hit)
        i = np.concatenate([hit[hit < len(sym) - 1], hit[hit > 0] - 1])
        rank[hit[hit == len(sym) - 1]] = NONE
        rank[i], into[i] = _pairs(v, d, sym, keys, row, pos, end, seg, i)
    # write symbols, and bytes for characters outside the vocabulary
    width = np.where(out == -2, 0, 1)
    other = np.flatnonzero(out == -1)
    said = [chr(c).encode("utf-8") for c in points[other].tolist()]
    width[other] = [len(b) for b in said]
    total = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=total[1:])
    ids = np.repeat(out, width)
    if said:
        where = np.repeat(total[other], width[other]) + np.concatenate([np.arange(len(b)) for b in said])
        ids[where] = v.byte_id[np.frombuffer(b"".join(said), np.uint8)]
    return ids, total[offsets]


def encode_batch(v: Vocabulary, d: Dropout, text: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and the rows' offsets; runs of rows of about CHUNK bytes at a time."""
    data, off = row_bytes(text)
    lo, rows = 0, len(off) - 1
    ids, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    while lo < rows:
        hi = min(rows, max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, "right")) - 1))
        own = data[off[lo]:off[hi]]
        points = np.frombuffer(own.tobytes().decode().encode("utf-32-le"), np.uint32)
        begun = np.zeros(len(own) + 1, np.int64)
        np.cumsum((own & 0xC0) != 0x80, out=begun[1:])
        starts = begun[off[lo:hi + 1] - off[lo]]
        worded = np.diff(starts) > 0
        points = np.insert(points, starts[:-1][worded], 32)     # the leading space of each row with text
        starts = starts + np.r_[0, np.cumsum(worded)]
        got, at = encode_points(v, d, points, starts, keys[lo:hi])
        ids.append(got)
        sizes.append(np.diff(at))
        lo = hi
    return np.concatenate(ids), np.cumsum(np.concatenate(sizes))


def decode(v: Vocabulary, ids: list[int]) -> bytes:
    """UTF-8 of the text that was encoded."""
    return b"".join([v.raw[k] for k in ids])[1:]


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(key: str, said: Broadcast) -> Vocabulary:
    """A Python worker builds the tables once and keeps them."""
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(said.value)
    return _vocabularies[key]


def _encode(name: str, said: Broadcast, d: Dropout, text: pa.Array, key: pa.Array) -> pa.Array:
    keys = key.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
    v = _vocabulary(name, said)
    ids, off = encode_batch(v, d, text, keys)
    data, at = row_bytes(text)
    same = [decode(v, ids[a:b].tolist()) == data[s:e].tobytes() for a, b, s, e in     # a row's list at a time
            zip(off[:-1].tolist(), off[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids)), pa.array(same)], ["ids", "lossless"])


class Tokenizer:
    """Encoding and decoding columns with one model file, dropout rate and seed."""

    def __init__(self, spark: SparkSession, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> None:
        self.name, self.said = uuid.uuid4().hex, spark.sparkContext.broadcast(load_pieces(model))  # a vocabulary: some 100 kB
        self.dropout = Dropout(dropout, seed)

    def encode(self, text: Column, key: Column) -> Column:
        """Struct column ``ids, lossless``; ``lossless``: the ids decode to the text."""
        name, said, d = self.name, self.said, self.dropout

        def of(text: pa.Array, key: pa.Array) -> pa.Array:
            return _encode(name, said, d, text, key)
        return F.arrow_udf(of, "struct<ids:array<int>,lossless:boolean>")(text, F.xxhash64(key))

    def decode(self, ids: Column) -> Column:
        name, said = self.name, self.said

        def of(ids: pa.Array) -> pa.Array:
            v = _vocabulary(name, said)
            return pa.array([decode(v, x.as_py() or []).decode("utf-8", "replace") for x in ids], pa.string())
        return F.arrow_udf(of, "string")(ids)


@register("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded with merge-dropout: token count, digest of the ids, and whether they decode to the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    e = docs.select("doc_id", Tokenizer(spark).encode(F.col("text"), F.col("doc_id")).alias("e"))
    return e.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"), digest(F.col("e.ids")).alias("ids_sha256"),
                    F.col("e.lossless").alias("lossless"))


def digest(ids: Column) -> Column:
    """SHA-256 of the ids in decimal, comma-joined."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
