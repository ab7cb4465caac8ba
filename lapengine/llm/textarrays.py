"""Numpy views of Arrow text columns: words, word hashes and rolling k-gram hashes.

A chunk is a run of whole rows of about ``CHUNK_BYTES``; a longer text is a
chunk of its own, so memory is bounded by the longest single text, not by the
batch.  Words are maximal runs of bytes that are not separators; all
separators are ASCII, so UTF-8 sequences are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)   # random code of each byte value
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)                    # odd, so invertible modulo 2^64
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))

SPACE = np.zeros(256, bool)                                 # [\x20\x09-\x0D]
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2^64, kept for the sizes that recur."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_sums(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, inv: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * inv[start]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """64-bit hash of each byte span (ascending, disjoint) of ``data``."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK_BYTES, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        prefix = np.zeros(b - a + 1, np.uint64)
        np.cumsum(code[data[a:b]] * powers(BASE, b - a), out=prefix[1:])
        s = starts[lo:hi] - a
        out[lo:hi] = range_sums(prefix, s, ends[lo:hi] - a, powers(BASE_INV, b - a + 1))
        lo = hi
    return mix(out ^ (ends - starts).astype(np.uint64))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of values[i:i+k] for each i (length n-k+1, or none)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=prefix[1:])
    return mix((prefix[k:] - prefix[:-k]) * powers(BASE_INV, n))


@dataclass
class Chunk:
    """Rows ``lo:hi`` of a batch; offsets, starts and ends count in ``data``."""

    lo: int
    hi: int
    data: np.ndarray        # bytes of the rows' texts, one after another
    offsets: np.ndarray     # hi - lo + 1 byte offsets of the rows
    starts: np.ndarray      # byte offset of each word
    ends: np.ndarray
    word_off: np.ndarray    # hi - lo + 1 word offsets of the rows

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_off)

    def hashes(self, code: np.ndarray = BYTE_CODE) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, code)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), self.n_words)


def row_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the rows' offsets in them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def split_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word starts, word ends and the rows' word offsets; rows are cut apart."""
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def chunks(col: pa.Array, separator: np.ndarray = SPACE, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The batch's text column in runs of rows of about ``limit`` bytes, split into words."""
    data, offsets = row_bytes(col)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1))
        own, off = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        yield Chunk(lo, hi, own, off, *split_words(own, off, separator))
        lo = hi
