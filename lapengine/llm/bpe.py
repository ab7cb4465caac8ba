"""Byte-level BPE with word ends: exact encoding by backtracking over longest matches, decoding by an offset table.

The vocabulary and its merges come from a public tokenizer file; nothing is
trained.  A text is cut at the file's special tokens, composed (NFC),
lower-cased character by character and split into words: contractions, runs
of letters, single numbers, runs of other characters.  A word is its UTF-8
bytes as symbols, the last one marked as a word end.

1. One pass of an Aho-Corasick automaton over the reversed word gives, for
   each place, the longest token that starts there.
2. From left to right the longest token is taken whose end is not known to be
   a dead end and which is compatible with the token before it; shorter
   prefixes are tried next, and without one left the last token is given back.
   Two tokens are compatible if merging their joined symbols gives these two
   tokens again.  A sequence of neighbours that are compatible is the only one
   of its symbols, so what is found is what merging in rank order gives, and
   each place is entered and left at most once.
3. Compatibility is looked up in a table that is filled as pairs turn up, by
   walking the pieces on both sides of the seam in the order of their ranks.

A worker keeps the ids of the words it has seen, up to ``KEPT_WORDS`` and as
many that came before; that saves time and changes no result.  Decoding gathers each id's bytes from one
buffer by an offset table and puts a space between tokens, as the library
does for a file without a decoder.

Defined cases: a null or empty text, and one of white space only, has no token
and decodes to the empty text.  Special tokens in a text are those tokens.
Null ids, and ids that the file has not, are skipped in decoding.  Repeated
rows are encoded row by row; an empty table gives an empty result.  Other
columns are kept, whatever their names.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
import uuid
from array import array
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.textarrays import row_bytes

MODEL = "/opt/tokenizers/word_bpe_49k.json"
WORD_END, NEVER = 256, 1 << 62
KEPT_WORDS, KEPT_PAIRS, CHUNK = 1 << 18, 1 << 20, 1 << 19
# The split of the tokenizer file, which is held against it on loading.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte in the file's tokens: printable Latin-1 for itself, the others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranges(points: Iterable[int]) -> str:
    """Inside of a character class of these code points."""
    out: list[list[int]] = []
    for c in sorted(points):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def newer_characters(path: str) -> tuple[dict[int, str], list[str]]:
    """What the library's Unicode version has otherwise than Python's, among characters that Python does not know:
    lower-case forms, and characters that ``regex`` takes for letters or numbers and the library does not."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    unknown = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Cn"]
    said = tok.normalizer.normalize_str("a".join(unknown)).split("a")
    lower = {ord(c): s for c, s in zip(unknown, said, strict=True) if s != c}
    named = regex.findall(r"[\p{L}\p{N}]", "".join(unknown))
    pre = tok.pre_tokenizer
    return lower, [c for c in named if len(pre.pre_tokenize_str(f"!{c}!")) == 1]


def load(path: str = MODEL) -> dict:
    """Tables of the tokenizer file, as plain Python."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    m, pre = j["model"], j["pre_tokenizer"]["pretokenizers"]
    kinds = [n["type"] for n in j["normalizer"]["normalizers"]]
    if (m["type"], m["end_of_word_suffix"], m["unk_token"], m["continuing_subword_prefix"], m["ignore_merges"]) != ("BPE", "</w>", None, None, False) \
            or kinds != ["NFC", "Replace", "Lowercase"] or pre[0]["pattern"]["Regex"] != SPLIT or [p["type"] for p in pre] != ["Split", "ByteLevel"] \
            or j["decoder"] is not None:
        raise ValueError(f"{path}: another kind of tokenizer")
    merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
    lower, not_letters = newer_characters(path)
    return {"vocab": m["vocab"], "merges": merges, "special": {t["content"]: t["id"] for t in j["added_tokens"]}, "lower": lower, "not_letters": not_letters}


class Words(dict):
    """Number of each word seen; ``ids`` and ``off`` hold their tokens one after another.  Words of the ``older`` ones are copied."""

    def __init__(self, bpe: Bpe, older: Words | None = None) -> None:
        self.bpe, self.ids, self.off, self.older = bpe, array("i"), array("q", [0]), older
        if older is not None:
            older.older = None

    def put(self, word: str, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.off.append(len(self.ids))
        self[word] = len(self)
        return self[word]

    def __missing__(self, word: str) -> int:
        if self.older is not None and (k := self.older.get(word)) is not None:
            return self.put(word, self.older.ids[self.older.off[k]:self.older.off[k + 1]])
        return self.put(word, self.bpe.word_ids(word.encode()))


class Bpe:
    """Tables of one vocabulary; a Python worker builds them once."""

    def __init__(self, said: dict) -> None:
        vocab, self.special = said["vocab"], said["special"]
        size = max([*vocab.values(), *self.special.values()]) + 1
        byte = byte_chars()
        symbols: dict[int, str] = {}                                # token -> its symbols as one string
        self.base = np.zeros(2 * WORD_END, np.int64)
        for c, b in byte.items():
            for end, name in ((0, c), (WORD_END, c + "</w>")):
                symbols[vocab[name]] = chr(b + end)
                self.base[b + end] = vocab[name]
        self.pair: dict[int, int] = {}                              # left * size + right -> rank
        self.size, rank, parts = size, {}, {}
        for r, (a, b) in enumerate(said["merges"]):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if t in rank or rank.get(x, -1) >= r or rank.get(y, -1) >= r:
                raise ValueError("each token must have one merge, behind those of its parts")
            symbols[t], rank[t], parts[t] = symbols[x] + symbols[y], r, (x, y)
            self.pair[x * size + y] = r
        # the pieces at a token's right and left end, from a symbol to the token itself, each with the rank at which it is merged on
        self.right = {t: self.spine(t, parts, rank, 1) for t in symbols}
        self.left = {t: self.spine(t, parts, rank, 0) for t in symbols}
        self.seam: dict[int, bool] = {}
        # a token whose parts don't meet when its symbols are merged never occurs
        for t in sorted(rank, key=rank.__getitem__):
            x, y = parts[t]
            if x not in symbols or y not in symbols or not self.compatible(x, y, rank[t]):
                del symbols[t]
        self.seam.clear()
        self.length, self.shorter = [0] * size, [-1] * size
        by_symbols = {s: t for t, s in symbols.items()}
        self.longest = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for s, t in by_symbols.items():
            self.longest.add_word(s[::-1], t)
        self.longest.make_automaton()
        for s, t in by_symbols.items():
            self.length[t] = len(s)
            self.shorter[t] = next((by_symbols[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_symbols), -1)
        self.lower = said["lower"]
        odd = ranges(map(ord, said["not_letters"]))
        self.rare = re.compile(f"[{ranges(self.lower)}{odd}]") if self.lower or odd else None
        least = min([*self.lower, *map(ord, said["not_letters"])], default=sys.maxunicode)
        self.late = re.compile(f"[{chr(least)}-{chr(sys.maxunicode)}]")     # quicker to look for, and most texts have none
        self.split = regex.compile(SPLIT)
        minus = f"--[{odd}]" if odd else ""
        self.rare_split = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{minus}]+|[\p{{N}}{minus}]|[^\s[[\p{{L}}\p{{N}}]{minus}]]+")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = Words(self)
        text = [b""] * size
        for s, t in [*vocab.items(), *self.special.items()]:
            text[t] = s.encode() + b" "
        self.blob = np.frombuffer(b"".join(text), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in text])])

    @staticmethod
    def spine(t: int, parts: dict, rank: dict, side: int) -> list[tuple[int, int]]:
        out = [(t, NEVER)]
        while t in parts:
            out.append((parts[t][side], rank[t]))
            t = parts[t][side]
        return out[::-1]

    def compatible(self, a: int, b: int, own: int = -1) -> bool:
        """Whether merging the symbols of both gives ``a, b``.  With ``own``: whether nothing merges over the seam before that rank does."""
        xs, ys, i, j = self.right[a], self.left[b], 0, 0
        while True:
            (x, x_on), (y, y_on) = xs[i], ys[j]
            r = self.pair.get(x * self.size + y, NEVER)
            if r < x_on and r <= y_on:          # of equal merges the left one comes first
                return r == own and x == a and y == b
            if x_on == y_on == NEVER:
                return True
            if x_on <= y_on:
                i += 1
            else:
                j += 1

    def fits(self, a: int, b: int) -> bool:
        """Fills in the pair's place in the table."""
        if len(self.seam) >= KEPT_PAIRS:
            self.seam.clear()
        ok = self.seam[a * self.size + b] = self.compatible(a, b)
        return ok

    def word_ids(self, word: bytes) -> list[int]:
        n, length, shorter, size, known = len(word), self.length, self.shorter, self.size, self.seam.get
        backwards = chr(word[-1] + WORD_END) + word[-2::-1].decode("latin-1") if n > 1 else chr(word[-1] + WORD_END)
        # matches with one end come longest first, so of the reversed list the longest ones stay: last place in the word -> token
        start = dict([*self.longest.iter(backwards)][::-1])
        out: list[int] = []
        dead: set[int] = set()
        at, before, t = 0, -1, start[n - 1]
        while at < n:
            while t >= 0:
                if not dead or at + length[t] not in dead:
                    if before < 0:
                        break
                    ok = known(before * size + t)
                    if ok or ok is None and self.fits(before, t):
                        break
                t = shorter[t]
            if t >= 0:
                out.append(t)
                at += length[t]
                before, t = t, start[n - 1 - at] if at < n else -1
            else:                                               # no way on from here
                dead.add(at)
                t = out.pop()
                at -= length[t]
                before = out[-1] if out else -1
        return out

    def split_words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if text.isascii():
            return ASCII_SPLIT.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        rare = self.rare is not None and self.late.search(text) and self.rare.search(text)
        text = text.replace("Σ", "σ").lower()                   # a final sigma only by its neighbours, which the library doesn't see
        return self.rare_split.findall(text.translate(self.lower)) if rare else self.split.findall(text)

    def numbers(self, text: str) -> list[int]:
        """The word number of each word and special token of a text."""
        of = self.words.__getitem__
        if self.cut is None or "<" not in text:
            return list(map(of, self.split_words(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:                                           # words have no space, so these names are free
                out.append(self.words[f" {part}"] if f" {part}" in self.words else self.words.put(f" {part}", [self.special[part]]))
            else:
                out += map(of, self.split_words(part))
        return out

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the rows' offsets, runs of rows of about CHUNK bytes at a time."""
        data, off = row_bytes(col)
        ids, sizes, lo, rows = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], 0, len(off) - 1
        while lo < rows:
            hi = min(rows, max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, "right")) - 1))
            if len(self.words) > KEPT_WORDS or len(self.words.ids) > 4 * KEPT_WORDS:
                self.words = Words(self, self.words)
            rows_words = [np.array(self.numbers(data[a:b].tobytes().decode()), np.int64)
                          for a, b in zip(off[lo:hi].tolist(), off[lo + 1:hi + 1].tolist(), strict=True)]
            flat, at = np.frombuffer(self.words.ids, np.int32) if self.words.ids else np.empty(0, np.int32), np.frombuffer(self.words.off, np.int64)
            own = np.concatenate(rows_words)
            got, ends = gather(flat, at, own)
            ids.append(got)
            sizes.append(np.diff(ends[np.cumsum([0, *map(len, rows_words)])]))
            del flat, at                                        # else the arrays can't grow
            lo = hi
        return np.concatenate(ids), np.cumsum(np.concatenate(sizes))

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows and the rows' offsets; every id must be known."""
        said, ends = gather(self.blob, self.at, ids)
        off = ends[off]
        full = np.diff(off) > 0
        keep = np.ones(len(said), bool)
        keep[off[1:][full] - 1] = False                         # the space behind each row's last token
        return said[keep], off - np.concatenate([[0], np.cumsum(full)])


def gather(flat: np.ndarray, off: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``flat[off[k]:off[k + 1]]`` of ``which`` one after another, and their offsets there."""
    size = off[which + 1] - off[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    return flat[np.arange(ends[-1]) + np.repeat(off[which] - ends[:-1], size)], ends


_tables: dict[str, Bpe] = {}


def _bpe(key: str, said: Broadcast) -> Bpe:
    if key not in _tables:
        _tables.clear()
        _tables[key] = Bpe(said.value)
    return _tables[key]


class Tokenizer:
    """Encoding and decoding columns with one tokenizer file."""

    def __init__(self, spark: SparkSession, model: str = MODEL) -> None:
        self.name, self.said = uuid.uuid4().hex, spark.sparkContext.broadcast(load(model))     # a vocabulary: some 2 MB

    def encode(self, text: Column) -> Column:
        """Array of token ids."""
        name, said = self.name, self.said

        def of(col: pa.Array) -> pa.Array:
            ids, off = _bpe(name, said).encode(col)
            return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids))
        return F.arrow_udf(of, "array<int>")(text)

    def decode(self, ids: Column) -> Column:
        """Text of token ids."""
        name, said = self.name, self.said

        def of(col: pa.Array) -> pa.Array:
            b = _bpe(name, said)
            col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
            size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = col.flatten()
            known = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ok = (known >= 0) & (known < b.size)
            total = np.concatenate([[0], np.cumsum(ok)])
            data, off = b.decode(known[ok], total[np.concatenate([[0], np.cumsum(size)]).astype(np.int64)])
            return pa.LargeStringArray.from_buffers(len(col), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
        return F.arrow_udf(of, "string")(ids)


@register("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again: token count and digests of the ids and of the decoded text."""
    bpe = Tokenizer(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    both = docs.select("doc_id", "ids", bpe.decode(F.col("ids")).alias("decoded"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
