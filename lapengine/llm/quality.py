"""Quality rules: base rules on document statistics, then gradient-boosted trees over them.

The statistics are computed for whole texts, in numpy over Arrow batches.  The
trees are trained on at most about ``MAX_LABELLED`` labelled documents (a
hashed share of the label table, so a documented bound) and are monotonic:
more symbols, repeated lines, repeated words or exclamation marks never raise
a document's quality.

Defined cases: a null text has no word, like an empty one, and fails the base
rules.  Repeated documents are judged row by row; repeated labels count each.
A label whose quality or doc_id is null, or that has no document, is not used.
Without labels the trees keep every document.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table
from lapengine.llm.textarrays import SPACE, Chunk, chunks, gram_hashes, mix, span_hashes
from lapengine.llm.trees import TreeModel, fit

MAX_LABELLED = 20_000
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "chars_per_word", "symbols", "dup_lines", "repeat_words", "upper", "exclaims", "digits",
            "distinct_words", "words_per_line", "non_ascii", "stops")
MONOTONE = np.array([-1 if f in ("symbols", "dup_lines", "repeat_words", "exclaims") else 0 for f in FEATURES])
_ROW = np.uint64(0xD6E8FEB86659FD93)


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*chars]] = True
    return out


SYMBOLS, UPPER, DIGITS, STOPS = byte_set(b"#*$%&|<>"), byte_set(bytes(range(65, 91))), byte_set(b"0123456789"), byte_set(b".?")
LETTERS = UPPER | byte_set(bytes(range(97, 123)))


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def in_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that are equal only for equal values of the same row."""
    return mix(values + rows.astype(np.uint64) * _ROW)


def lines(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each \\n-split line that holds a word."""
    cut = np.flatnonzero(c.data == 10)
    starts = np.unique(np.concatenate([c.offsets[:-1], cut + 1]))
    starts = starts[starts < len(c.data)]
    ends = np.minimum(np.concatenate([cut, [len(c.data)]])[np.searchsorted(cut, starts)],
                      c.offsets[np.searchsorted(c.offsets, starts, "right")])
    worded = np.searchsorted(c.starts, ends) > np.searchsorted(c.starts, starts)
    starts, ends = starts[worded], ends[worded]
    return starts, ends, np.searchsorted(c.offsets, starts, "right") - 1


def chunk_statistics(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Rows x STATS counts and rows x FEATURES values."""
    rows, n = c.hi - c.lo, c.n_words
    data, off = c.data, c.offsets
    row_of, hashes = c.row_of_word(), c.hashes()
    # a word's code points: its bytes that do not continue one
    chars = per_row(((data & 0xC0) != 0x80) & ~SPACE[data], off)
    symbols = per_row(SYMBOLS[data], off)
    s, e, line_row = lines(c)
    n_lines = np.bincount(line_row, minlength=rows)
    _, first = np.unique(in_row(span_hashes(data, s, e), line_row), return_index=True)
    dup = n_lines - np.bincount(line_row[first], minlength=rows)
    grams = gram_hashes(hashes, 3)
    own = np.flatnonzero(row_of[:len(grams)] == row_of[2:]) if len(grams) else np.empty(0, np.int64)
    _, inverse, count = np.unique(in_row(grams[own], row_of[own]), return_inverse=True, return_counts=True)
    again = own[count[inverse] > 1]
    edge = np.zeros(len(hashes) + 3, np.int32)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + 3, -1)
    repeated = np.bincount(row_of[np.cumsum(edge)[:len(hashes)] > 0], minlength=rows)
    _, first = np.unique(in_row(hashes, row_of), return_index=True)
    distinct = np.bincount(row_of[first], minlength=rows)
    words, size, letters = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(per_row(LETTERS[data], off), 1)
    stats = np.stack([n, chars, symbols, dup, repeated], axis=1)
    feats = np.stack([np.log1p(n), chars / words, symbols / size, dup / np.maximum(n_lines, 1), repeated / words,
                      per_row(UPPER[data], off) / letters, per_row(data == ord("!"), off) / words, per_row(DIGITS[data], off) / size,
                      distinct / words, n / np.maximum(n_lines, 1), per_row(data >= 0xC0, off) / size, per_row(STOPS[data], off) / words], axis=1)
    return stats, feats


def batch_statistics(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [chunk_statistics(c) for c in chunks(col)]
    if not parts:
        return np.empty((0, len(STATS)), np.int64), np.empty((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def features(text: Column) -> Column:
    def of(col: pa.Array) -> pa.Array:
        return pa.array(list(batch_statistics(col)[1]), pa.list_(pa.float64()))
    return F.arrow_udf(of, "array<double>")(text)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED, **params) -> TreeModel:
    """Fit on the documents of a hashed share of ``labels(doc_id, quality)``, ``most`` labels on average at most."""
    use = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("_y"))
    share = min(1.0, most / max(1, use.count()))
    sample = use.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # broadcast: at most about `most` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "_y", features(F.col("text")).alias("x"))
    got = sorted((r.doc_id, r._y, r.x) for r in rows.collect())      # any order of rows gives the same trees
    return fit(np.array([r[2] for r in got], float).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], float), MONOTONE, **params)


def judge(docs: DataFrame, model: TreeModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, ``base_failed``, ``probability`` and ``kept`` of each document."""
    model_ = docs.sparkSession.sparkContext.broadcast(model)

    def of(col: pa.Array) -> pa.Array:
        stats, feats = batch_statistics(col)
        p = model_.value.probability(feats)
        return pa.StructArray.from_arrays([*(pa.array(s) for s in stats.T), pa.array(p)], [*STATS, "p"])

    kind = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ",p:double>"
    rows = docs.select(F.col(id_col), F.arrow_udf(of, kind)(F.col(text_col)).alias("_s"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rows.select(id_col, *[F.col(f"_s.{s}").alias(s) for s in STATS], F.col("_s.p").alias("probability"))
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold)))


@register("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return judge(docs, model).select("doc_id", *STATS, "base_failed", "kept")
