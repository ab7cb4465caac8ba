"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language.  An unseen word
falls back to its longest character n-grams (word ends marked), then to
shorter ones, and takes the mean of those the model knows.  A text's
prediction is the language with the highest sum of its words' scores; its
confidence is the softmax of the sums, so words that all languages share say
nothing either way, however often they occur.  The confidence only compares the
learned languages and nears 1 for any long text; ``familiar``, the words' mean
familiarity in the predicted language, does not depend on length and tells a
text of none of them.

Training is bounded by parameters: a hashed share of a language's labelled
documents, about ``MAX_DOCS`` of them or ``MAX_CHARS`` characters; all words and
n-grams of those count.  Prediction reads whole texts and nothing but the text.

Defined cases: a null text, or one without a letter (Unicode category L; signs
like ``½`` are numbers), is ``und`` with score 0; so is every text if nothing can be learned.  A text of letters of which the
model knows nothing, or a tie, takes the first language by name.  Rows whose
lang or text is null are not learned from.  Repeated rows are judged row by
row.  Other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table

MAX_DOCS, MAX_CHARS, GRAMS = 1500, 2_000_000, 4
CACHE = 300_000
UNKNOWN = "und"


# a word, in training and prediction alike: a run of letters
WORD, ASCII_WORD = regex.compile(r"\p{L}+"), re.compile("[a-z]+")


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (ASCII_WORD if text.isascii() else WORD).findall(text)


@dataclass(frozen=True)
class LanguageModel:
    """``units``: words as they are, n-grams with a leading tab; row k of ``scores`` has the
    log frequency of unit k in each of ``langs``, row k of ``seen`` whether it was seen there."""

    langs: list[str]
    units: list[str]
    scores: np.ndarray
    grams: int
    seen: np.ndarray


class Scorer:
    """Scores words with a model; keeps the latest unseen words' rows.

    A row holds a word's score in each language and, with ``familiar``, how familiar it is there: 1
    for a word that was seen in the language, else the share of its longest n-grams that were.
    """

    def __init__(self, model: LanguageModel, familiar: bool = True) -> None:
        self.model, self.familiar = model, familiar
        self.grams = {u[1:]: k for k, u in enumerate(model.units) if u[0] == "\t"}
        self.met = {u: k for k, u in enumerate(model.units) if u[0] != "\t"}       # rows of known words, and of unseen ones that were met
        own = np.concatenate([model.scores, model.seen], axis=1, dtype=np.float32) if familiar else model.scores
        self.rows = np.concatenate([own, np.zeros((CACHE, own.shape[1]), np.float32)])
        # a known word of another language may still be built like this one's: filled in when it is met
        self.open = ~model.seen.all(axis=1) if familiar else np.zeros(len(own), bool)
        self.unseen: list[str] = []

    def fall_back(self, word: str) -> list[int]:
        """The word's longest n-grams that the model knows."""
        marked, known = f"<{word}>", self.grams.get
        for n in range(self.model.grams, 0, -1):
            of = marked if n > 1 else word
            own = [k for i in range(len(of) - n + 1) if (k := known(of[i:i + n])) is not None]
            if own:
                return own
        return []

    def built(self, word: str) -> np.ndarray:
        """Share of the word's longest n-grams that were seen in each language."""
        marked = f"<{word}>"
        n = min(self.model.grams, len(marked))
        of = marked if n > 1 else word
        own = [self.grams.get(of[i:i + n]) for i in range(len(of) - n + 1)]
        return self.model.seen[[k for k in own if k is not None]].sum(axis=0) / len(own)

    def meet(self, words: list[str]) -> None:
        """Fills in the rows of words that were not met yet."""
        lo, n = len(self.model.units) + len(self.unseen), len(self.model.langs)
        own = [self.fall_back(w) for w in words]
        size = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter((k for x in own for k in x), np.int64, int(size.sum()))
        total, some = np.zeros((len(words), n), np.float32), np.flatnonzero(size)
        if len(some):
            total[some] = np.add.reduceat(self.model.scores[flat], (np.cumsum(size) - size)[some], axis=0) / size[some][:, None]
        self.rows[lo:lo + len(words), :n] = total
        if self.familiar:
            self.rows[lo:lo + len(words), n:] = [self.built(w) for w in words]
        self.met.update(zip(words, range(lo, lo + len(words)), strict=True))
        self.unseen += words

    def scores(self, text: str) -> np.ndarray | None:
        """Sums of the text's words' rows: score in each language, familiarity in each, and the number of words; None
        without a letter."""
        count = Counter(words_of(text))
        if not count:
            return None
        total, n = np.zeros(self.rows.shape[1]), len(self.model.langs)
        words = list(count)
        for lo in range(0, len(words), CACHE // 2):     # a part's new words fit in the cache
            part = words[lo:lo + CACHE // 2]
            rows = np.fromiter(map(self.met.get, part, repeat(-1)), np.int64, len(part))
            if len(new := np.flatnonzero(rows < 0)):
                if len(self.unseen) + len(new) > CACHE:
                    for w in self.unseen:
                        del self.met[w]
                    self.unseen = []
                    rows[rows >= len(self.model.units)] = -1
                    new = np.flatnonzero(rows < 0)
                self.meet([part[i] for i in new.tolist()])
                rows[new] = len(self.model.units) + len(self.unseen) - len(new) + np.arange(len(new))
            if self.familiar:
                for i in np.flatnonzero(rows < len(self.open)).tolist():
                    if self.open[k := rows[i]]:
                        self.rows[k, n:] = np.maximum(self.model.seen[k], self.built(part[i]))
                        self.open[k] = False
            total += np.fromiter(map(count.__getitem__, part), np.float64, len(part)) @ self.rows[rows]
        return np.append(total, sum(count.values()))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, confidence, and mean familiarity of the words in that language (0 if not asked for)."""
        sums, n = self.scores(text) if text and self.model.langs else None, len(self.model.langs)
        if sums is None:
            return UNKNOWN, 0.0, 0.0
        total = sums[:n]
        p = np.exp(total - total.max())
        k = int(np.argmax(p))
        return self.model.langs[k], float(p[k] / p.sum()), float(sums[n + k] / sums[-1]) if self.familiar else 0.0


_scorers: dict[str, Scorer] = {}


_FIELDS = {"lang": "string", "score": "double", "familiar": "double"}


def _predict(key: str, model: Broadcast, col: pa.Array, n: int) -> pa.Array:
    """A Python worker builds a model's scorer once and keeps it."""
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model.value, n == len(_FIELDS))
    got = [_scorers[key].predict(t.as_py()) for t in col]
    cols = [pa.array([g[0] for g in got], pa.string()), *[pa.array([g[k] for g in got], pa.float64()) for k in range(1, n)]]
    return pa.StructArray.from_arrays(cols, list(_FIELDS)[:n])


def predicted(spark: SparkSession, text: Column, model: LanguageModel, familiar: bool = False) -> Column:
    """Struct column ``lang, score``, and ``familiar`` if asked."""
    said, key, n = spark.sparkContext.broadcast(model), uuid.uuid4().hex, 3 if familiar else 2

    def of(col: pa.Array) -> pa.Array:
        return _predict(key, said, col, n)
    return F.arrow_udf(of, "struct<" + ",".join(f"{k}:{t}" for k, t in list(_FIELDS.items())[:n]) + ">")(text)


def units(texts: DataFrame, grams: int) -> DataFrame:
    """``lang, size (0: word), unit, n``: counts of words and of their n-grams."""
    def words(col: pa.Array) -> pa.Array:
        return pa.array([words_of(t.as_py() or "") for t in col], pa.list_(pa.string()))
    word = (texts.select("lang", F.explode(F.arrow_udf(words, "array<string>")(F.col("text"))).alias("w"))
            .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    marked = F.concat(F.lit("<"), "w", F.lit(">"))
    arrays = [F.array(F.struct(F.lit(0).alias("size"), F.col("w").alias("unit")))]
    for size in range(1, grams + 1):
        arrays.append(_grams(marked if size > 1 else F.col("w"), size))
    return (word.select("lang", "n", F.explode(F.concat(*arrays)).alias("u"))
            .groupBy("lang", "u.size", "u.unit").agg(F.sum("n").alias("n")))


def _grams(of: Column, size: int) -> Column:
    at = F.when(F.length(of) >= size, F.sequence(F.lit(1), F.length(of) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.lit(size).alias("size"), of.substr(i, F.lit(size)).alias("unit")))


def train(docs: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, grams: int = GRAMS) -> LanguageModel:
    """Learn from ``docs(doc_id, text, lang)``."""
    own = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    chars = F.greatest(F.sum(F.length("text").cast("long")), F.lit(1))
    share = own.groupBy("lang").agg(F.least(F.lit(1.0), max_docs / F.count(F.lit(1)), max_chars / chars).alias("share"))
    pick = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), F.lit(0)) < F.col("share") * (1 << 30)
    shares = {r.lang: r.share for r in share.collect()}                 # one number a language
    if not shares:
        return LanguageModel([], [], np.empty((0, 0), np.float32), grams, np.empty((0, 0), bool))
    by_lang = F.create_map(*[x for k, v in sorted(shares.items()) for x in (F.lit(k), F.lit(v))])
    sample = own.withColumn("share", by_lang[F.col("lang")]).where(pick).select("lang", "text")
    # words and n-grams of the sample: about max_chars characters a language at most
    rows = units(sample, grams).select("lang", "size", F.concat(F.when(F.col("size") == 0, F.lit("")).otherwise(F.lit("\t")), "unit").alias("unit"), "n").toArrow()
    langs = sorted(shares)
    said, unit = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "unit"))
    lang = np.array([langs.index(x) for x in said.dictionary.to_pylist()], np.int64)[said.indices.to_numpy()]
    size, count = rows["size"].to_numpy(), rows["n"].to_numpy()
    names, sizes, at = unit.dictionary.to_pylist(), np.zeros(len(unit.dictionary), np.int64), unit.indices.to_numpy()
    sizes[at] = size
    n, total = np.zeros((len(names), len(langs))), np.zeros((grams + 1, len(langs)))
    n[at, lang] = count
    np.add.at(total, (size, lang), count)
    return LanguageModel(langs, names, np.log((n + 0.5) / (np.maximum(total, 1)[sizes] + 0.5 * len(names))).astype(np.float32), grams, n > 0)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", to: str = "_lang", familiar: bool = False) -> DataFrame:
    """``docs`` with the struct ``to``: lang and score, and familiar if asked."""
    return docs.withColumn(to, predicted(docs.sparkSession, F.col(text_col), model, familiar))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole document; learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(docs, model).select("doc_id", "held_out", F.col("_lang.lang").alias("lang_pred"), F.col("_lang.score").alias("score"))
