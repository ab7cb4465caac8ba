import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lapengine.llm import spelling as S
from lapengine.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_vocabulary(docs):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_length(words):
    out = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def brute_pairs(words):
    at = by_length(words)
    return {(a, b) for a in words for k in (-1, 0, 1) for b in at.get(len(a) + k, []) if near(a, b)}


def brute_variants(vocab):
    of = {w: [] for w in vocab}
    for a, b in brute_pairs(vocab):
        of[a].append(b)
    form = {w: min(v, key=lambda x: (-vocab[x], x)) if v else None for w, v in of.items()}
    form = {w: f if f and vocab[f] >= 5 * vocab[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(of[w]), vocab.get(form[w])) for w, n in vocab.items()}


def words_like(rng, count, alphabet="abc", lo=6, hi=9):
    return sorted({"".join(rng.choice(list(alphabet), rng.integers(lo, hi))) for _ in range(count)})


def found(words, queries=None):
    index, out = S.FmIndex(words), []
    queries = words if queries is None else queries
    for to in (0, 1):
        q, v = S.search(index, words, queries, to)
        out += [(queries[a], words[b]) for a, b in zip(q, v, strict=True)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_search_is_brute_force_and_gives_each_pair_once(seed):
    rng = np.random.default_rng(seed)
    words = words_like(rng, 250, ["abc", "ab", "aéÿ×z", "abcdefgh", "a\U0001F600b日", "xy"][seed], 6, 9 + seed % 2)
    got = found(words)
    assert len(got) == len(set(got)) and set(got) == brute_pairs(words)


def test_search_for_other_words_and_small_indexes():
    assert found(["aaaaaa"]) == []
    got = found(["aaaaaa"], ["aaaaaaa", "zzzzzz", "aaazaa", "zaaaaa"])
    assert sorted(got) == [("aaaaaaa", "aaaaaa"), ("aaazaa", "aaaaaa"), ("zaaaaa", "aaaaaa")]
    rng = np.random.default_rng(9)
    words, queries = words_like(rng, 120), words_like(rng, 120, "abcd")
    assert set(found(words, queries)) == {(a, b) for a in queries for b in words if near(a, b)}


def test_rotations_are_sorted():
    rng = np.random.default_rng(1)
    for text in ("$" + "a" * 40, "$ab$aba$abab", "$" + "ab" * 30 + "$" + "ab" * 31):
        codes = np.array([ord(c) for c in text]) - 36
        order = S.rotations(codes, 128)
        turned = [text[i:] + text[:i] for i in range(len(text))]
        assert [turned[i] for i in order] == sorted(turned)
    w = S.Wavelet(seq := rng.integers(0, 11, 300), 11)
    lo, hi = np.sort(rng.integers(0, 301, (2, 500)), axis=0)
    c = rng.integers(0, 11, 500)
    a, b, less = w.range(c, lo, hi)
    assert (b - a).tolist() == [int((seq[x:y] == k).sum()) for x, y, k in zip(lo, hi, c, strict=True)]
    assert less.tolist() == [int((seq[x:y] < k).sum()) for x, y, k in zip(lo, hi, c, strict=True)]
    of, d, a, b = w.each(lo, hi)
    assert sorted(zip(of.tolist(), d.tolist(), strict=True)) == [(i, k) for i in range(500) for k in np.unique(seq[lo[i]:hi[i]]).tolist()]


@pytest.mark.parametrize("block", [S.BLOCK, 400, 40])
def test_blocks_of_a_hot_key_change_nothing(spark, block):
    rng = np.random.default_rng(3)
    words = words_like(rng, 150, "abcde") + ["pre" + w for w in words_like(rng, 200, "ab", 3, 8)]
    vocab = {w: int(n) for w, n in zip(sorted(set(words)), rng.integers(5, 4000, len(words)), strict=False)}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = [(r.word, r.near) for r in S.near_words(df, block).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(vocab)
    if block == 400:
        assert {tuple(r[c] for c in COLS) for r in S.variants(df, block=block).collect()} == brute_variants(vocab)


def test_chains_of_forms_and_ties(spark):
    vocab = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "akjihg": 20000, "lkjihg": 99, "zzzzzz": 7, "zzzzza": 35, "zzzzzb": 35}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = {tuple(r[c] for c in COLS) for r in S.variants(df).collect()}
    assert got == brute_variants(vocab)
    of = {r[0]: r for r in got}
    assert of["abcdef"][2] == "akjihg" and of["zzzzzz"][1] == "zzzzza" and of["lkjihg"][1] == "akjihg" and of["akjihg"][1] is None


def test_nulls_empty_long_repeats_and_clashing_names(spark):
    text = "Straßen STRASSEN Ñandúes ×÷×÷×÷ _x_ naïvely naively " * 7 + "y" * 3000
    rows = [(1, text, "w", 1), (1, text, "w", 1), (2, None, None, 2), (None, "naively naïvely Ænigma " * 30, "n", 3), (3, "", "", 4), (4, "ΣΣΣΣΣΣ 日本語日本語 abcdefgh" * 9, "", 5)]
    rows += [(i, "z" * 2000 + " " + "q" * 1999, "", 6) for i in range(10, 17)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    vocab = brute_vocabulary([(r[0], r[1]) for r in rows])
    got = S.vocabulary(df)
    assert {r.word: r.n for r in got.collect()} == vocab and "naively" in vocab
    assert {tuple(r[c] for c in COLS) for r in S.variants(got).collect()} == brute_variants(vocab)
    assert S.variants(S.vocabulary(df.limit(0))).collect() == []


def test_query_is_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r[c] for c in COLS) for r in QUERIES["op12_spelling_variants"](spark, SF).collect()]
    want = brute_variants(brute_vocabulary(docs))
    assert len(got) == len(want) and set(got) == want and any(r[1] for r in got)
