import re

import numpy as np
import pytest

from lapengine.llm import quality as Q
from lapengine.llm.registry import QUERIES, table
from lapengine.llm.trees import fit

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = {g: grams.count(g) if len(grams) < 3000 else 0 for g in set(grams)}
    if len(grams) >= 3000:
        for g in grams:
            count[g] += 1
    hit = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


TEXTS = [None, "", " \n\t", "a", "a b c a b c", "a b c\na b c\n\na b c\n \n", "é😀 ü # $%|", "x\n x\nx \nx", "a a a a", "\n\n", "a\rb\n\ra\rb",
         "w " * 49, "one two three four five six seven " * 9, " ".join(f"w{i}" for i in range(60)), "long " * 40000 + "tail", "a b\x1cc\x85d"]


def test_statistics_are_brute_force(spark):
    df = spark.createDataFrame([(i, t, 3, "p") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, n_words int, p string")
    model = fit(np.empty((0, len(Q.FEATURES))), np.empty(0), Q.MONOTONE)
    got = Q.judge(df, model).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        b = brute((TEXTS * 2)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == b, (TEXTS * 2)[r.doc_id]
        assert r.kept == (not b[-1])                    # without labels the trees keep every document
    assert Q.judge(df.limit(0), model).collect() == []


def test_train_on_nulls_and_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (9, 0)], "doc_id long, quality int")
    assert len(Q.train(docs, labels).roots) == 0
    assert len(Q.train(docs, labels.limit(0)).roots) == 0


def test_trees_learn_and_are_monotonic():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] < 0.6) & (x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) < 0.8) ^ (rng.random(3000) < 0.05)).astype(float)
    mono = np.array([-1, -1, 0, 0])
    model = fit(x, y, mono)
    assert ((model.probability(x) >= 0.5) == y).mean() > 0.92
    for f in (0, 1):
        grid = np.repeat(x[:200], 21, axis=0)
        grid[:, f] = np.tile(np.linspace(-0.1, 1.1, 21), 200)
        assert (np.diff(model.probability(grid).reshape(200, 21), axis=1) <= 1e-12).all()

    def walk(row):                                      # one row down each tree, node by node
        total = model.start
        for k in model.roots:
            while model.left[k] != k:
                k = model.left[k] if row[model.feature[k]] <= model.threshold[k] else model.right[k]
            total += model.value[k]
        return 1 / (1 + np.exp(-total))
    assert np.allclose([walk(r) for r in x[:50]], model.probability(x[:50]))


@pytest.mark.parametrize("sf", [SF])
def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    good = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = QUERIES["op4_quality_rules"](spark, sf).collect()
    assert len(got) == len(docs)
    assert all(tuple(r)[1:7] == brute(docs[r.doc_id]) for r in got)
    assert not any(r.kept and r.base_failed for r in got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = Q.train(docs, labels.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    held = labels.where("crc32(cast(doc_id as string)) % 4 = 2").select("doc_id", "quality")
    rows = Q.judge(docs.join(held, "doc_id", "left_semi"), model).join(held, "doc_id").where("not base_failed").collect()
    keep, drop = [r.kept for r in rows if r.quality], [not r.kept for r in rows if not r.quality]
    assert np.mean(keep) > 0.99 and np.mean(drop) > 0.9, (len(keep), np.mean(keep), len(drop), np.mean(drop))
