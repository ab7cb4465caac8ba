import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapengine.llm import pieces as P
from lapengine.llm.registry import QUERIES, table
from lapengine.llm.textarrays import mix

SF = "/root/testdata/sf0.001"
TEXTS = ["", " ", "\n", "  a  b \n\n c\t", "hello world", "é😀ﬁ Ⅳ ▁x\x00y ▁▁", "a▁b", "x" * 300 + " y" * 5 + "é" * 100, "abc" * 200, "the " * 5000,
         "日本語のテキスト", "   ", "\r\n \x85  ", "internationalization " * 3, "q" * 64, "q" * 65]


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary(P.load_pieces())


def encode(v, texts, rate, seed=1, keys=None):
    keys = np.arange(len(texts), dtype=np.uint64) if keys is None else keys
    ids, off = P.encode_batch(v, P.Dropout(rate, seed), pa.array(texts, pa.string()), keys)
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)]


def brute(v, pieces, text, rate, seed, key):
    """The whole text at once: again and again the best candidate, leftmost on ties."""
    if not text:
        return []
    s = " " + text
    sym = [(i, i + 1, c if c != P.MARK else None) for i, c in enumerate(s)]
    own = {p.replace(P.MARK, " "): k for k, (p, _, ok) in enumerate(pieces) if ok}

    def skipped(a, b, c):
        place = (a * int(P._A) + b * int(P._B) + c * int(P._C) + seed) % 2**64
        one = lambda x: int(mix(np.array([x], np.uint64))[0])
        return one(one(place) ^ key) < int(rate * 2**64)
    while True:
        best = None
        for i in range(len(sym) - 1):
            (a, b, x), (_, c, y) = sym[i], sym[i + 1]
            if x is None or y is None or x not in own or y not in own or x + y not in own or (rate and skipped(a, b, c)):
                continue
            score = pieces[own[x + y]][1]
            if best is None or score > best[0]:
                best = (score, i)
        if best is None:
            break
        i = best[1]
        sym[i:i + 2] = [(sym[i][0], sym[i + 1][1], sym[i][2] + sym[i + 1][2])]
    out = []
    for a, b, x in sym:
        out += [own[x]] if x in own else v.byte_id[list(s[a:b].encode())].tolist()
    return out


def test_rate_zero_is_the_library(vocabulary, spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    texts = [t for t in TEXTS if P.MARK not in t] + [r.text for r in table(spark, SF, "documents").collect()]
    assert encode(vocabulary, texts, 0) == [sp.encode(t) for t in texts]


def test_dropout_is_brute_force(vocabulary, monkeypatch):
    pieces, texts = P.load_pieces(), [t[:400] for t in TEXTS]
    for rate in (0.0, 0.1, 0.5):
        want = [brute(vocabulary, pieces, t, rate, 7, k) for k, t in enumerate(texts)]
        assert encode(vocabulary, texts, rate, 7) == want
        with monkeypatch.context() as m:
            m.setattr(P, "LONG", 0)                             # every segment by its own heap
            assert encode(vocabulary, texts, rate, 7) == want
        with monkeypatch.context() as m:
            m.setattr(P, "CHUNK", 10)                           # a chunk a row
            assert encode(vocabulary, texts, rate, 7) == want


def test_lossless_varied_and_repeatable(vocabulary, spark):
    texts = TEXTS + [r.text for r in table(spark, SF, "documents").limit(40).collect()]
    seen = [encode(vocabulary, texts, rate, seed) for rate, seed in ((0, 1), (0.1, 1), (0.1, 2), (1, 1))]
    for ids in seen:
        assert [P.decode(vocabulary, x).decode() for x in ids] == texts
    assert seen[1] == encode(vocabulary, texts, 0.1, 1) and seen[0] != seen[1] != seen[2]
    assert sum(map(len, seen[0])) < sum(map(len, seen[1])) < sum(map(len, seen[3]))
    same = encode(vocabulary, ["segmentation of this text here"] * 50, 0.1)
    assert len({tuple(x) for x in same}) > 10                   # by key
    assert len({tuple(x) for x in encode(vocabulary, ["segmentation of this"] * 50, 0.1, keys=np.zeros(50, np.uint64))}) == 1


def test_columns_nulls_repeats_and_clashing_names(spark):
    rows = [(i, t, [1], True) for i, t in enumerate([None, *TEXTS] * 2)] + [(None, "no id", [2], False)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, lossless boolean")
    t = P.Tokenizer(spark)
    e = df.withColumn("e", t.encode(F.col("text"), F.col("doc_id"))).withColumn("back", t.decode(F.col("e.ids"))).collect()
    assert len(e) == len(rows)
    assert all(r.back == (r.text or "") and r.e.lossless and bool(r.e.ids) == bool(r.text) for r in e)
    assert df.limit(0).withColumn("e", t.encode(F.col("text"), F.col("doc_id"))).collect() == []


def test_query_is_the_operator(vocabulary, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("k", F.xxhash64("doc_id")).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.lossless) for r in QUERIES["op10_sentencepiece"](spark, SF).collect()}
    want = encode(vocabulary, [d.text for d in docs], P.DROPOUT, P.SEED, np.array([d.k for d in docs], np.int64).view(np.uint64))
    assert got == {d.doc_id: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), True) for d, x in zip(docs, want, strict=True)}
