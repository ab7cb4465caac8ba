import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from lapengine.llm import bpe as B
from lapengine.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = ["", " ", "\n\t ", "Hello World's! ΣΑΣ Σ İ <|endoftext|> foo<|startoftext|>bar  1234 é", "été Å ẛ̣", "<|endoftext|>",
         "<|endoftext|><|endoftext|>", "<|endoftext", "</w> a</w>b <w>", "x" * 3000, "ab" * 2000, "'" * 50 + "s'll've", "日本語のテキスト 😀😀", "\x00\x01 \x1c\x1d a\x85b",
         "١٢٣ ½ ² Ⅳ", "ᲉꟋ ՘a\U00016ea0", "internationalization " * 30, "don't DON'T we'LL", "a　b c", "\U00010d50ࢗ", "﻿​"]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(B.MODEL)


@pytest.fixture(scope="module")
def own():
    return B.Bpe(B.load())


def ids_of(b, texts):
    ids, off = b.encode(pa.array(texts, pa.string()))
    return [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:], strict=True)]


def decoded(b, rows):
    data, off = b.decode(np.array([i for r in rows for i in r], np.int64), np.cumsum([0, *map(len, rows)]))
    return [data[x:y].tobytes().decode() for x, y in zip(off[:-1], off[1:], strict=True)]


def library_ids(lib, texts):
    return [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_is_the_library_on_odd_texts(library, own):
    got = ids_of(own, TEXTS)
    assert got == library_ids(library, TEXTS)
    assert decoded(own, got) == [library.decode(x, skip_special_tokens=False) for x in got]


def test_is_the_library_on_every_character(library, own):
    texts = ["".join(f" a{chr(c)}!" for c in range(lo, lo + 0x100) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x110000, 0x100)]
    assert ids_of(own, texts) == library_ids(library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text("abcdeinrstht'  "), st.text("ab<|>/w"), st.text("aAeEéÉéΣς ")), max_size=5))
def test_is_the_library_on_any_text(library, own, texts):
    assert ids_of(own, texts) == library_ids(library, texts)


def plain_merges(b, word):
    """Merging in rank order, leftmost first."""
    out = [int(b.base[x]) for x in word[:-1]] + [int(b.base[word[-1] + B.WORD_END])]
    into = {k: None for k in b.pair}
    while True:
        ranked = [(b.pair[x * b.size + y], i) for i, (x, y) in enumerate(zip(out, out[1:], strict=False)) if x * b.size + y in into]
        if not ranked:
            return out
        r, i = min(ranked)
        out[i:i + 2] = [b.by_rank[r]]


def test_word_is_rank_order_merging(own):
    merges = B.load()
    own.by_rank = [merges["vocab"][x + y] for x, y in merges["merges"]]
    rng = np.random.default_rng(5)
    for _ in range(400):
        word = bytes(rng.choice(list(b"aeinrsthol"), rng.integers(1, 25)).tolist())
        assert own.word_ids(word) == plain_merges(own, word)


def test_small_tables_give_the_same(own, monkeypatch, library):
    monkeypatch.setattr(B, "KEPT_WORDS", 2)
    monkeypatch.setattr(B, "KEPT_PAIRS", 2)
    monkeypatch.setattr(B, "CHUNK", 8)
    b = B.Bpe(B.load())
    assert ids_of(b, TEXTS) == library_ids(library, TEXTS)


def test_long_word_takes_linear_time(own):
    import time
    took = []
    for n in (50_000, 400_000):
        t = time.process_time()
        own.word_ids((b"ana" * n)[:n])
        took.append(time.process_time() - t)
    assert took[1] < 24 * max(took[0], 0.02)


def test_columns_nulls_repeats_and_clashing_names(spark, library):
    rows = [(i, t, [1], "x") for i, t in enumerate([None, *TEXTS] * 2)] + [(None, "no id", [2], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string")
    t = B.Tokenizer(spark)
    out = df.withColumn("e", t.encode(F.col("text"))).withColumn("back", t.decode(F.col("e")))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.e == want and r.back == library.decode(want, skip_special_tokens=False)
    assert df.limit(0).withColumn("e", t.encode(F.col("text"))).collect() == []
    odd = spark.createDataFrame([([518, None, -1, 10**8, 518],), (None,), ([],)], "ids array<int>").select(t.decode(F.col("ids")).alias("t"))
    assert [r.t for r in odd.collect()] == ["the</w> the</w>", "", ""]


def test_query_is_the_library(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_bpe"](spark, SF).collect()}
    ids = {d.doc_id: library.encode(d.text or "", add_special_tokens=False).ids for d in docs}
    assert got == {k: (len(v), sha(" ".join(map(str, v))), sha(library.decode(v, skip_special_tokens=False))) for k, v in ids.items()}
