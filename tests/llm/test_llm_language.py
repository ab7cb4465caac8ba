import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapengine.llm import language as L
from lapengine.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_of_the_query(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op1_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = [r.lang_pred == docs[r.doc_id].lang for r in held]
    assert len(right) > 200 and np.mean(right) > 0.97


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("the dog", "en"), ("der hund und die katze", "de"),
                                                        ("le chat et le chien", "fr"), (None, "en"), ("kein", None)])]
    return L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def brute(model, text):
    """Word by word from the model's table, in plain Python."""
    words = L.WORD.findall((text or "").lower())
    if not words:
        return "und", 0.0
    table_ = dict(zip(model.units, model.scores.astype(float).tolist(), strict=True))
    total = np.zeros(len(model.langs))
    for w in words:
        if w in table_:
            total += table_[w]
            continue
        for n in range(model.grams, 0, -1):
            m = "<" + w + ">" if n > 1 else w
            own = [table_["\t" + m[i:i + n]] for i in range(len(m) - n + 1) if "\t" + m[i:i + n] in table_]
            if own:
                total += np.mean(own, axis=0)
                break
    p = np.exp(total - max(total))
    return model.langs[int(np.argmax(p))], float(p.max() / p.sum())


def test_edge_cases(spark, model):
    texts = [None, "", "123 !?", "the", "katzen hunde", "chatte", "日本語", "THE DOG", "the der", "x" * 100000, "der katze " * 20000, "ñ_1 é", "½ ② ² Ⅳ ٣", "½der"]
    df = spark.createDataFrame([(i, t, "z", 1.0) for i, t in enumerate(texts * 2)], "doc_id long, text string, lang string, score double")
    got = L.identify(df, model).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        lang, p = brute(model, r.text)
        assert r._lang.lang == lang and abs(r._lang.score - p) < 1e-3, r.text
    assert [got[i]._lang.lang for i in (0, 1, 2, 3, 4, 5, 6)] == ["und", "und", "und", "en", "de", "fr", "de"]
    assert (got[12]._lang.lang, got[12]._lang.score) == ("und", 0.0) and got[13]._lang.lang == "de"     # numbers are no letters
    assert L.identify(df.limit(0), model).collect() == []


def test_training_is_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()] + [(1, None, "en"), (None, "Ab ab ½ über", "xx")]
    m = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), grams=3)
    count, total = {}, {}
    for _, t, lang in rows:
        for w in L.WORD.findall((t or "").lower()) if lang else []:
            marked = f"<{w}>"
            for size, u in [(0, w), (1, None), *[(n, "\t" + marked[i:i + n]) for n in (2, 3) for i in range(len(marked) - n + 1)]]:
                for u in (["\t" + c for c in w] if size == 1 else [u]):
                    count[u, lang] = count.get((u, lang), 0) + 1
                    total[size, lang] = total.get((size, lang), 0) + 1
    assert m.langs == sorted({r[2] for r in rows if r[2]}) and set(m.units) == {u for u, _ in count}
    for u, row, seen in zip(m.units, m.scores, m.seen, strict=True):
        size = 0 if u[0] != "\t" else len(u) - 1
        want = [np.log((count.get((u, x), 0) + 0.5) / (total.get((size, x), 1) + 0.5 * len(m.units))) for x in m.langs]
        assert np.allclose(row, want, atol=1e-4) and seen.tolist() == [(u, x) in count for x in m.langs]
    fewer = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_chars=20_000)
    assert len(fewer.units) < len(m.units)


def test_familiarity_is_lazy_and_only_on_request(spark, model):
    for text in ("the katze chat qqq der", "chien " * 5 + "xyz", "hund"):
        whole, plain = L.Scorer(model), L.Scorer(model, familiar=False)
        lang, score, familiar = whole.predict(text)
        assert (lang, score, 0.0) == plain.predict(text) and plain.rows.shape[1] == len(model.langs)
        k, words = model.langs.index(lang), L.WORD.findall(text)
        seen = dict(zip(model.units, model.seen, strict=True))
        want = [1.0 if w in seen and seen[w][k] else whole.built(w)[k] for w in words]
        assert np.isclose(familiar, np.mean(want), atol=1e-6) and whole.predict(text)[2] == familiar


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string")
    empty = L.train(df)
    assert [tuple(r._lang) for r in L.identify(df, empty).collect()] == [("und", 0.0)] * 2
    assert L.train(df.limit(0)).langs == []


def test_small_cache_gives_the_same_scores(spark, model, monkeypatch):
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600))
    want = L.Scorer(model).predict(text)
    monkeypatch.setattr(L, "CACHE", 50)
    small = L.Scorer(model)
    assert np.allclose(want[1], small.predict(text)[1]) and np.allclose(want[1], small.predict(text)[1])
