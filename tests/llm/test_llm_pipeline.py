import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from lapengine.llm import language, pieces, secrets
from lapengine.llm.registry import table
from lapengine.llm.storage import shared_dir, written
from tests_llm_brute import contaminated, predicted, secret_free, simhash_components

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, sf_dir):
    """Each stage's result, reread as the next one's input."""
    out = []
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"t-{name}")
        out.append(docs)
    return out


def test_every_stage_is_brute_force(spark):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    model = language.train(docs)
    stages = [docs, *run_stages(spark, docs, SF)]
    rows = [{r.doc_id: r for r in d.collect()} for d in stages]
    assert [len(r) for r in rows] == [d.count() for d in stages]
    assert all(d.columns == docs.columns for d in stages[:-1])
    judged = {k: predicted(model, r.text) for k, r in rows[0].items()}
    assert set(rows[1]) == {k for k, (lang, p) in judged.items() if lang != "und" and p >= C.MIN_LANGUAGE_SCORE}
    comp = simhash_components([(k, r.text) for k, r in rows[1].items()])
    assert set(rows[2]) == {k for k, c in comp.items() if k == c}
    assert set(rows[3]) == {k for k, r in rows[2].items() if not contaminated(r.text, items)}
    assert all(rows[k][i] == rows[0][i] for k in (1, 2, 3) for i in rows[k])
    assert set(rows[4]) == set(rows[3])
    for k, r in rows[4].items():
        text = secret_free(rows[3][k].text)
        assert r.text == text and r.n_chars == (len(text) if text != rows[3][k].text else rows[3][k].n_chars) and r.lang == rows[3][k].lang
    v = pieces.Vocabulary(pieces.load_pieces())
    keys = {r.doc_id: r.k for r in stages[4].select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    for k, r in rows[5].items():
        ids, _ = pieces.encode_batch(v, pieces.Dropout(pieces.DROPOUT, pieces.SEED), __import__("pyarrow").array([rows[4][k].text]),
                                     np.array([keys[k]], np.int64).view(np.uint64))
        assert r.ids == ids.tolist() and r.n_tokens == len(ids) and r.lossless and pieces.decode(v, r.ids).decode() == rows[4][k].text
    assert set(rows[5]) == set(rows[4])
    assert len(rows[1]) > len(rows[2]) > len(rows[3])                    # every filtering stage takes effect
    got = {r.doc_id: r.ids for r in C.run(spark, SF).collect()}
    assert got == {k: r.ids for k, r in rows[5].items()}


NAMES = "doc_id long, text string, lang string, source string, n_chars int, fp string, spans int, blob string, secret_spans string, ids int, component_id int, _blob int"


@pytest.fixture(scope="module")
def odd(spark):
    words = ["the and of to in is that it for was", "der die und das ist nicht mit den von zu", "le la et les des en un une est que"]
    texts = [None, "", "123 456 !", *[w for w in words], words[0] + " password=abcdef123456789", words[0], words[0].upper(), words[1] + " x",
             (words[2] + " ") * 3000, "\x00 the and of \x85 to in", "the"]
    rows = [(i, t, ["en", "de", "fr", None][i % 4], None, None if i % 3 else 5, "f", 1, "b", "s", 2, 3, 4) for i, t in enumerate(texts)]
    rows += rows[3:6] + [(None, words[0], None, None, 1, None, None, None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, NAMES)


def test_nulls_ties_repeats_and_clashing_names(spark, odd):
    names = odd.columns
    for _, stage in C.STAGES[:-1]:
        got = stage(spark, odd, SF)
        assert got.columns == names and got.count() <= odd.count()
    kept = C.language_id(spark, odd, SF).collect()
    assert not any(r.text in (None, "", "123 456 !") for r in kept)
    near = C.near_dedup(spark, odd, SF).collect()
    assert len(near) == len({r.doc_id for r in near}) and min(r.doc_id for r in near if r.text and r.text.lower().startswith("the and of to in is that it for was")) == 3
    clean = C.redacted(spark, odd, SF).collect()
    assert len(clean) == odd.count()
    hit = next(r for r in clean if r.text and "[secret]" in r.text)
    assert hit.text.endswith(" [secret]") and hit.n_chars == len(hit.text) and hit.fp == "f" and hit._blob == 4 and hit.secret_spans == "s"
    assert all(r.lossless for r in C.tokenized(spark, odd, SF).collect()) and C.tokenized(spark, odd, SF).count() == odd.count()


def test_empty_table(spark, odd):
    for docs in run_stages(spark, odd.limit(0), SF):
        assert docs.collect() == []


def test_shared_folder_is_the_configured_one(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert base is None or shared_dir(spark, "x").startswith(base)
    assert secrets.RULES


def test_long_texts_of_no_learned_language_leave_and_short_clean_ones_stay(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    langs = sorted({r.lang for r in docs.select("lang").distinct().collect() if r.lang})
    rng = np.random.default_rng(3)

    def words(n):
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 10))) for _ in range(n))
    odd = ["kissa istuu matolla ja katselee hiljaa ikkunasta ulos kun lumi putoaa maahan " * 40, words(30), words(3000), "日本語の文章です " * 500]
    short = [" ".join(language.WORD.findall(docs.where(F.col("lang") == x).orderBy("doc_id").first().text)[:6]) for x in langs]
    rows = [(-1 - k, t, None) for k, t in enumerate(odd)] + [(-100 - k, t, None) for k, t in enumerate(short)]
    every = docs.union(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in C.language_id(spark, every, SF).collect()}
    judged = language.identify(every, language.train(every)).where(F.col("_lang.score") >= C.MIN_LANGUAGE_SCORE)
    assert not kept & {-1 - k for k in range(len(odd))}
    assert {-1 - k for k in range(len(odd) - 1)} <= {r.doc_id for r in judged.collect()}         # the score alone lets them pass
    assert kept >= {-100 - k for k in range(len(short))} | {r.doc_id for r in judged.where("doc_id >= 0").collect()}
