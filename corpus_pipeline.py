"""Corpus pipeline: language ID, near-dedup, decontamination, secret redaction, tokenization.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's result to the shared folder and hands the reread table to
the next one.  All but the last stage return the columns of their input.  Any
columns may come along; only doc_id, text and lang are read, and n_chars is
kept right if it is there.

Defined cases: null and wordless texts leave at the first stage.  Rows that
repeat another in all columns, or only its text, are near-duplicates of it.
An empty table gives an empty result.  Columns whose names begin with
``_stage_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm import decontaminate, language, pieces, secrets, simhash
from lapengine.llm.registry import table
from lapengine.llm.storage import bounded_batches, shared_dir, written

# A text under the score can't be told between languages; one under the familiarity is of none of them.  Of held-out
# texts of learned languages none lies under 0.87 (sf0.1, 1500 documents a language).
MIN_LANGUAGE_SCORE, MIN_FAMILIAR = 0.4, 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: no letter, a tie of languages (a score under MIN_LANGUAGE_SCORE), or
    words that are on average less than MIN_FAMILIAR familiar, whatever the length.

    The model is learned from the stage's own labelled documents.
    """
    bounded_batches(spark)
    found = language.identify(docs, language.train(docs), to="_stage_lang", familiar=True)
    of = F.col("_stage_lang")
    told = (of["lang"] != language.UNKNOWN) & (of["score"] >= MIN_LANGUAGE_SCORE) & (of["familiar"] >= MIN_FAMILIAR)
    return found.where(told).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one with the smallest doc_id (of several
    rows with that id, one with the smallest fingerprint; of rows alike in both, any one)."""
    bounded_batches(spark)
    # an id that is never null: the join and the choice among repeated rows then share one shuffle of the texts
    rows = docs.withColumns({"_stage_fp": simhash.fingerprint(F.col("text")), "_stage_id": _named(F.col("doc_id"))})
    of = simhash.near_duplicates(written(rows.select("doc_id", F.col("_stage_fp").alias("fp")), "stagefps"))
    keepers = of.where(F.col("fp") == F.col("keeper_fp")).select(F.col("fp").alias("_stage_fp"), _named(F.col("component_id")).alias("_stage_id"))
    kept = rows.join(keepers, ["_stage_fp", "_stage_id"], "left_semi")
    return kept.dropDuplicates(["_stage_fp", "_stage_id"]).select(*docs.columns)


def _named(doc_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("#"), doc_id.cast("string")), F.lit(""))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), to="_stage_hits")
    return found.where(~decontaminate.is_contaminated(F.col("_stage_hits"))).select(*docs.columns)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a placeholder; no document goes."""
    ledger = shared_dir(spark, "stageledger")
    # packed, so that no name can clash; the text is moved once, not in the pack too
    packed = docs.select(F.struct(F.lit(0).alias("_stage_"), *[c for c in docs.columns if c != "text"]).alias("_stage_row"), "text")
    secrets.update(packed, ledger)
    found = secrets.findings(packed, ledger).withColumn("_stage_text", secrets.redact(F.col("text"), F.col("secret_spans")))
    own = {c: F.col("_stage_text" if c == "text" else f"_stage_row.`{c}`") for c in docs.columns}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.size("secret_spans") > 0, F.length("_stage_text").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return found.select(*[own[c].alias(c) for c in docs.columns])


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with merge-dropout of every document, and whether they decode to its text."""
    e = docs.select("doc_id", pieces.Tokenizer(bounded_batches(spark)).encode(F.col("text"), F.col("doc_id")).alias("e"))
    return e.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"), F.col("e.lossless").alias("lossless"), F.col("e.ids").alias("ids"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminated), ("secret_scan", redacted),
          ("sentencepiece", tokenized)]

# The stages hash and tokenize in ways that SQL has not; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
