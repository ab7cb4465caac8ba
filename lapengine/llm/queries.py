"""Loads every module that registers a training-data query, and the pipeline."""

import corpus_pipeline
from lapengine.llm import bpe, chat, decontaminate, language, negatives, pieces, quality, secrets, simhash, spelling, substrings, url_filter, warc  # noqa: F401
from lapengine.llm.registry import ORACLE, QUERIES, register

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLE", "QUERIES"]
